"""Every registered query against its SQL answer, and properties that hold on any input."""

import importlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketloom.bindings import star  # noqa: E402
from marketloom.plans import views  # noqa: E402
from queries import load_all  # noqa: E402
from tools import compare  # noqa: E402

ALL = load_all()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert compare.mismatch(ALL[name].run(spark, sf_dir), duck, ALL[name].sql) is None


def test_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) >= set(ALL) and set(entry.queries()) >= set(ALL)
    assert entry.entry(spark).count() > 0


def test_every_surveyed_operator_has_a_query():
    covered = {line for q in ALL.values() for line in q.covers.split()}
    wanted = {f"{s}{i}" for s, n in {"B": 25, "C": 27, "D": 16, "E": 24, "F": 20, "G": 7, "H": 14}.items()
              for i in range(1, n + 1)} | {f"B-T{i}" for i in range(1, 10)} | {"A1", "A2", "A3", "A4", "A5", "A6", "A8"}
    # A7 (catalog listing) reads no given table.
    assert wanted - covered == set()


@pytest.fixture(scope="module")
def fact(spark, sf_dir):
    return star.numbered_facts(spark, sf_dir).cache()


def test_totals_are_conserved(fact):
    head = views.headline_kpis(fact).first()
    for view in (views.daily_orders(fact), views.monthly_kpis(fact)):
        total = view.agg({"orders": "sum", "gmv": "sum"}).first()
        assert (total["sum(orders)"], total["sum(gmv)"]) == (head.orders, head.gmv)
    assert views.payment_mix(fact).agg({"orders": "sum"}).first()[0] == head.orders
    net = views.rfm_summary(views.rfm(fact, star.RULES)).agg({"net_revenue": "sum"}).first()[0]
    assert net == head.net_revenue


def test_scores_are_even(fact):
    plain = views.rfm(fact, star.RULES)
    for score in ("r_score", "f_score", "m_score"):
        sizes = [r[1] for r in plain.groupBy(score).count().collect()]
        assert max(sizes) - min(sizes) <= 1


def test_retention_starts_at_100(spark, sf_dir, fact):
    got = views.cohort_retention(fact, star.dimension(spark, sf_dir, fact), star.RULES)
    assert {float(r.retention_pct) for r in got.where("months_since_first = 0").collect()} == {100.0}
    assert got.where("retention_pct not between 0 and 100").count() == 0
