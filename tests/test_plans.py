"""What the physical plans must and must not contain."""

import re
import sys

import pytest

from marketloom import session
from queries import load_all

ALL = load_all()
# These write and read files or print a single picked record; their plans are a scan.
WITH_ERFC = {"two_proportion", "srm_test"}
PLANNED = sorted(n for n in set(ALL) - {"stored_layer", "saved_view", "exported_view", "row_loss"} if not n.startswith("csv_extract"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def all_plans(spark, monkeypatch):
    """Plans as large data gets them (nothing small enough to broadcast by itself), those of stored steps included."""
    seen = []

    def kept(df, label="table", really=session.stored):
        seen.append(plan(df))
        return really(df, label)

    for module in list(sys.modules.values()):
        if getattr(module, "stored", None) is session.stored and module is not session:
            monkeypatch.setattr(module, "stored", kept)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield seen
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def scans(text, column):
    """Columns read by the scans that read the given column."""
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if f"{column}:" in s]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_at_scale(name, spark, sf_dir, all_plans):
    all_plans.append(plan(ALL[name].run(spark, sf_dir)))
    text = "\n".join(all_plans)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert ("Python" in text) == (name in WITH_ERFC)
    for tree in all_plans:
        lines = tree.split("\n")
        for at, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                above = next((x for x in reversed(lines[:at]) if re.search(r"Window \[|WindowGroupLimit|Aggregate|Limit", x)), "")
                below = lines[at + 1]
                # A window without a partition sees aggregates only; sums and counts come together as one row per task.
                assert "Window" not in above or "Aggregate" in "".join(lines[at:at + 4]), (name, above, below)


def test_scans_read_only_needed_columns(spark, sf_dir):
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    text = plan(ALL["payment_mix"].run(spark, sf_dir))
    assert scans(text, "l_orderkey") == [{"l_orderkey", "l_partkey"}]
    assert all("o_totalprice" not in read for read in scans(text, "o_orderkey"))


def test_filters_reach_the_scan(spark, sf_dir):
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(l_returnflag,R\)", plan(ALL["return_rollup"].run(spark, sf_dir)))


def test_views_aggregate_before_they_shuffle(spark, sf_dir):
    for name in ("daily_orders", "courier_scorecard", "rto_by_tier", "ab_test", "item_rollup"):
        assert "partial_count" in plan(ALL[name].run(spark, sf_dir)), name
