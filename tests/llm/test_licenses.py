"""License scans against every window in SQL, and the plan: no Python, one pass over the texts."""

import random

import duckdb
import pytest

from marketloom.llm import licenses
from marketloom.llm.queries import QUERIES, SQL
from tools import compare


def test_query_equals_sql(spark, sf_dir):
    assert compare.mismatch(QUERIES["op1_license_scan"](spark, sf_dir), compare.duck(sf_dir), SQL["op1_license_scan"]) is None


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op1_license_scan"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
    assert plan.count("regexp_extract_all") == 1 and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


@pytest.mark.parametrize("seed", range(3))
def test_damaged_notices(spark, seed):
    draw = random.Random(seed)
    docs = []
    for i in range(150):
        words = [f"w{draw.randint(0, 400)}" for _ in range(draw.randint(0, 200))]
        for _ in range(draw.randint(0, 3)):
            notice = draw.choice(list(licenses.TEMPLATES.values())).split()
            for _ in range(draw.choice([0, 0, 1, 2])):
                notice[draw.randrange(len(notice))] = "changed"
            notice = notice[draw.choice([0, 0, 1]):]
            at = draw.randint(0, len(words))
            words[at:at] = notice
        docs.append((i // 2, draw.choice([" ", "\n", ", "]).join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    assert compare.mismatch(licenses.scan(frame), con, licenses.scan_sql()) is None


def test_small_cases(spark):
    mit, cc = "RELEASED under\n the mit-license!", "Licensed under CC BY-NC 4.0."
    rows = [(None, mit), (1, None), (2, ""), (3, "under the MIT license"), (4, mit), (4, mit), (5, "word " * 100_000 + cc),
            (6, f"é {cc} {mit} {cc}")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, license string, row int")
    got = sorted((r.doc_id or 0, r.license, r.containment, r.first_word) for r in licenses.scan(docs).collect())
    assert got == [(0, "MIT", 1.0, 0), (4, "MIT", 1.0, 0), (4, "MIT", 1.0, 0), (5, "CC-BY-NC-4.0", 1.0, 100_000),
                   (6, "CC-BY-NC-4.0", 1.0, 1), (6, "MIT", 1.0, 8)]
    assert licenses.scan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(docs, {"short": "All rights reserved"})


def test_bands_give_the_wanted_probability():
    for share in (0.8, 0.9, 1.0):
        for m in (1, 2, 3, 7, 30):
            low = share * m / (licenses.window_length(m) + (1 - share) * m)
            assert 1 - (1 - low) ** licenses.bands(share, 0.9999) >= 0.9999
