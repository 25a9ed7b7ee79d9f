"""Run every query beside its SQL answer and compare names, types and values.

    python tools/compare.py /root/testdata/sf0.01 [query ...]

COMPARE_CONF sets session settings, for instance spark.sql.autoBroadcastJoinThreshold=-1 for the joins
that large data takes.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from marketloom.session import build_session  # noqa: E402
from queries import load_all  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SAME_TYPE = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def mismatch(df, con, sql: str) -> str | None:
    """None if both sides agree, else the first difference."""
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want_rows = cur.fetchall()
    got_types = {f.name: SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    names = sorted(want_types)
    if names != sorted(got_types):
        return f"columns {sorted(got_types)} instead of {names}"
    different = {n: (got_types[n], want_types[n]) for n in names if got_types[n] != want_types[n]}
    place = {d: i for i, d in enumerate(want_types)}
    want = _sorted([tuple(r[place[n]] for n in names) for r in want_rows])
    got = _sorted([tuple(r[n] for n in names) for r in df.collect()])
    if len(want) != len(got):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {dict(zip(names, g))} instead of {dict(zip(names, w))}"
    return f"types (got, wanted) {different}" if different else None


def main() -> int:
    folder, only = sys.argv[1], set(sys.argv[2:])
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    for setting in filter(None, os.environ.get("COMPARE_CONF", "").split(",")):
        spark.conf.set(*setting.split("=", 1))
    con, bad = duck(folder), 0
    for name, q in load_all().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = mismatch(q.run(spark, folder), con, q.sql) if q.sql else f"no SQL, {q.run(spark, folder).count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} not equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
