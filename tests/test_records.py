"""Extracts by records: line breaks in values, records set aside, files read in many parts."""

import csv
import random

import pytest

from marketloom.plans.rebuild import rebuild
from marketloom.bindings import messy
from marketloom.sources.extracts import load_raw, raw_schema
from marketloom.sources.records import UnfitRecordsError

NAMES = raw_schema("sellers").names
HEADER = ",".join(NAMES)


@pytest.fixture(params=["150", "128m"])
def block(spark, request):
    """Blocks shorter than many records, and blocks that hold whole files."""
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, request.param)
    yield
    spark.conf.unset(key)


def got(loaded):
    return sorted(tuple(v or "" for v in r) for r in loaded.rows.collect())


def test_equals_a_csv_reader(spark, block, tmp_path):
    pick = random.Random(3)
    values = ["a", "x,y", "two\nlines", 'q "in" it', "\n\n", "5", 'line\n"end"', ",\n,", " z ", "long\n" * 80]
    want = []
    for n, share in enumerate((0.3, 0.3, 0, 1)):
        with open(tmp_path / f"{n}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\r\n" if n % 2 else "\n")
            out.writerow(NAMES)
            for i in range(60):
                row = [pick.choice(values) if pick.random() < share else f"v{i}" for _ in NAMES]
                out.writerow(row)
                want.append(tuple(row))
    loaded = load_raw(spark, str(tmp_path), "sellers")
    assert got(loaded) == sorted(want) and loaded.unfit.count() == 0


def test_unfit_records_are_set_aside(spark, block, tmp_path, rows):
    good = 'S1,"two\nlines",,"",x\nS2,"a, ""b""",5" pipe,d,e\n'
    (tmp_path / "a.csv").write_text(HEADER + "\n" + good + 'short,row\n\nS8,"a\nb",short\n1,2,3,4,5,6\nS9,a,b,c,d\n')
    (tmp_path / "b.csv").write_text("other,header\n1,2\n")
    (tmp_path / "c.csv").write_text(HEADER + "\nS3,a,b,c,d\n" + 'S4,"never closed,b,c,d\nS5,a,b,c,d\n')
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text(HEADER)
    loaded = load_raw(spark, str(tmp_path), "sellers")
    assert sorted(rows(loaded.rows), key=str) == [
        ("S1", "two\nlines", None, None, "x"), ("S2", 'a, "b"', '5" pipe', "d", "e"), ("S3", "a", "b", "c", "d"), ("S9", "a", "b", "c", "d")]
    assert sorted((f[-5:], reason, record) for f, reason, record in rows(loaded.unfit)) == [
        ("a.csv", "values", "1,2,3,4,5,6"), ("a.csv", "values", 'S8,"a\nb",short'), ("a.csv", "values", "short,row"),
        ("b.csv", "header", "1,2"), ("b.csv", "header", "other,header"),
        ("c.csv", "values", 'S4,"never closed,b,c,d\nS5,a,b,c,d')]
    with pytest.raises(UnfitRecordsError, match="malformed"):
        load_raw(spark, str(tmp_path), "sellers", strict=True)


def test_values_of_any_length(spark, tmp_path, rows):
    wide = '"",' * 100_000
    (tmp_path / "a.csv").write_text(f'{HEADER}\nS1,"{wide}\n{wide}",b,c,d\n')
    found = load_raw(spark, str(tmp_path / "a.csv"), "sellers")
    assert rows(found.rows, "seller_name") == [((wide + "\n" + wide).replace('""', '"'),)] and found.unfit.count() == 0


def test_nothing_to_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    found = load_raw(spark, str(tmp_path), "sellers", strict=True)
    assert found.rows.columns == NAMES and found.rows.count() == found.unfit.count() == 0


def test_rebuild_goes_on_without_unfit_records(spark, sf_dir, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for name, df in messy.extracts(spark, sf_dir).items():
        df.write.csv(f"{raw}/{name}.csv", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    (tmp_path / "raw" / "sellers.csv" / "part-z.csv").write_text(HEADER + "\nS1,short\n")
    rebuild(spark, raw, out, messy.RULES, prefix="aside_", strict=False, set_aside=True)
    found = spark.table("aside_raw.unfit_records").collect()
    assert [(r.extract, r.reason, r.record) for r in found] == [("sellers", "values", "S1,short")]
    assert spark.table("aside_raw.sellers").count() == messy.extract(spark, sf_dir, "sellers").count()
