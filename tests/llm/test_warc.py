"""WARC: round trips, and the query against grouping by hand."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest

from marketloom.llm import warc
from marketloom.llm.queries import QUERIES, SQL
from tools import compare


def want(pages, min_bytes=0):
    out, largest = [], {}
    for p, _, html in pages:
        data = (html or "").encode()
        if p is not None:
            largest[data] = max(p, largest.get(data, p))
    for p, _, html in pages:
        data = (html or "").encode()
        top = largest.get(data)
        revisit = len(data) >= min_bytes and top is not None and (p is None or p < top)
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()),
                  key=str)


def test_query_on_a_whole_table(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(QUERIES["op5_warc"](spark, sf_dir)) == want(pages)


def test_query_equals_sql(spark, sf_dir):
    assert compare.mismatch(QUERIES["op5_warc"](spark, sf_dir), compare.duck(sf_dir), SQL["op5_warc"]) is None


PAGES = [(1, "http://a/\n x", "same"), (2, None, "same"), (3, "u", "same"), (None, "u", "same"), (4, "u", ""), (5, "u", None),
         (6, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n\r\n"), (6, "u", "é\n\r\n"),
         (None, "u", "alone"), (None, "v", "alone"), (7, "u", "x" * 3_000_000), (8, "u", "x" * 3_000_000), (8, "u", "x" * 3_000_000)]
SHAPE = "page_id long, url string, html string"


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "z", i) for i, p in enumerate(PAGES)], f"{SHAPE}, payload string, sha1 int")
    for k, least in enumerate((0, 5)):
        path = str(tmp_path / f"out{k}")
        warc.write(pages, path, min_bytes=least, volume_bytes=2 << 20)
        done = warc.resolve(warc.read(spark, path))
        assert got(done) == want(PAGES, least)
        assert sorted((r.page_id or 0, bytes(r.payload)) for r in done.collect()) == sorted(
            (p or 0, (h or "").encode()) for p, _, h in PAGES)
    stored = warc.read(spark, str(tmp_path / "out0")).where("record_type = 'response'").agg({"payload_bytes": "sum"}).first()[0]
    assert stored < 2 * 3_000_000 + 200 * 1000


def test_archives_are_deduplicated(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SHAPE)
    warc.write(pages, str(tmp_path / "all"), min_bytes=1 << 40)  # everything stored
    first = warc.read(spark, str(tmp_path / "all"))
    assert {r.record_type for r in first.collect()} == {"response"} and first.count() == len(PAGES)
    warc.deduplicate(spark, str(tmp_path / "all"), str(tmp_path / "once"))
    assert got(warc.resolve(warc.read(spark, str(tmp_path / "once")))) == want(PAGES)
    warc.deduplicate(spark, str(tmp_path / "once"), str(tmp_path / "twice"))
    assert got(warc.resolve(warc.read(spark, str(tmp_path / "twice")))) == want(PAGES)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_files_are_warc(spark, tmp_path, compression):
    warc.write(spark.createDataFrame(PAGES, SHAPE), str(tmp_path / "out"), date="2024-01-02T03:04:05Z", compression=compression)
    files = sorted((tmp_path / "out").glob("part-*"))
    plain = [gzip.decompress(f.read_bytes()) if compression == "gzip" else f.read_bytes() for f in files]
    heads = [h for p in plain for h, _ in warc.parse(io.BytesIO(p))]
    assert len(heads) == len(PAGES) and {h["warc-date"] for h in heads} == {"2024-01-02T03:04:05Z"}
    assert all(h["warc-profile"] == warc.PROFILE for h in heads if h["warc-type"] == "revisit")
    assert warc.read(spark, str(tmp_path / "out")).count() == len(PAGES)


def test_empty(spark, tmp_path):
    warc.write(spark.createDataFrame([], SHAPE), str(tmp_path / "none"))
    assert warc.resolve(warc.read(spark, str(tmp_path / "none"))).count() == 0


def test_hot_payload_fills_no_archive(spark, tmp_path):
    """Equal pages without an id are all responses; copies with ids are revisits; both spread over files of bounded size."""
    draw = random.Random(3)
    html = "".join(draw.choice("abcdefghijklmnop <>&") for _ in range(300))
    pages = spark.range(0, 100_000, 1, 8).selectExpr(
        "if(id % 3 = 0, null, id) as page_id", "'u' as url", f"if(id % 3 < 2, '{html}', repeat(string(id), 40)) as html")
    pages = pages.where("not (page_id is not null and page_id % 3 = 1)").unionByName(
        spark.range(0, 20_000, 1, 4).selectExpr("id * 3 + 1 as page_id", "'v' as url", "'shared by many' as html"))
    volume = 1 << 20
    warc.write(pages, str(tmp_path / "out"), volume_bytes=volume, compression="none")
    sizes = [f.stat().st_size for f in (tmp_path / "out").glob("part-*")]
    assert len(sizes) > 10 and max(sizes) < 2 * sum(sizes) / len(sizes)
    counted = {(r.record_type, r["count"]) for r in warc.read(spark, str(tmp_path / "out"), with_payload=False).groupBy("record_type").count().collect()}
    assert counted == {("response", 66_667 + 1), ("revisit", 19_999)}


def test_each_record_is_a_gzip_member(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * (3_000_000 if i == 3 else 9)) for i in range(6)], SHAPE).repartition(1)
    warc.write(pages, str(tmp_path / "out"))
    members = 0
    for f in (tmp_path / "out").glob("part-*"):
        data = f.read_bytes()
        while data:
            one = zlib.decompressobj(31)
            part = one.decompress(data)
            members += part.startswith(b"WARC/")
            data = one.unused_data
    assert members == 6
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, str(tmp_path / "out")).collect()}
    assert got == {r.page_id: r.html for r in pages.collect()}
