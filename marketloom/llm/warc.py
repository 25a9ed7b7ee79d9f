"""Operator 5: WARC archives in which equal payloads are stored once.

Headers alone (id, payload digest) are shuffled by digest. Of equal payloads the record with the
largest id is the response; the others are joined to it and written as revisit records without a
payload, under fresh headers. Reading joins each revisit to the response it refers to.

Archives are written by Spark's own committer as text files whose lines end in the last byte of a
record, so they lie wherever Spark can write, and a lost task leaves nothing behind. The files are
WARC, records one after the other, each packed with gzip on its own (or not at all, if asked).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import maybe_among, pick, raw, steps
from marketloom.session import stored

#: Smaller payloads are always stored.
MIN_BYTES = 0
#: Payload bytes of an archive file, on average. A reader holds one file at a time.
VOLUME_BYTES = 16 << 20
#: Bytes of a record in one gzip member, below 16 MB.
MEMBER_BYTES = 8 << 20
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ROOM = uuid.uuid5(uuid.NAMESPACE_URL, "marketloom/warc")


def _key() -> Column:
    """Names a record by id and payload; never NULL."""
    return F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("sha1"))


def record_id(page_id: object, sha1: str) -> str:
    """The same for equal id and payload, however often a task runs."""
    return f"<urn:uuid:{uuid.uuid5(_ROOM, f'{page_id}:{sha1}')}>"


def base32(sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def build(page_id: object, uri: str | None, payload: bytes, sha1: str, original: object, original_uri: str | None,
          date: str, is_revisit: bool) -> bytes:
    """One record, headers to closing blank lines."""
    clean = lambda x: " ".join(x.split())  # noqa: E731  a header is one line
    head = [VERSION, f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, sha1)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base32(sha1)}", "Content-Type: text/html; charset=utf-8"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if uri is not None:
        head.append(f"WARC-Target-URI: {clean(uri)}")
    if is_revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(original, sha1)}", f"WARC-Refers-To-Date: {date}"]
        if original_uri is not None:
            head.append(f"WARC-Refers-To-Target-URI: {clean(original_uri)}")
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def packed(record: bytes) -> bytes:
    """A record as one gzip member, or several if it is very long. The last byte is zero: it counts 16 MB of content."""
    return b"".join(gzip.compress(record[i:i + MEMBER_BYTES], mtime=0) for i in range(0, len(record), MEMBER_BYTES))


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record; blocks are taken by their stated length."""
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record where one should start: {first[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        stream.read(4)  # the two closing line ends
        yield head, block


def opened(content: bytes) -> BinaryIO:
    """An archive's bytes as a stream, unpacked as it is read."""
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def originals(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``key``, ``original`` and ``original_uri`` of the records that revisit another.

    ``pages`` has page_id, uri, payload, sha1. Only digests and ids are shuffled, and the largest id of
    a digest is found before the shuffle within each task.
    """
    heads = pages.where(F.octet_length("payload") >= min_bytes).select("page_id", "sha1", "uri")
    largest = stored(heads.where("page_id is not null").groupBy("sha1").agg(
        F.max("page_id").alias("original"), F.max_by("uri", "page_id").alias("original_uri"),
        F.count(F.lit(1)).alias("n")).drop("n"), "largest")
    return (heads.select("page_id", "sha1").join(largest, "sha1")
            .where("page_id is null or page_id < original")
            .select(_key().alias("key"), "original", "original_uri").distinct())


def write(pages: DataFrame, path: str, *, min_bytes: int = MIN_BYTES, volume_bytes: int = VOLUME_BYTES,
          date: str | None = None, compression: str = "gzip", id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> None:
    """Write a record for each row to archives below ``path``, equal payloads once.

    Rows are dealt to archives by their place in ``pages``, so a payload or id that very many rows share fills no
    archive beyond the others. Payloads are shuffled once: rows that no revisit's key can name go straight to
    their archive, and of the others only headers go on after meeting their originals.

    A NULL payload is empty. A row without an id refers to the row of the largest id with its payload; if
    none has an id, all are responses. Rows that share the largest id are all responses. Other columns
    are not read. An empty table writes no record.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pick(pages, page_id=id_col, uri=uri_col, payload=payload_col).withColumn("payload", raw("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    total = rows.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    again = stored(originals(rows, min_bytes), "revisits")
    known = maybe_among(rows.withColumns({"key": _key(), "place": F.monotonically_increasing_id()}), "key", again)
    alone = known.where("not maybe").withColumns({"original": F.lit(None).cast(again.schema["original"].dataType),
                                                  "original_uri": F.lit(None).cast("string")})
    met = known.where("maybe").join(again, "key", "left")
    # The payload of a revisit is not handed on.
    ready = alone.unionByName(met).select(
        "page_id", "uri", "sha1", "original", "original_uri", "place",
        F.when(F.col("original").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"))
    dealt = ready.repartition(max(1, math.ceil(total / volume_bytes)), "place")
    in_gzip = {"gzip": True, "none": False}[compression]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "payload"):
            got = [build(r["page_id"], r["uri"], r["payload"], r["sha1"], r["original"], r["original_uri"], date,
                         r["original"] is not None) for r in batch.to_pylist()]
            got = [(packed(g) if in_gzip else g)[:-1] for g in got]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], ["value"])

    # The line separator is the last byte of each record.
    (dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.text(path, compression="none", lineSep="\0" if in_gzip else "\n"))


def read(spark: SparkSession, path: str, *, id_type: str = "bigint", with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``: page_id, record_id, record_type, uri, refers_id,
    payload_bytes and payload_digest (measured on the block of a response, stated for a revisit), payload."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for head, block in parse(opened(content.as_buffer().to_pybytes())):
                    stated = head["warc-payload-digest"].partition(":")[2]
                    response = head["warc-type"] == "response"
                    rows.append((head.get("x-page-id"), head["warc-record-id"], head["warc-type"], head.get("warc-target-uri"),
                                 head.get("warc-refers-to"), len(block) if response else None,
                                 base64.b32encode(hashlib.sha1(block).digest()).decode() if response else stated,
                                 block if with_payload and response else None))
                    size += len(block)
                    if size >= 8 << 20:
                        yield _frame(rows)
                        rows, size = [], 0
                yield _frame(rows)

    names = "page_id string, record_id string, record_type string, uri string, refers_id string, payload_bytes bigint, " \
            "payload_digest string, payload binary"
    return files.mapInArrow(run, names).withColumn("page_id", F.col("page_id").cast(id_type))


def _frame(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"page_id": pa.string(), "record_id": pa.string(), "record_type": pa.string(), "uri": pa.string(),
             "refers_id": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds.values())], list(kinds))


def resolve(records: DataFrame) -> DataFrame:
    """Records with the full payload's size (and, where read, the payload) and refers_to: the id of the response
    that a revisit refers to, found by its record id and checked by its digest. A revisit whose response is not among
    the records keeps NULLs."""
    # Kept, so that the join can split a response that very many revisits refer to.
    responses = stored(records.where("record_type = 'response'")
                 .select(F.col("record_id").alias("refers_id"), F.col("payload_digest").alias("found_digest"),
                         F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"),
                         F.col("payload").alias("full")).dropDuplicates(["refers_id"]), "responses")
    same = F.col("payload_digest") == F.col("found_digest")
    return (records.join(responses, "refers_id", "left")
            .select("page_id", "record_id", "record_type", "uri",
                    F.coalesce("payload_bytes", F.when(same, F.col("full_bytes"))).alias("payload_bytes"), "payload_digest",
                    F.when(same, F.col("refers_to")).alias("refers_to"),
                    F.coalesce("payload", F.when(same, F.col("full"))).alias("payload")))


def deduplicate(spark: SparkSession, source: str, path: str, *, min_bytes: int = MIN_BYTES, date: str | None = None) -> None:
    """Read archives, resolve their revisits, and write all records anew with each payload stored once.

    A revisit of a response that these archives don't hold can't be written anew, so it is refused.
    """
    records = stored(resolve(read(spark, source)), "records")
    if not records.where("payload is null").isEmpty():
        raise ValueError("a revisit refers to a response that is not in these archives")
    write(records, path, min_bytes=min_bytes, date=date, uri_col="uri", payload_col="payload")
