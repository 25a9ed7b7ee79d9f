"""The operators as queries over the given tables, with their answers in SQL where SQL can give them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import (bpe, classifier, clusters, graph_search, licenses, main_text, packing, periodic, rules, shards, simhash, substring,
                            warc)
from marketloom.session import fresh_folder, stored

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(run: Run) -> Run:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


@query
def op1_license_scan(spark, folder):
    return licenses.scan(table(spark, folder, "documents"))


SQL["op1_license_scan"] = licenses.scan_sql()


@query
def op2_quality_classifier(spark, folder):
    return classifier.classify(table(spark, folder, "documents"))


@query
def op3_graph_nearest_neighbours(spark, folder):
    return graph_search.nearest(table(spark, folder, "embeddings"))


#: Shards of the sharding query.
SHARDS = [f"shard-{i:03d}" for i in range(256)]


@query
def op4_sharding(spark, folder):
    """Place of each document, and where it goes when the last shard is lost."""
    placed = shards.assign(table(spark, folder, "documents").select("doc_id"), "doc_id", SHARDS)
    after = shards.table_frame(spark, SHARDS[:-1], name="shard_after_loss")
    return placed.join(F.broadcast(after), "slot").select("doc_id", "slot", "shard", "shard_after_loss")


@query
def op5_warc(spark, folder):
    path = fresh_folder(spark, "warc")
    warc.write(table(spark, folder, "pages"), path)
    records = stored(warc.read(spark, path, with_payload=False), "records")
    return warc.resolve(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# 40 hex digits are eight times five, and five are four digits to base 32.
SQL["op5_warc"] = """
WITH hashed AS (SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes, sha1(COALESCE(html, '')) AS h FROM pages),
     grouped AS (SELECT *, MAX(page_id) OVER (PARTITION BY h) AS top FROM hashed)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM grouped"""


@query
def op6_simhash_near_dedup(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op7_best_fit_packing(spark, folder):
    cut = packing.pieces(table(spark, folder, "documents"), vocabulary(), keep_ids=False)
    return packing.pack(cut)


@query
def op8_substring_dedup(spark, folder):
    done = substring.repeats(table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("clean_text"), 256).alias("kept_sha256"))


SQL["op8_substring_dedup"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     windows AS (SELECT r, doc_id, unnest(generate_series(1, len(w) - 49)) AS i, unnest(list_transform(
                     generate_series(1, len(w) - 49), lambda i: sha256(array_to_string(w[i:i + 49], ' ')))) AS h
                 FROM docs WHERE len(w) >= 50),
     judged AS (SELECT r, doc_id, i, MIN(doc_id) OVER (PARTITION BY h) AS first FROM windows),
     gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 49)) AS p FROM judged WHERE first < doc_id),
     words AS (SELECT r, unnest(generate_series(1, len(w))) AS p, unnest(w) AS word FROM docs),
     kept AS (SELECT r, COUNT(gone.p) AS n, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS clean
              FROM words LEFT JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, COALESCE(n, 0) AS n_removed, sha256(COALESCE(clean, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""


@query
def op9_bpe_encode_decode(spark, folder):
    path = vocabulary()
    done = bpe.decode(bpe.encode(table(spark, folder, "documents"), path), path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(decimal, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query
def op10_quality_rules(spark, folder):
    judged = rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


SQL["op10_quality_rules"] = rules.judge_sql()


WORD = r"([^\x20\x09-\x0D]+)"


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the texts of about a tenth of the ids repeat some of their words up to their end."""
    words, n = F.col("words"), F.size("words")
    start = F.pmod(F.col("g"), n)
    period = F.expr("1 + (size(words) - g % size(words)) div (3 + g % 8)")
    tail = F.transform(F.sequence(start, n - 1), lambda i: F.get(words, (start + F.pmod(i - start, period)).cast("int")))
    text = F.coalesce(F.col("text"), F.lit(""))
    chosen = (F.col("h") % 10 == 0) & F.col("text").rlike(WORD)
    return (docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
            .withColumn("g", F.expr("h div 10"))
            .withColumn("words", F.when(chosen, F.regexp_extract_all(text, F.lit(WORD))))
            .select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(
                F.concat(F.slice(words, 1, start.cast("int")), tail), " ")).otherwise(F.col("text")).alias("text")))


@query
def op11_periodic_runs(spark, folder):
    found = periodic.runs(looped(table(spark, folder, "documents")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op12_centroid_clustering(spark, folder):
    found = clusters.cluster(table(spark, folder, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256).alias("centroid_sha256"))


SQL["op12_centroid_clustering"] = clusters.cluster_sql()


@query
def op13_main_text(spark, folder):
    return main_text.main_text(table(spark, folder, "pages"))


# The given pages hold one article of headings and paragraphs each, and references that these replacements cover.
SQL["op13_main_text"] = r"""
WITH found AS (SELECT page_id, url, regexp_extract(COALESCE(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS a FROM pages),
     blocks AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(a, '</?(p|h[1-6]|div|ul|li)[^>]*>'), lambda b: trim(
         regexp_replace(regexp_replace(regexp_replace(b, '<br ?/?>', ' ', 'g'), '<[^>]*>', '', 'g'), '[\s\x0B]+', ' ', 'g'))), lambda b: b <> '') AS b FROM found),
     texts AS (SELECT page_id, url, replace(replace(replace(replace(regexp_replace(array_to_string(b, chr(10)), '&(amp|quot|lt|gt);?', '&\1;', 'g'),
         '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS text FROM blocks)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts"""
