"""The pipeline: each stage's decisions take effect, and its rows equal the stages' operators by hand."""

import corpus_pipeline
from marketloom.llm import rules
from marketloom.llm.queries import QUERIES, vocabulary
from tests.llm import brute
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, at, seen = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, FOLDER)
        out.write.parquet(str(tmp_path / name))
        at = seen[name] = spark.read.parquet(str(tmp_path / name))
        assert name == "best_fit_packing" or at.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup", "substring_dedup",
                                                      "best_fit_packing"]
    texts = {n: {r.doc_id: r.text for r in df.collect()} for n, df in seen.items() if n != "best_fit_packing"}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    first = {r.doc_id: r.text for r in docs.collect()}

    # the classifier keeps good documents and drops junk, untouched
    kept = texts["quality_classifier"]
    assert all(first[d] == t for d, t in kept.items())
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.99 * len(good) and sum(d in kept for d, q in labels.items() if q == 0) <= 5

    # the base rule, by hand; cutoffs can only take more, and no more than the accepted risk
    base = {d for d, t in kept.items() if (c := brute.base_rules(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    ruled = texts["quality_rules"]
    assert ruled.keys() <= base and len(base) - len(ruled) <= rules.RISK * len(base)

    # one document of each group stays, the one of the smallest id
    rows = sorted(ruled.items())
    one = {d for d, _, c in brute.simhash(rows) if d == c}
    assert texts["simhash_near_dedup"].keys() == one

    # passages go, documents stay
    rows = sorted(texts["simhash_near_dedup"].items())
    stripped = texts["substring_dedup"]
    for d, _, gone, digest in brute.substring(rows):
        text = stripped[d]
        assert brute.sha(" ".join(brute.words_of(text))) == digest and (gone or text == ruled[d])
    assert all(r.n_chars == len(r.text) for r in seen["substring_dedup"].collect())

    # every token of every document is packed
    library = Tokenizer.from_file(vocabulary())
    lengths = {}
    for r in seen["best_fit_packing"].collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in stripped.items()}


def test_run_equals_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and set(out.columns) >= {"doc_id", "piece", "sequence_id", "offset", "length"}


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and QUERIES.keys() <= names.keys()
    assert names["pipeline"] is corpus_pipeline.run and "op1_license_scan" in __spark_entry__.oracle_sql()


def test_empty_and_null_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0)], docs.schema)
    for table, most in ((docs, 0), (odd, 3)):
        at = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, FOLDER)
            assert at.columns == docs.columns and at.count() <= most
        assert corpus_pipeline.STAGES[-1][1](spark, table, FOLDER).count() == most
