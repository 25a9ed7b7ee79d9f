"""Operator 10: quality rules whose cutoffs are chosen under a risk limit.

Each rule compares a ratio of a text with a cutoff. Cutoffs come from a fixed ladder, lenient to
strict. On labelled documents a step of a ladder is safe if the chance of seeing as few false
rejections as were seen, were their true share at the limit, is small enough: the exact binomial tail,
that is, the Clopper-Pearson bound lies below the limit. Every stratum and rule is walked from its lenient end and stops
at the first unsafe step (so a ladder counts as one test), and the level is divided by the
number of strata and rules (Bonferroni). The limit is divided by the number of rules, so the rules
together reject at most ``risk`` of a stratum's good documents, in all strata at once, with
probability 1 - ``level``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import numbered, pick, place, raw, steps
from marketloom.session import stored

#: The base rule.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
#: Accepted share of good documents rejected in a stratum, and the chance that the promise fails.
RISK, LEVEL = 0.03, 0.05
#: Bad documents that must go for each good one that goes along.
FALSE_WEIGHT = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words")


def _per_word(count: str) -> Callable[[], Column]:
    return lambda: F.col(count) / F.greatest(F.col("n_words"), F.lit(1))


#: Rules: a ratio, and its ladder of cutoffs above which (or for short words below which) a text goes.
RULES: dict[str, tuple[Callable[[], Column], list[float]]] = {
    "symbols": (_per_word("n_symbols"), [2.0, 1.0, 0.5, 0.25, 0.15, 0.1, 0.05]),
    "long_words": (_per_word("word_chars"), [20.0, 15.0, 12.0, 10.0, 9.0, 8.0]),
    "short_words": (lambda: F.when(F.col("n_words") > 0, -F.col("word_chars") / F.col("n_words")).otherwise(0.0),
                    [-1.5, -2.0, -2.5, -3.0]),
    "repeat_words": (_per_word("n_repeat_words"), [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    "dup_lines": (lambda: F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), [0.9, 0.7, 0.5, 0.4, 0.3]),
    "upper_words": (_per_word("n_upper_words"), [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
}

_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)


def count(text: bytes) -> tuple[int, ...]:
    """COUNTS of one whole text."""
    words = text.split()
    n = len(words)
    chars = sum(map(len, words)) if text.isascii() else len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text.translate(None, _NOT_SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.split()] if b"\n" in text else [text][:n]
    again = len(lines) - len(set(lines))
    repeated = 0
    if n >= 4:
        grams = list(zip(words, words[1:], words[2:]))
        if len(set(grams)) < len(grams):
            seen, twice = set(), set()
            for g in grams:
                (twice if g in seen else seen).add(g)
            reach = 0
            for i, g in enumerate(grams):
                if g in twice:
                    repeated += i + 3 - max(i, reach)
                    reach = i + 3
    upper = sum([w.isupper() for w in words])  # of bytes: some of A-Z and none of a-z
    return n, chars, symbols, again, repeated, len(lines), upper


def measured(rows: DataFrame) -> DataFrame:
    """Add COUNTS to rows with a binary column ``raw`` (dropped), in one pass over whole texts."""
    others = [f for f in rows.schema.fields if f.name != "raw"]
    names = [f.name for f in others]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "raw"):
            counts = np.array([count(t) for t in batch.column("raw").to_pylist()], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *[pa.array(c) for c in counts.T]],
                                             [*names, *COUNTS])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return rows.mapInArrow(run, f"{shape}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed exactly term by term."""
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
           for i in range(k + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in log))


def safe_steps(rejected: list[int], n: int, limit: float, level: float) -> int:
    """How many steps of a ladder can be taken: false rejections by step among n good documents."""
    for taken, k in enumerate(rejected):
        # Beyond the expected number the tail is never small; the sum need not be made.
        if k > limit * n or binomial_tail(k, n, limit) > level:
            return taken
    return len(rejected)


def thresholds(holdout: DataFrame, *, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """``stratum``, ``rule``, ``cutoff``, ``good`` and ``false_rejections`` of the cutoffs chosen.

    ``holdout`` has stratum, COUNTS and good (boolean). Only documents that pass the base rule count.
    It shrinks to one row per stratum before anything is decided. All steps up to the last safe one
    are safe together, so among them the one that sorts best may be taken: most bad documents less
    FALSE_WEIGHT times the good ones, the more lenient on ties. A stratum with too few good documents to
    prove anything gets no cutoff, so no rule rejects there.
    """
    share = risk / len(RULES)
    limits = [value() > c for value, ladder in RULES.values() for c in ladder]
    tested = stored(
        holdout.where(~base_failed()).groupBy("stratum").agg(
            F.count_if("good").alias("n"),
            F.array(*[F.count_if(F.col("good") & x) for x in limits]).alias("good_out"),
            F.array(*[F.count_if(~F.col("good") & x) for x in limits]).alias("bad_out"))
        # Where not even a clean holdout could pass, nothing is tested and no share of the level is used.
        .where(F.col("n") >= math.log(1 / level) / -math.log1p(-share)), "tested")
    ladders = {r: ladder for r, (_, ladder) in RULES.items()}
    each = level / max(1, tested.count() * len(RULES))

    def decide(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                at = 0
                for rule, ladder in ladders.items():
                    good, bad = ([int(x) for x in a[at:at + len(ladder)]] for a in (row.good_out, row.bad_out))
                    at += len(ladder)
                    taken = safe_steps(good, row.n, share, each)
                    gain = [b - FALSE_WEIGHT * g for g, b in zip(good, bad)][:taken]
                    if gain and max(gain) > 0:
                        best = gain.index(max(gain))
                        out.append((row.stratum, rule, ladder[best], row.n, good[best]))
            yield pd.DataFrame(out, columns=["stratum", "rule", "cutoff", "good", "false_rejections"])

    kind = holdout.schema["stratum"].dataType.simpleString()
    return tested.mapInPandas(decide, f"stratum {kind}, rule string, cutoff double, good bigint, false_rejections bigint")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows whose doc_id has a label, with ``good``: all its labels say quality 1. NULL labels say nothing."""
    verdicts = (pick(labels, doc_id="doc_id", quality="quality").where("doc_id is not null and quality is not null")
                .groupBy("doc_id").agg((F.min("quality") >= 1).alias("good")))
    return rows.join(verdicts, "doc_id")


def _judged(counts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Add base_failed, failed_rules and kept."""
    wide = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES])
    joined = counts.join(wide.withColumnRenamed("stratum", "own_stratum"),
                         F.col("stratum").eqNullSafe(F.col("own_stratum")), "left")
    failed = F.array_compact(F.array(*[F.when(value() > F.col(f"max_{r}"), F.lit(r)) for r, (value, _) in RULES.items()]))
    return (joined.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .drop("own_stratum", *[f"max_{r}" for r in RULES]))


def judge(docs: DataFrame, labels: DataFrame, *, risk: float = RISK, level: float = LEVEL, id_col: str = "doc_id",
          text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, COUNTS, base_failed, failed_rules and ``kept`` of every row, repeated rows included.

    A text is measured once, whole; NULL counts as empty (and so fails the base rule). A NULL stratum
    is a stratum of its own. Without labels the base rule alone decides. Documents are never dealt
    out by stratum unless the optimizer finds the few cutoffs too large to broadcast.
    """
    rows = pick(docs, doc_id=id_col, raw=text_col, stratum=stratum_col).withColumn("raw", raw("raw"))
    counts = stored(measured(rows), "counts")
    cutoffs = stored(thresholds(labelled(counts, labels), risk=risk, level=level), "cutoffs")
    return _judged(counts, cutoffs)


def accepted(docs: DataFrame, labels: DataFrame, *, risk: float = RISK, level: float = LEVEL, id_col: str = "doc_id",
             text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were."""
    names = docs.columns
    at = {new: f"c{place(names, c)}" for new, c in (("doc_id", id_col), ("text", text_col), ("stratum", stratum_col))}
    rows = numbered(docs).withColumns({"doc_id": F.col(at["doc_id"]), "raw": raw(at["text"]), "stratum": F.col(at["stratum"])})
    counts = stored(measured(rows), "counts")
    cutoffs = stored(thresholds(labelled(counts.select("doc_id", "stratum", *COUNTS), labels), risk=risk, level=level), "cutoffs")
    return _judged(counts, cutoffs).where("kept").select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def judge_sql(risk: float = RISK, level: float = LEVEL) -> str:
    """The same counts, cutoffs and verdicts in SQL, over ``documents`` and ``labels`` with ``lang`` as stratum."""
    values = {
        "symbols": "n_symbols / greatest(n_words, 1)", "long_words": "word_chars / greatest(n_words, 1)",
        "short_words": "CASE WHEN n_words > 0 THEN -word_chars / n_words ELSE 0 END",
        "repeat_words": "n_repeat_words / greatest(n_words, 1)", "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
        "upper_words": "n_upper_words / greatest(n_words, 1)"}
    ladders = ", ".join(f"('{r}', {k}, {c}::DOUBLE)" for r, (_, ladder) in RULES.items() for k, c in enumerate(ladder))
    value = " ".join(f"WHEN '{r}' THEN {e}" for r, e in values.items())
    share, word = risk / len(RULES), r"[^\x20\x09-\x0D]"
    return f"""
WITH ladders(rule, step, cutoff) AS (VALUES {ladders}),
texts AS (SELECT row_number() OVER () AS r, doc_id, lang, COALESCE(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '{word}+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM texts),
grams AS (SELECT r, unnest(generate_series(1, len(w) - 2)) AS i,
                 unnest(list_transform(generate_series(1, len(w) - 2), lambda i: w[i:i + 2])) AS g FROM split WHERE len(w) >= 3),
again AS (SELECT r, COUNT(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p
          FROM (SELECT r, i, COUNT(*) OVER (PARTITION BY r, g) AS times FROM grams) WHERE times > 1) GROUP BY r),
counts AS (SELECT r, doc_id, lang, len(w)::BIGINT AS n_words, COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, COALESCE(again.n, 0)::BIGINT AS n_repeat_words,
                  len(lines) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper_words
           FROM split LEFT JOIN again USING (r)),
based AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts),
valued AS (SELECT r, lang, base_failed, doc_id, rule, step, cutoff, CASE rule {value} END > cutoff AS is_out FROM based CROSS JOIN ladders),
good AS (SELECT doc_id, MIN(quality) >= 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
holdout AS (SELECT lang, rule, step, cutoff, COUNT(*) FILTER (good) AS n, COUNT(*) FILTER (good AND is_out) AS k,
                   COUNT(*) FILTER (NOT good AND is_out) AS bad
            FROM valued JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY ALL),
able AS (SELECT *, (SELECT COUNT(*) FROM (SELECT DISTINCT lang FROM holdout WHERE n >= {math.log(1 / level) / -math.log1p(-share)})) AS strata
         FROM holdout WHERE n >= {math.log(1 / level) / -math.log1p(-share)}),
judged AS (SELECT *, k <= {share} * n AND list_sum(list_transform(generate_series(0, k), lambda i: exp(
               lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share}) + (n - i) * ln(1 - {share}))))
               <= {level} / (strata * {len(RULES)}) AS safe FROM able),
walked AS (SELECT *, MIN(CASE WHEN safe THEN 1 ELSE 0 END) OVER (PARTITION BY lang, rule ORDER BY step) AS reached,
                  bad - {FALSE_WEIGHT} * k AS gain FROM judged),
chosen AS (SELECT lang, rule, ARG_MAX(cutoff, (gain, -step)) AS cutoff FROM walked WHERE reached = 1 GROUP BY lang, rule HAVING MAX(gain) > 0),
rejected AS (SELECT DISTINCT r FROM valued v JOIN chosen c ON v.lang IS NOT DISTINCT FROM c.lang AND v.rule = c.rule
             AND v.cutoff = c.cutoff WHERE is_out)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM rejected) AS kept FROM based"""
