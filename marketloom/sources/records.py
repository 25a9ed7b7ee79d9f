"""Text extracts whose records may span lines, and whose unfit records are set aside instead of stopping the load.

Files are read by lines, in as many tasks as their size asks for. Whether a line starts inside a quoted value
follows from the lines before it: a line either keeps that state, turns it, or sets it. Each block of a file
(what one task reads at most) sums up its lines in one small row, the rows of a file's blocks add up to the state in
which each block starts, and only lines of blocks that hold an open value are numbered and put together. All
other lines are records already and are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import stored

UNFIT_COLUMNS = ("file", "reason", "record")
# Every repeated group is possessive: it is then matched in a loop, so lines may be of any length.
_CLOSED = r'(?:"(?:[^"]|"")*+"[^",]*+|[^",][^,]*+|)'
#: A line that starts outside quotes and ends inside them: whole values, then one that is not closed.
_OPENS = rf'^(?:{_CLOSED},)*+"(?:[^"]|"")*+$'
#: The part of a line that belongs to a value opened before, with its closing quote.
_REST = r'^(?:[^"]|"")*+"(?!")'


class UnfitRecordsError(ValueError):
    """Records that do not fit their columns, in a load that allows none."""


@dataclass(frozen=True)
class Loaded:
    """Records that fit, and the others with their file and the reason."""

    rows: DataFrame
    unfit: DataFrame


def _after(line: Column, inside: bool) -> Column:
    """1 if the line ends inside quotes, by the state in which it starts."""
    if not inside:
        return line.rlike(_OPENS).cast("int")
    # What follows the closing quote up to the next comma belongs to that value; then values start anew.
    rest = F.regexp_replace(F.regexp_replace(line, _REST, ""), r"^[^,]*+,?", "")
    return F.when(~line.rlike(_REST), 1).otherwise(rest.rlike(_OPENS).cast("int"))


def _states(lines: DataFrame) -> DataFrame:
    """from_outside, from_inside: the state after a line; lines without a quote keep it."""
    quoted = F.instr("line", '"') > 0
    return lines.withColumns({"from_outside": F.when(quoted, _after(F.col("line"), False)).otherwise(0),
                              "from_inside": F.when(quoted, _after(F.col("line"), True)).otherwise(1)})


def _running(start: Column, over: Window) -> Column:
    """The state after the rows of a window, which starts in ``start``: the last row that sets it, turned as often as
    rows after that one turn it."""
    sets = F.col("from_outside") == F.col("from_inside")
    turns = F.sum(F.when((F.col("from_outside") == 1) & (F.col("from_inside") == 0), 1).otherwise(0)).over(over)
    last = F.last(F.when(sets, F.struct(F.col("from_outside").alias("to"), F.col("turned").alias("then"))), True).over(over)
    return (F.coalesce(last["to"], start) + turns - F.coalesce(last["then"], F.lit(0))) % 2


def _with_turns(df: DataFrame, over: Window) -> DataFrame:
    turn = (F.col("from_outside") == 1) & (F.col("from_inside") == 0)
    return df.withColumn("turned", F.sum(turn.cast("int")).over(over))


def _blocks(states: DataFrame) -> DataFrame:
    """file, block, ``inside`` (the state in which the block starts), ``open`` (whether any of its lines is in or opens a
    value that goes on).

    Only lines that change the state are sorted, within their block.
    """
    block, upto = Window.partitionBy("file", "block").orderBy("at"), Window.partitionBy("file").orderBy("block")
    changing = states.where((F.col("from_outside") != 0) | (F.col("from_inside") != 1)).drop("line")
    ends = (_with_turns(changing, block)
            .withColumns({"end_outside": _running(F.lit(0), block), "end_inside": _running(F.lit(1), block)})
            .groupBy("file", "block").agg(F.max_by("end_outside", "at").alias("from_outside"),
                                          F.max_by("end_inside", "at").alias("from_inside"),
                                          F.max("from_outside").alias("opens")))
    every = (states.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines")).join(ends, ["file", "block"], "left")
             .fillna({"from_outside": 0, "from_inside": 1, "opens": 0}))
    return (_with_turns(every, upto).withColumn("end", _running(F.lit(0), upto))
            .withColumn("inside", F.coalesce(F.lag("end").over(upto), F.lit(0)))
            .select("file", "block", "inside", ((F.col("inside") == 1) | (F.col("opens") == 1)).alias("open")))


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, at, record: the records of text files, with line breaks inside quoted values as ``\\n``.

    ``block`` and ``at`` order a file's records. A value that is never closed lasts to the end of its file. Empty lines between
    records are none.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("at"))
    states = _states(lines)
    blocks = stored(_blocks(states), "blocks")
    still, busy = blocks.where(~F.col("open")).select("file", "block"), blocks.where("open").drop("open")
    if busy.isEmpty():
        return lines.where(F.trim("line") != "").select("file", "block", "at", F.col("line").alias("record"))
    whole = lines.join(still, ["file", "block"]).select("file", "block", "at", F.col("line").alias("record"))

    in_block = Window.partitionBy("file", "block").orderBy("at")
    state = (_with_turns(states.join(busy, ["file", "block"]), in_block)
             .withColumn("end", _running(F.col("inside"), in_block))
             .withColumn("begins", F.coalesce(F.lag("end").over(in_block), F.col("inside")) == 0)
             .withColumn("number", F.sum(F.col("begins").cast("int")).over(in_block)))
    # A record that goes on in later blocks counts with the block and number in which it began.
    # Per block: the last record begun in it, or in the nearest block before it that begins one.
    begun = state.groupBy("file", "block").agg(F.max("number").alias("begun"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (blocks.select("file", "block").join(begun, ["file", "block"], "left")
               .withColumn("from", F.last(F.when(F.col("begun") > 0, F.struct("block", "begun")), True).over(before))
               .select("file", "block", F.col("from.block").alias("from_block"), F.col("from.begun").alias("from_number")))
    goes_on = F.col("number") == 0
    joined = (state.join(carried, ["file", "block"])
              .select("file", F.when(goes_on, F.col("from_block")).otherwise(F.col("block")).alias("own_block"),
                      F.when(goes_on, F.col("from_number")).otherwise(F.col("number")).alias("own_number"), "block", "at", "line")
              .groupBy("file", "own_block", "own_number")
              .agg(F.min(F.struct("block", "at")).alias("place"),
                   F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("parts"))
              .select("file", "place.block", "place.at", F.array_join(F.col("parts.line"), "\n").alias("record")))
    return whole.unionByName(joined).where(F.trim("record") != "")


def load(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> Loaded:
    """Records of text files with a header each, by the columns of ``schema``; all of them text.

    A record with too few or too many values is set aside with its file and the reason ``values``; all records of a file
    whose header names other columns, with the reason ``header``. With ``strict`` one such record raises. Both tables are
    kept on shared storage, so the text is read no more.
    """
    found = records(spark, path)
    header = ",".join(schema.names)
    heads = found.groupBy("file").agg(F.min(F.struct("block", "at", "record")).alias("head"))
    heads = heads.select("file", F.col("head.block").alias("head_block"), F.col("head.at").alias("head_at"),
                         (F.regexp_replace("head.record", '"', "") == header).alias("fits"))
    corrupt = "_unfit"
    columns = ", ".join(f"{c} string" for c in [*schema.names, corrupt])
    parsed = F.from_csv("record", columns, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "quote": '"', "escape": '"',
                                            "maxCharsPerColumn": "-1"})
    body = (found.join(heads, "file").where((F.col("block") != F.col("head_block")) | (F.col("at") != F.col("head_at")) | ~F.col("fits"))
            .withColumn("v", parsed)
            .withColumn("reason", F.when(~F.col("fits"), "header").when(F.col(f"v.{corrupt}").isNotNull(), "values")))
    kept = stored(body.select("file", "reason", F.when(F.col("reason").isNotNull(), F.col("record")).alias("record"), "v"), "records")
    unfit = kept.where("reason IS NOT NULL").select(*UNFIT_COLUMNS)
    if strict and (first := unfit.first()):
        raise UnfitRecordsError(f"malformed record ({first.reason}) in {first.file}: {first.record[:200]}")
    return Loaded(kept.where("reason IS NULL").select(*[F.col(f"v.{c}").alias(c) for c in schema.names]), unfit)
