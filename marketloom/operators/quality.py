"""Data-quality checks: declared per table, answered by one ledger of keys and faults.

Every table is read once and turned into ledger lines: one for each key that a check asks about, tagged with
the table it came from, and one for each fault of the row itself. A line is a number, which says what is counted
in which slot, and a text; it is made by unpivoting the row, which builds no array or struct for it. Lines are
counted per key before and after one shuffle; then a key's counts tell how often each table holds it, and so which
rows repeat a key or lack a parent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARNING = "(warning)"


@dataclass(frozen=True)
class Check:
    """Rows of a table that fail a condition of their own."""

    name: str
    failing: Column


@dataclass(frozen=True)
class UniqueCheck:
    """Rows of a table beyond one per key. NULL keys are all in excess."""

    name: str
    key: str


@dataclass(frozen=True)
class ForeignKeyCheck:
    """Rows of a table whose key has no row in the parent table, NULL keys included."""

    name: str
    parent: str
    key: str


def _named(name: str, warn: bool) -> str:
    return f"{name} {WARNING}" if warn else name


def check_unique(name: str, key: str, warn: bool = False) -> UniqueCheck:
    """F1, F8, F14."""
    return UniqueCheck(_named(name, warn), key)


def check_not_null(name: str, column: str, warn: bool = False) -> Check:
    """F2, F3, F4, F9, F17."""
    return Check(_named(name, warn), F.col(column).isNull())


def check_predicate(name: str, bad: Column, warn: bool = False) -> Check:
    """An unknown outcome passes."""
    return Check(_named(name, warn), bad)


def check_in_set(name: str, column: str, values: Sequence[str], warn: bool = False) -> Check:
    """NULL passes."""
    return Check(_named(name, warn), ~F.col(column).isin(*values))


def check_fk(name: str, parent: str, key: str, warn: bool = False) -> ForeignKeyCheck:
    """F7, F12, F13."""
    return ForeignKeyCheck(_named(name, warn), parent, key)


AnyCheck = Check | UniqueCheck | ForeignKeyCheck


class _Ledger:
    """Subjects (a key column, or a row's own fault), and the slots in which tables are counted under each."""

    def __init__(self) -> None:
        self.subjects: dict[str, dict[str, int]] = {}

    def slot(self, subject: str, table: str) -> tuple[int, int]:
        """The number of a subject, and that of a table's counts under it."""
        slots = self.subjects.setdefault(subject, {})
        return list(self.subjects).index(subject), slots.setdefault(table, len(slots))

    @property
    def width(self) -> int:
        return max((len(s) for s in self.subjects.values()), default=1)


def _lines(df: DataFrame, keys: Mapping[int, Column], faults: Mapping[int, Column]) -> DataFrame:
    """line, key: every row's keys as text, NULL ones too, and a line with an empty text for each fault that it has."""
    texts = {n: key.cast("string") for n, key in keys.items()} | {n: F.when(bad, F.lit("")) for n, bad in faults.items()}
    entered = df.select(*[text.alias(str(n)) for n, text in texts.items()]).unpivot([], [str(n) for n in texts], "line", "key")
    return entered.where(F.col("key").isNotNull() | F.col("line").isin(*map(str, keys)))


def run_checks(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[AnyCheck]]) -> DataFrame:
    """check_name, failing_rows, result for every declared check.

    Keys of one name are the same thing in all tables, and are compared as text. Each table is scanned once, and all
    checks together take one shuffle, of one row for each key and map task.
    """
    ledger = _Ledger()
    keys: dict[str, dict[tuple[int, int], Column]] = {}
    faults: dict[str, dict[tuple[int, int], Column]] = {}
    totals: list[tuple[str, Column]] = []

    def note(kind: dict[str, dict[tuple[int, int], Column]], table: str, subject: str, entry: Column) -> tuple[Column, Column]:
        """Enter a line for each row of the table; its subject's rows of the ledger, and the table's count in them."""
        at, slot = ledger.slot(subject, table)
        kind.setdefault(table, {}).setdefault((at, slot), entry)
        return F.col("subject") == at, F.col(f"n{slot}")

    for table, declared in checks.items():
        for check in declared:
            if isinstance(check, Check):
                own, n = note(faults, table, f"fault {len(ledger.subjects)}", check.failing)
                totals.append((check.name, F.sum(F.when(own, n))))
                continue
            subject = f"key {check.key}"
            own, n = note(keys, table, subject, F.col(check.key))
            if isinstance(check, UniqueCheck):
                once = F.when(F.col("key").isNotNull() & (n > 0), 1).otherwise(0)
                totals.append((check.name, F.sum(F.when(own, n - once))))
            else:
                _, parents = note(keys, check.parent, subject, F.col(check.key))
                totals.append((check.name, F.sum(F.when(own & (F.col("key").isNull() | (parents == 0)), n))))

    def numbered(entries: Mapping[tuple[int, int], Column]) -> dict[int, Column]:
        return {at * ledger.width + slot: entry for (at, slot), entry in entries.items()}

    entered = reduce(DataFrame.unionByName, [
        _lines(tables[t], numbered(keys.get(t, {})), numbered(faults.get(t, {}))) for t in dict.fromkeys([*keys, *faults])])
    line = F.col("line").cast("int")
    placed = entered.select(F.floor(line / ledger.width).cast("int").alias("subject"), (line % ledger.width).alias("slot"), "key")
    counted = placed.groupBy("subject", "key").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(ledger.width)])
    answers = counted.agg(*[F.coalesce(t, F.lit(0)).cast("bigint").alias(f"c{i}") for i, (_, t) in enumerate(totals)])
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("failing_rows")) for i, (name, _) in enumerate(totals)])
    return with_verdict(answers.select(F.inline(rows)))


def with_verdict(checks: DataFrame) -> DataFrame:
    """PASS without failing rows, else WARN for warnings and FAIL for the rest."""
    verdict = (F.when(F.col("failing_rows") == 0, "PASS")
               .when(F.col("check_name").contains(WARNING), "WARN").otherwise("FAIL"))
    return checks.withColumn("result", verdict)


class QualityGateError(RuntimeError):
    """At least one check failed."""


def failed(checks: DataFrame) -> DataFrame:
    """the checks that a gate does not let pass, by name."""
    return checks.where(F.col("result") == "FAIL").orderBy("check_name")


def gate(checks: DataFrame) -> None:
    """raise if any check failed. The checks table has one row per check."""
    names = [r.check_name for r in failed(checks).collect()]
    if names:
        raise QualityGateError(f"{len(names)} quality check(s) failed: {', '.join(names)}")
