"""Exported results as CSV."""

from __future__ import annotations

import csv
import io
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import run_at_once

#: Where the header of an export in parts lies; readers skip names that begin so.
HEADER = "_header"


def plain_types(df: DataFrame) -> DataFrame:
    """Flags as 0 and 1; everything else as it is."""
    flags = {f.name: F.col(f.name).cast("int") for f in df.schema if isinstance(f.dataType, T.BooleanType)}
    return df.withColumns(flags) if flags else df


def export_view(df: DataFrame, folder: str, name: str, in_parts: bool = False) -> str:
    """Rows ordered by all columns, NULL as an empty field.

    One file with its header, which one task writes: right for aggregates. ``in_parts`` is for results
    that grow with the data: the sorted ranges go to consecutive part files without a header, and the header lies in
    a folder of its own. Header and parts by name, put together, are the same bytes on every run, however many
    parts there are.
    """
    path = f"{folder.rstrip('/')}/{name}"
    plain = plain_types(df)
    rows = plain.orderBy(*plain.columns)
    (rows if in_parts else rows.coalesce(1)).write.mode("overwrite").csv(
        path, header=not in_parts, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if in_parts:
        line = io.StringIO()
        csv.writer(line, lineterminator="").writerow(plain.columns)
        header = df.sparkSession.range(1).select(F.lit(line.getvalue()))
        header.coalesce(1).write.mode("overwrite").text(f"{path}/{HEADER}")
    return path


def export_views(views: Mapping[str, DataFrame], folder: str, in_parts: Collection[str] = (), at_once: int = 4) -> dict[str, str]:
    """Export many views, a few jobs at a time: most are small and would leave the cluster idle."""
    return dict(zip(views, run_at_once(lambda item: export_view(item[1], folder, item[0], item[0] in in_parts),
                                       views.items(), at_once)))
