"""Stored layers and views."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import file_system, run_at_once

LAYERS = ("raw", "clean", "mart")
VIEW_PREFIX = "v_"
#: Earlier versions of a table that stay for those who are still reading them.
KEPT_VERSIONS = 1
_VERSION = "version-"
# Ends the name of a folder column whose values are text behind a mark.
_TEXT = "__text"


class LayerClashError(ValueError):
    """A database of that name holds the layer of another warehouse."""


def _place(uri: str) -> str:
    """A location without scheme and host, for comparison."""
    return "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", uri).strip("/")


@dataclass(frozen=True)
class Warehouse:
    """Layers as databases of Parquet tables below one shared folder.

    Every table is written below ``root``, whatever the catalog holds. Two warehouses on one catalog need
    different prefixes.

    A table is a folder of versions. A new version is written beside the old one, and counts once its
    success marker is there; only then the catalog's entry, which names one version, is moved in one step. So a write that
    fails halfway changes nothing, and a table can be replaced by a query over itself.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def folder(self, layer: str, name: str = "") -> str:
        return f"{self.root.rstrip('/')}/{layer}" + f"/{name}" * bool(name)

    def ensure_layers(self) -> None:
        """A4. Raises if a database of this prefix lies elsewhere."""
        for layer in LAYERS:
            name = self.database(layer)
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{self.folder(layer)}'")
            found = self.spark.catalog.getDatabase(name).locationUri
            if _place(found) != _place(self.folder(layer)):
                raise LayerClashError(f"database {name} lies in {found}; choose another prefix for {self.root}")

    def write_layer(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """A3: store a table in place of any earlier one and hand back the stored table.

        Rows of one partition value gather before writing, so a date holds few files; adaptive
        execution splits values that are too large for one task.
        """
        texts = [f.name for f in df.schema.fields if f.name in partition_by and isinstance(f.dataType, T.StringType)]
        # Folder names are read back by their looks, so text is marked as such: '007' and '' are no number and no NULL.
        out = df.withColumns({c + _TEXT: F.concat(F.lit("_"), c) for c in texts}).drop(*texts)
        folders = [c + _TEXT if c in texts else c for c in partition_by]
        spread = out.hint("rebalance", *[F.col(c) for c in folders]) if folders else out
        version = f"{self.folder(layer, name)}/{_VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        spread.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(version, partitionBy=folders or None)
        columns = [f"substring(`{f.name}{_TEXT}`, 2) AS `{f.name}`" if f.name in texts else
                   f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" if f.name in partition_by else f"`{f.name}`"
                   for f in df.schema.fields]
        self._point(f"{self.database(layer)}.{name}", version, columns, out)
        self._forget(layer, name)
        return self.spark.read.schema(out.schema).parquet(version).selectExpr(*columns)

    def _point(self, table: str, version: str, columns: Sequence[str], written: DataFrame) -> None:
        """Make the catalog's entry name this version."""
        if self.spark.catalog.tableExists(table) and self.spark.catalog.getTable(table).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {table}")
        source = f"parquet.`{version}`"
        if self.spark.read.schema(written.schema).parquet(version).isEmpty():  # there may be no file that names the columns
            nothing = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in written.schema.fields]
            source = f"(SELECT {', '.join(nothing)}) WHERE FALSE"
        self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {', '.join(columns)} FROM {source}")

    def versions(self, layer: str, name: str) -> list[str]:
        """Folders of the table's complete versions, oldest first."""
        files, home = file_system(self.spark, self.folder(layer, name))
        found = sorted(f.getPath().toString() for f in files.listStatus(home)) if files.exists(home) else []
        return [v for v in found if v.rsplit("/", 1)[-1].startswith(_VERSION) and files.exists(file_system(self.spark, f"{v}/_SUCCESS")[1])]

    def _forget(self, layer: str, name: str) -> None:
        """Delete what is older than the versions that stay, unfinished writes included."""
        stay = self.versions(layer, name)[-1 - KEPT_VERSIONS:]
        files, home = file_system(self.spark, self.folder(layer, name))
        for f in files.listStatus(home):
            if stay and f.getPath().toString() < stay[0]:
                files.delete(f.getPath(), True)

    def read_layer(self, layer: str, name: str) -> DataFrame:
        """The latest complete version of a table, without asking the catalog."""
        versions = self.versions(layer, name)
        if not versions:
            raise FileNotFoundError(f"no table {name} in {self.folder(layer)}")
        found = self.spark.read.parquet(versions[-1])
        return found.selectExpr(*[f"substring(`{c}`, 2) AS `{c.removesuffix(_TEXT)}`" if c.endswith(_TEXT) else f"`{c}`" for c in found.columns])

    def drop(self) -> None:
        """Remove the databases of this prefix with all that is in them."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")

    def register_views(self, views: Mapping[str, DataFrame]) -> None:
        """A5: every view under a name that SQL can use in this session, evaluated when it is read."""
        for name, df in views.items():
            df.createOrReplaceTempView(VIEW_PREFIX + name)

    def save_views(self, views: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """A5, kept: every view's rows as a table of the mart, and under a name that SQL can use.

        A later session gets the names back from the same root with ``load_views``.
        """
        kept = dict(zip(views, run_at_once(lambda item: self.write_layer(item[1], "mart", VIEW_PREFIX + item[0]), views.items())))
        self.register_views(kept)
        return kept

    def load_views(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Views that were saved below this root, by any session, registered again."""
        kept = {name: self.read_layer("mart", VIEW_PREFIX + name) for name in names}
        self.register_views(kept)
        return kept

    def list_objects(self) -> DataFrame:
        """Tables by layer, then views, by name."""
        def kind(layer: str, name: str) -> tuple[int, str, str, str]:
            view = layer == "mart" and name.startswith(VIEW_PREFIX)
            return (len(LAYERS) if view else LAYERS.index(layer), layer, name, "VIEW" if view else "TABLE")

        rows = [kind(layer, t.name) for layer in LAYERS
                for t in self.spark.catalog.listTables(self.database(layer)) if not t.isTemporary]
        saved = {name for _, _, name, _ in rows}
        rows += [kind("mart", t.name) for t in self.spark.catalog.listTables()
                 if t.isTemporary and t.name.startswith(VIEW_PREFIX) and t.name not in saved]
        found = self.spark.createDataFrame(rows, "_place int, layer string, object_name string, kind string")
        return found.orderBy("_place", "object_name").drop("_place")
