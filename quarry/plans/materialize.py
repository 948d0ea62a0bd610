"""Namespaces, views and tables.

Layers live in their own databases (``raw``, ``bronze``, ``silver``,
``gold`` by default; a custom name is used verbatim, trimmed). Bronze
models are views over the raw tables; silver and gold models are
tables rebuilt in full on each run, tagged and described with table
properties.

A rebuild writes a new version beside the one in use and then points the
table at it, so a build that fails leaves the old rows in place. The version
before the current one is kept until the next build.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.config import Namespaces

# Table properties: the folders of the version in use and the one before it, and the partition columns.
VERSION, PREVIOUS, PARTITIONS = "version_path", "previous_path", "partition_columns"


def _ident(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


@dataclass(frozen=True)
class Model:
    layer: str
    model: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    inputs: dict[str, tuple[str, str]]
    tags: tuple[str, ...]
    comment: str | None


@dataclass
class Warehouse:
    spark: SparkSession
    ns: Namespaces = field(default_factory=Namespaces)
    models: dict[str, "Model"] = field(default_factory=dict)

    def create_namespaces(self) -> None:
        for db in (self.ns.raw, self.ns.bronze, self.ns.silver, self.ns.gold):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(db)}")

    def name(self, layer: str, table: str) -> str:
        return f"{getattr(self.ns, layer)}.{table}"

    # -- reads by logical name ----------------------------------------
    def source(self, table: str) -> DataFrame:
        """A raw table (``source(...)``)."""
        return self.spark.table(self.name("raw", table))

    def ref(self, layer: str, model: str) -> DataFrame:
        """An upstream model (``ref(...)``)."""
        return self.spark.table(self.name(layer, model))

    # -- materializations ----------------------------------------------
    def view(self, layer: str, model: str, select_sql: str, comment: str | None = None) -> None:
        """``CREATE OR REPLACE VIEW`` over persisted tables."""
        target = _ident(self.name(layer, model))
        comment_sql = f" COMMENT '{_quote(comment)}'" if comment else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {target}{comment_sql} AS {select_sql}")

    def table(
        self,
        layer: str,
        model: str,
        df: DataFrame,
        tags: tuple[str, ...] = (),
        comment: str | None = None,
        fmt: str = "parquet",
        partition_by: tuple[str, ...] = (),
    ) -> None:
        """Rebuild the table in full from ``df``.

        The rows are written to a folder of their own. Only when they are all
        there does the table change: a table with the same columns is moved to
        the new folder by one catalog change; one with other columns, or
        partitions, is defined anew over it. Readers see the old or the new
        rows, a failed build changes nothing. ``partition_by`` lays files out
        by those columns, so filters on them prune whole directories. A
        transactional format (``fmt``) replaces its rows in place.
        """
        target = self.name(layer, model)
        props = {"layer": layer}
        if tags:
            props["tags"] = ",".join(tags)
        if comment:
            props["comment"] = comment
        if fmt != "parquet":
            writer = df.write.format(fmt).mode("overwrite")
            (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(target)
        else:
            props |= self._new_version(target, df, partition_by)
        kv = ", ".join(f"'{k}' = '{_quote(v)}'" for k, v in props.items())
        self.spark.sql(f"ALTER TABLE {_ident(target)} SET TBLPROPERTIES ({kv})")

    def _new_version(self, target: str, df: DataFrame, partition_by: tuple[str, ...]) -> dict[str, str]:
        """Writes the version and points the table at it; the properties that name the versions."""
        spark = self.spark
        db, _, model = target.rpartition(".")
        path = f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{model}__versions/{uuid.uuid4().hex}"
        writer = df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        fields = [f for f in df.schema.fields if f.name not in partition_by] + [df.schema[c] for c in partition_by]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        held = spark.table(target) if spark.catalog.tableExists(target) else None
        known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(target)}").collect()} if held is not None else {}
        current, before = known.get(VERSION), known.get(PREVIOUS)
        same = held is not None and [(f.name, f.dataType) for f in held.schema.fields] == [(f.name, f.dataType) for f in schema.fields]
        if same and current and not partition_by and PARTITIONS not in known:
            spark.sql(f"ALTER TABLE {_ident(target)} SET LOCATION '{_quote(path)}'")
        else:
            by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
            spark.sql(f"DROP TABLE IF EXISTS {_ident(target)}")  # its versions' files stay
            spark.sql(f"CREATE TABLE {_ident(target)} ({schema.toDDL()}) USING parquet{by} LOCATION '{_quote(path)}'")
            if partition_by:
                spark.sql(f"ALTER TABLE {_ident(target)} RECOVER PARTITIONS")
        spark.catalog.refreshTable(target)
        if before:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        return {VERSION: path} | ({PREVIOUS: current} if current else {}) | ({PARTITIONS: ",".join(partition_by)} if partition_by else {})

    # -- user models ---------------------------------------------------
    def register(self, layer: str, name: str, model: Callable[[SparkSession, dict[str, DataFrame]], DataFrame],
                 inputs: dict[str, tuple[str, str]], tags: tuple[str, ...] = (), comment: str | None = None) -> None:
        """A model ``(session, inputs) -> DataFrame``; ``inputs`` names the
        (layer, table) of each input."""
        self.models[name] = Model(layer, model, inputs, tags, comment)

    def build(self, name: str) -> DataFrame:
        """Materialize a registered model and, before it, the registered
        models that it reads; its table."""
        self._build(name, set(), ())
        return self.ref(self.models[name].layer, name)

    def _build(self, name: str, done: set[str], above: tuple[str, ...]) -> None:
        if name in above:
            raise ValueError(f"models read each other: {' -> '.join([*above, name])}")
        m = self.models[name]
        for layer, table in m.inputs.values():
            if table in self.models and self.models[table].layer == layer and table not in done:
                self._build(table, done, (*above, name))
        frames = {k: self.ref(layer, table) for k, (layer, table) in m.inputs.items()}
        self.table(m.layer, name, m.model(self.spark, frames), m.tags, m.comment)
        done.add(name)

    def properties(self, layer: str, model: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {_ident(self.name(layer, model))}").collect()
        return {r["key"]: r["value"] for r in rows}


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


# Layer tags, as the project configuration gives them (fixed values).
SILVER_TAGS = ("silver", "cleaned")
GOLD_TAGS = ("gold", "analytics")
