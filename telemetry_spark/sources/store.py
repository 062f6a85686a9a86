"""Layered table storage over a base folder: ``<root>/<layer>/<name>``.

* full refresh (``overwrite``), optionally laid out by partition columns: every refresh writes a
  folder of its own, and one small file then names the new folder, the schema and the partition
  columns.  A write that fails leaves the old table as it was, a reader finds the old table or the
  new one, and the replaced folder goes with the next refresh, so that plans that read it can end;
* partitions replaced one by one (``replace_partitions``): what a repeated attempt writes takes the
  place of what it wrote before;
* append (``append``);
* a table's schema is stored with its name, so one without rows reads as an empty table, and
  reading one runs no job;
* names for SQL users: session views that carry the lake's name, and, where the session has a
  catalog, external tables and stored views in it.

Plain files in a configurable format (parquet by default); no catalog is required, and
the root should be a shared filesystem or object store on a cluster.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from telemetry_spark.sources import files

LAYERS = ("bronze", "silver", "gold", "audit")
TABLES = "_tables"


def safe_value(text: str) -> str:
    """``text`` with what a partition folder would escape as underscores."""
    return "".join(c if c.isascii() and (c.isalnum() or c in "_-") else "_" for c in text)


@dataclass(frozen=True)
class Table:
    """What a lake knows of a table: ``folder`` is where its files are, ``replaced`` where they were."""

    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    folder: str = ""
    replaced: str = ""

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "partition_by": self.partition_by,
                           "folder": self.folder, "replaced": self.replaced})

    @staticmethod
    def from_json(text: str) -> Table:
        kept = json.loads(text)
        return Table(T.StructType.fromJson(kept["schema"]), tuple(kept["partition_by"]), kept["folder"], kept["replaced"])


def sql_name(text: str) -> str:
    """``text`` with what SQL names cannot hold unquoted as underscores."""
    return "".join(c if c.isascii() and (c.isalnum() or c == "_") else "_" for c in text)


class Lake:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", compression: str | None = "zstd",
                 name: str | None = None):
        """``compression``: the file codec for every layer (zstd stores the all-string
        Bronze and the wide Silver markedly smaller than the default snappy); ``None``
        keeps the session default.  ``name``: what SQL names of its tables begin with (default: the
        last part of the root)."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.compression = compression
        self.name = sql_name(name or self.root.rpartition("/")[2])
        # one DataFrame (and so one file listing) per table until that table is written
        # again: on an object store a day-partitioned fact is a large listing
        self._frames: dict[str, DataFrame] = {}
        self._tables: dict[str, Table] = {}

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"a lake has the layers {', '.join(LAYERS)}, not {layer}")
        if name != sql_name(name) or not name or name[0].isdigit():
            raise ValueError(f"{name!r} cannot name a table: ASCII letters, digits and _ only, no digit first")
        return f"{self.root}/{layer}/{name}"

    def overwrite(self, df: DataFrame, layer: str, name: str, partition_by: tuple[str, ...] = (),
                  max_records_per_file: int | None = None) -> str:
        """Full refresh; the stored schema is replaced by the frame's.  Returns the new folder."""
        path = self.path(layer, name)
        before = self._find(layer, name)
        folder = f"v-{uuid.uuid4().hex}"
        writer = self._writer(df, partition_by)
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
        writer.mode("error").save(f"{path}/{folder}")
        self._switch(layer, name, Table(_readers_schema(df.schema, partition_by), tuple(partition_by), folder,
                                        before.folder if before else ""))
        if before and before.replaced:
            files.remove(self.spark, f"{path}/{before.replaced}")
        return f"{path}/{folder}"

    def append(self, df: DataFrame, layer: str, name: str) -> str:
        return self._add(df, layer, name, (), "append", "static")

    def replace_partitions(self, df: DataFrame, layer: str, name: str, partition_by: tuple[str, ...]) -> str:
        """The partitions that ``df`` has rows of are replaced by them, the others keep their files."""
        return self._add(df, layer, name, tuple(partition_by), "overwrite", "dynamic")

    def _add(self, df: DataFrame, layer: str, name: str, partition_by: tuple[str, ...], mode: str, overwrite: str) -> str:
        path, table = self.path(layer, name), self._find(layer, name)
        if table is None:
            table = Table(_readers_schema(df.schema, partition_by), partition_by, "v-0")
        elif table.partition_by != partition_by:
            raise ValueError(f"{layer}.{name} is partitioned by {table.partition_by}, not by {partition_by}")
        self._frames.pop(path, None)
        self._writer(df, partition_by).option("partitionOverwriteMode", overwrite).mode(mode).save(f"{path}/{table.folder}")
        if self._tables.get(path) != table:
            self._switch(layer, name, table)
        return f"{path}/{table.folder}"

    def drop_partition(self, layer: str, name: str, value: str) -> None:
        """Remove the partition that ``value`` names in the table's first partition column, if it is there."""
        if value != safe_value(value):
            raise ValueError(f"{value!r} cannot name a partition: ASCII letters, digits, _ and - only")
        if self.has(layer, name):
            path, column = self.path(layer, name), self.table(layer, name).partition_by[0]
            self._frames.pop(path, None)
            files.remove(self.spark, f"{self.location(layer, name)}/{column}={value}")

    def _writer(self, df: DataFrame, partition_by: tuple[str, ...] = ()):
        writer = df.write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        return writer.option("compression", self.compression) if self.compression else writer

    def _entry(self, layer: str, name: str) -> str:
        return f"{self.root}/{TABLES}/{self.path(layer, name)[len(self.root) + 1:]}.json"

    def _switch(self, layer: str, name: str, table: Table) -> None:
        files.write_text(self.spark, self._entry(layer, name), table.to_json())
        path = self.path(layer, name)
        self._frames.pop(path, None)
        self._tables[path] = table

    def _find(self, layer: str, name: str) -> Table | None:
        path = self.path(layer, name)
        if path not in self._tables:
            text = files.read_text(self.spark, self._entry(layer, name))
            if text is None:
                return None
            self._tables[path] = Table.from_json(text)
        return self._tables[path]

    def table(self, layer: str, name: str) -> Table:
        found = self._find(layer, name)
        if found is None:
            raise ValueError(f"the lake {self.root} has no table {layer}.{name}")
        return found

    def has(self, layer: str, name: str) -> bool:
        return self._find(layer, name) is not None

    def location(self, layer: str, name: str) -> str:
        """The folder a table's files are in at present."""
        return f"{self.path(layer, name)}/{self.table(layer, name).folder}"

    def read(self, layer: str, name: str) -> DataFrame:
        path = self.path(layer, name)
        frame = self._frames.get(path)
        if frame is None:
            reader = self.spark.read.schema(self.table(layer, name).schema).format(self.fmt)
            frame = self._frames[path] = reader.load(self.location(layer, name))
        return frame

    def register(self, df: DataFrame, layer: str, name: str) -> str:
        """Expose a frame to SQL for this session, as ``<lake>_<layer>_<name>``."""
        self.path(layer, name)
        view = f"{self.name}_{layer}_{name}"
        df.createOrReplaceTempView(view)
        return view

    def publish(self, layer: str, name: str) -> str:
        """Register a stored table in the session's catalog, as ``<lake>_<layer>.<name>``."""
        database, kept = self._database(layer), self.table(layer, name)
        table, partition_by = f"{database}.{name}", kept.partition_by
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING {self.fmt}{parts} LOCATION {_literal(self.location(layer, name))}")
        if partition_by:
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return table

    def publish_view(self, layer: str, name: str, query: str) -> str:
        """Store a view over published tables in the session's catalog."""
        view = f"{self._database(layer)}.{name}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
        return view

    def _database(self, layer: str) -> str:
        database = f"{self.name}_{layer}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_literal(f'{self.root}/_catalog/{layer}')}")
        return database


def _readers_schema(schema: T.StructType, partition_by: tuple[str, ...]) -> T.StructType:
    """Readers put partition columns last, and files hold nullable columns."""
    fields = sorted(schema.fields, key=lambda f: partition_by.index(f.name) if f.name in partition_by else -1)
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
