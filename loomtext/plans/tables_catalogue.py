"""A catalogue of named tables under one root: save, load, append, change columns, describe, export, drop."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators.relational import numbered
from loomtext.sources import sinks
from loomtext.sources.scratch import durable


class Conflict(RuntimeError):
    """Another writer has changed the table since it was read."""


class Catalogue:
    """Rows lie in folders with names of their own; numbered records say which folder is the table, and what is in it.

    A record is moved into place only where there is none of its number, and never changed. So readers see whole tables,
    of two writers who start from the same version one gets through, and a change that fails leaves the table as it was.
    ``save`` takes the next free number, changes of what was read fail with ``Conflict``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def _versions(self, name: str) -> list[int]:
        top = self._path(f"{self.root}/{name}/versions")
        if not self._fs.exists(top):
            return []
        return sorted(int(n) for n in (s.getPath().getName() for s in self._fs.listStatus(top)) if n.isdigit())

    def _latest(self, name: str) -> int:
        versions = self._versions(name)
        if not versions:
            raise KeyError(name)
        return versions[-1]

    def _read(self, name: str) -> tuple[int, dict]:
        version = self._latest(name)
        return version, json.loads(self.spark.read.text(f"{self.root}/{name}/versions/{version}", wholetext=True).first()["value"])

    def _commit(self, name: str, version: int, record: dict) -> bool:
        """False, and nothing changes, if the version is there."""
        final, staged = self._path(f"{self.root}/{name}/versions/{version}"), self._path(f"{self.root}/{name}/staged/{uuid.uuid4().hex}")
        self._fs.mkdirs(final.getParent())
        stream = self._fs.create(staged, False)
        stream.write(bytearray(json.dumps(record, sort_keys=True).encode()))
        stream.close()
        try:
            self._context.rename(staged, final, self._no_options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            self._fs.delete(staged, False)
            return False
        return True

    def names(self) -> list[str]:
        top = self._path(self.root)
        every = [s.getPath().getName() for s in self._fs.listStatus(top)] if self._fs.exists(top) else []
        return sorted(n for n in every if self._versions(n))

    def listing(self) -> list[dict]:
        """Tables, most recently changed first."""
        changed = lambda n: self._fs.getFileStatus(self._path(f"{self.root}/{n}/versions/{self._latest(n)}")).getModificationTime()
        return sorted(({"name": n, "modified": changed(n)} for n in self.names()), key=lambda r: (-r["modified"], r["name"]))

    def records(self) -> DataFrame:
        """(name, version, rows, columns, metadata) of all tables, from their latest records."""
        part = lambda n: F.url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), n))
        raw = self.spark.read.option("wholetext", True).text(f"{self.root}/*/versions/*").select(part(-3).alias("name"), part(-1).cast("int").alias("version"), "value")
        latest = raw.groupBy("name").agg(F.max("version").alias("version"), F.max_by("value", "version").alias("value"))
        return latest.select("name", "version", F.from_json("value", "rows long, columns array<string>, metadata map<string, string>").alias("r")).select("name", "version", "r.*")

    def _put(self, name: str, df: DataFrame, metadata: dict, base: int | None) -> None:
        """A new version of the table, behind ``base``, or behind whatever is the latest."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{name}/{folder}")
        written = self.spark.read.parquet(f"{self.root}/{name}/{folder}")
        record = {"data": folder, "rows": written.count(), "columns": written.columns, "metadata": metadata}
        while not self._commit(name, (base if base is not None else (self._versions(name) or [0])[-1]) + 1, record):
            if base is not None:
                self._fs.delete(self._path(f"{self.root}/{name}/{folder}"), True)
                raise Conflict(name)

    def save(self, name: str, df: DataFrame, metadata: dict | None = None) -> None:
        self._put(name, df, metadata or {}, None)

    def _table(self, name: str) -> tuple[int, dict, DataFrame]:
        version, record = self._read(name)
        return version, record, self.spark.read.parquet(f"{self.root}/{name}/{record['data']}")

    def load(self, name: str) -> DataFrame:
        return self._table(name)[2]

    def info(self, name: str) -> dict:
        return {k: v for k, v in self._read(name)[1].items() if k != "data"}

    def metadata(self, name: str) -> dict:
        return self._read(name)[1]["metadata"]

    def update_metadata(self, name: str, values: dict) -> None:
        """Merge: new values win. The rows stay where they are."""
        version, record = self._read(name)
        if not self._commit(name, version + 1, record | {"metadata": record["metadata"] | values}):
            raise Conflict(name)

    def _change(self, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
        version, record, df = self._table(name)
        self._put(name, change(df), record["metadata"], version)

    def append(self, name: str, rows: DataFrame) -> None:
        """Columns that one side lacks are null there."""
        self._change(name, lambda df: df.unionByName(rows, allowMissingColumns=True))

    def update_column(self, name: str, column: str, value: Column | str) -> None:
        """``value`` is a column or an SQL expression; nothing else is evaluated."""

        def change(df: DataFrame) -> DataFrame:
            if column not in df.columns:
                raise KeyError(column)
            return df.withColumn(column, F.expr(value) if isinstance(value, str) else value)

        self._change(name, change)

    def add_column(self, name: str, column: str, value: Column | str | list, *, order: str | None = None) -> None:
        """An expression, or a list as long as the table, matched in order of ``order``."""

        def change(df: DataFrame) -> DataFrame:
            if column in df.columns:
                raise ValueError(f"{column} exists")
            if not isinstance(value, list):
                return df.withColumn(column, F.expr(value) if isinstance(value, str) else value)
            if len(value) != df.count():
                raise ValueError("as many values as rows are needed")
            if order is None:
                raise ValueError("a list needs an order")
            placed = numbered(df.withColumn("_all", F.lit(0)), ["_all"], [F.col(order)], "_n", durable=durable(self.spark))
            values = self.spark.createDataFrame(list(enumerate(value, 1)), ["_n", column])
            return placed.join(values, "_n").drop("_n", "_all")

        self._change(name, change)

    def drop_column(self, name: str, column: str) -> None:
        def change(df: DataFrame) -> DataFrame:
            if column not in df.columns:
                raise KeyError(column)
            return df.drop(column)

        self._change(name, change)

    def delete(self, name: str, *, confirm: bool = False) -> bool:
        if not confirm:
            return False
        self._latest(name)
        return bool(self._fs.delete(self._path(f"{self.root}/{name}"), True))

    def export(self, name: str, fmt: str, path: str) -> None:
        sinks.export(self.load(name), path, fmt)

    def clear_cache(self) -> None:
        self.spark.catalog.clearCache()
