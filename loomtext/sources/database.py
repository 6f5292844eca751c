"""Upserts into, and reads from, a database that speaks DB-API and SQL with ON CONFLICT, as a Spark data source.

Each task puts its rows into a staging table in one transaction, marked with the write and an attempt of its own, and
reports the attempt. The driver's commit is one transaction in the database: of the rows of reported attempts the latest
version of each key replaces what is stored unless that is newer, the write is noted by its id, and its staged rows go.
So rows of failed, repeated or speculative attempts never count, a write that is sent again under its id changes nothing,
and a write that fails leaves the stored rows as they were. Rows do not pass through the driver.

Defined results: a row with a null in its key is an error, and nothing of the write is stored; of rows with the same
key and version in one write, the one with the largest values in column order stays; a null version is older than any
other; an empty table commits and changes nothing. Arrays, maps and structs are stored as JSON text.
"""

from __future__ import annotations

import datetime
import decimal
import json
import sqlite3
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Column types by Spark's names; all others are text.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "INTEGER", "tinyint": "INTEGER", "boolean": "INTEGER", "double": "DOUBLE PRECISION",
    "float": "DOUBLE PRECISION", "binary": "BLOB",
}
NESTED = ("array", "map", "struct")
#: Stored rows are dealt into so many parts by a hash of the key; a read is one task for each of some of them.
PARTS = 64
CHUNK = 1000


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class Target:
    """Names and statements of one stored table: rows, staged rows, reported attempts and noted writes."""

    def __init__(self, table: str, schema: StructType, key: list[str], version: str | None, mark: str = "?"):
        missing = [c for c in [*key, *([version] if version else [])] if c not in schema.names]
        if missing or not key:
            raise ValueError(f"key and version must be columns of the table: {missing or 'no key'}")
        self.schema, self.key, self.version, self.mark = schema, key, version, mark
        self.rows, self.staged, self.attempts, self.writes = (_quoted(table + tail) for tail in ("", "_staged", "_attempts", "_writes"))
        kinds = [(_quoted(f.name), KINDS.get(f.dataType.simpleString(), "TEXT")) for f in schema.fields]
        self.columns = [c for c, _ in kinds]
        self.declared = ", ".join(f"{c} {kind}" for c, kind in kinds)

    def prepare(self, connection) -> None:
        """Get or create; a stored table with other columns is an error."""
        cursor = connection.cursor()
        keys = ", ".join(map(_quoted, self.key))
        cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.rows} ({self.declared}, _part INTEGER NOT NULL, PRIMARY KEY ({keys}))")
        cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.staged} ({self.declared}, _part INTEGER NOT NULL, _write TEXT NOT NULL, _attempt TEXT NOT NULL)")
        cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.attempts} (_write TEXT NOT NULL, _attempt TEXT NOT NULL)")
        cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.writes} (_write TEXT PRIMARY KEY)")
        cursor.execute(f"SELECT * FROM {self.rows} WHERE 1 = 0")
        found = [d[0] for d in cursor.description]
        connection.commit()
        if found != [*self.schema.names, "_part"]:
            raise ValueError(f"{self.rows} has columns {found}")

    def stage(self) -> str:
        return f"INSERT INTO {self.staged} VALUES ({', '.join([self.mark] * (len(self.columns) + 3))})"

    def noted(self) -> str:
        return f"SELECT count(*) FROM {self.writes} WHERE _write = {self.mark}"

    def merge(self) -> tuple[str, str]:
        """Reported rows of a write, the latest of each key, over what is stored and not newer: first the keys that occur
        once, whose rows need no order, then the others. Each takes the write's id four times."""
        keys, columns = ", ".join(map(_quoted, self.key)), ", ".join(self.columns)
        age = [f"{_quoted(self.version)} IS NULL", f"{_quoted(self.version)} DESC"] if self.version else []
        order = ", ".join([*age, *[f"{c} DESC" for c in self.columns]])
        values = [c for c in self.columns if c not in map(_quoted, self.key)]
        newer = ""
        if self.version:
            v = _quoted(self.version)
            newer = f" WHERE {self.rows}.{v} IS NULL OR excluded.{v} >= {self.rows}.{v}"
        update = f"DO UPDATE SET {', '.join(f'{c} = excluded.{c}' for c in values)}{newer}" if values else "DO NOTHING"
        reported = f"_write = {self.mark} AND _attempt IN (SELECT _attempt FROM {self.attempts} WHERE _write = {self.mark})"
        repeated = f"({keys}) IN (SELECT {keys} FROM {self.staged} WHERE {reported} GROUP BY {keys} HAVING count(*) > 1)"
        put = f"INSERT INTO {self.rows} ({columns}, _part) SELECT {columns}, _part FROM"
        latest = f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _n FROM {self.staged} WHERE {reported} AND {repeated}"
        return f"{put} {self.staged} WHERE {reported} AND NOT {repeated} ON CONFLICT ({keys}) {update}", f"{put} ({latest}) AS t WHERE _n = 1 ON CONFLICT ({keys}) {update}"

    def plain(self, row) -> tuple:
        """A row's values as the database takes them, and its part."""
        values = []
        for f, v in zip(self.schema.fields, row, strict=True):
            if v is None:
                if f.name in self.key:
                    raise ValueError(f"null in key column {f.name}")
            elif f.dataType.simpleString().startswith(NESTED):
                v = json.dumps(v.asDict(recursive=True) if hasattr(v, "asDict") else v, sort_keys=True, default=str)
            elif isinstance(v, bool):
                v = int(v)
            elif isinstance(v, (datetime.date, datetime.datetime, decimal.Decimal)):
                v = str(v)
            elif isinstance(v, bytearray):
                v = bytes(v)
            values.append(v)
        key = "\x1f".join(str(values[self.schema.names.index(k)]) for k in self.key)
        return (*values, zlib.crc32(key.encode()) % PARTS)


@dataclass
class Staged(WriterCommitMessage):
    """What a task has put into the staging table."""

    attempt: str
    rows: int


class _Upserts(DataSourceWriter):
    def __init__(self, connect: Callable, target: Target, write_id: str):
        self.connect, self.target, self.write_id = connect, target, write_id

    def write(self, iterator: Iterator) -> Staged:
        attempt, n = uuid.uuid4().hex, 0
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(self.target.noted(), (self.write_id,))
            if cursor.fetchone()[0]:
                return Staged(attempt, 0)  # sent again: nothing of it will count
            while rows := [(*self.target.plain(r), self.write_id, attempt) for r in islice(iterator, CHUNK)]:
                cursor.executemany(self.target.stage(), rows)
                n += len(rows)
            connection.commit()
        finally:
            connection.close()
        return Staged(attempt, n)

    def commit(self, messages: list) -> None:
        t, connection = self.target, self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(t.noted(), (self.write_id,))
            if not cursor.fetchone()[0]:
                cursor.execute(f"INSERT INTO {t.writes} VALUES ({t.mark})", (self.write_id,))
                cursor.executemany(f"INSERT INTO {t.attempts} VALUES ({t.mark}, {t.mark})", [(self.write_id, m.attempt) for m in messages if m])
                for statement in t.merge():
                    cursor.execute(statement, (self.write_id,) * 4)
            self._forget(connection)
            connection.commit()
        finally:
            connection.close()

    def abort(self, messages: list) -> None:
        connection = self.connect()
        try:
            self._forget(connection)
            connection.commit()
        finally:
            connection.close()

    def _forget(self, connection) -> None:
        """SQLite keeps a copy of every page from which rows are deleted one by one, or overwritten with zeros (some builds'
        ``secure_delete``), but not if a table is emptied as a whole; what was staged then stays in free pages until they are used.

        It has one writer, so that nobody stages rows between the look and the deletion; other databases have more.
        """
        cursor, t = connection.cursor(), self.target
        single = isinstance(connection, sqlite3.Connection) and connection.in_transaction
        for table in (t.staged, t.attempts):
            if single and not cursor.execute(f"SELECT EXISTS (SELECT 1 FROM {table} WHERE _write <> {t.mark})", (self.write_id,)).fetchone()[0]:
                before = cursor.execute("PRAGMA secure_delete").fetchone()[0]
                cursor.execute("PRAGMA secure_delete = OFF")
                cursor.execute(f"DELETE FROM {table}")
                cursor.execute(f"PRAGMA secure_delete = {before}")
            else:
                cursor.execute(f"DELETE FROM {table} WHERE _write = {t.mark}", (self.write_id,))


class _Parts(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class _Stored(DataSourceReader):
    """Stored rows, one task for each range of parts. Nested columns come as JSON text."""

    def __init__(self, connect: Callable, table: str, schema: StructType, tasks: int, mark: str):
        self.connect, self.table, self.schema, self.tasks, self.mark = connect, table, schema, max(1, min(tasks, PARTS)), mark

    def partitions(self) -> list[_Parts]:
        ends = [PARTS * i // self.tasks for i in range(self.tasks + 1)]
        return [_Parts(a, b) for a, b in zip(ends, ends[1:], strict=False)]

    def read(self, partition: _Parts) -> Iterator[tuple]:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            columns = ", ".join(map(_quoted, self.schema.names))
            cursor.execute(f"SELECT {columns} FROM {_quoted(self.table)} WHERE _part >= {self.mark} AND _part < {self.mark}", (partition.first, partition.last))
            booleans = [f.dataType.simpleString() == "boolean" for f in self.schema.fields]
            while rows := cursor.fetchmany(CHUNK):
                for r in rows:
                    yield tuple(bool(v) if b and v is not None else v for v, b in zip(r, booleans, strict=True))
        finally:
            connection.close()


class Database(DataSource):
    """Options: ``table``; for writes ``key`` (columns by commas), ``version`` (none), ``write_id`` (a new one); ``mark`` (``?``);
    for reads ``tasks`` (8) and a schema. ``connect()`` opens a DB-API connection in the driver and in each task."""

    connect: Callable | None = None

    @classmethod
    def of(cls, connect: Callable, name: str = "database") -> type:
        return type("BoundDatabase", (cls,), {"connect": staticmethod(connect), "name": classmethod(lambda c: name)})

    @classmethod
    def name(cls) -> str:
        return "database"

    def schema(self):
        raise ValueError("give a schema")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("rows are replaced by their keys: use mode append")
        key = [k.strip() for k in self.options.get("key", "").split(",") if k.strip()]
        target = Target(self.options["table"], schema, key, self.options.get("version"), self.options.get("mark", "?"))
        connection = type(self).connect()
        try:
            target.prepare(connection)
        finally:
            connection.close()
        return _Upserts(type(self).connect, target, self.options.get("write_id") or uuid.uuid4().hex)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Stored(type(self).connect, self.options["table"], schema, int(self.options.get("tasks", 8)), self.options.get("mark", "?"))


def register(spark: SparkSession, connect: Callable) -> str:
    """Make a database known to a session; the name of its format."""
    name = f"database_{uuid.uuid4().hex[:8]}"
    spark.dataSource.register(Database.of(connect, name))
    return name


def upsert(df: DataFrame, fmt: str, table: str, *, key: list[str], version: str | None = None, write_id: str | None = None) -> None:
    options = {"table": table, "key": ",".join(key)} | ({"version": version} if version else {}) | ({"write_id": write_id} if write_id else {})
    df.write.format(fmt).mode("append").options(**options).save()


def stored(spark: SparkSession, fmt: str, table: str, schema: str, *, tasks: int = 8) -> DataFrame:
    return spark.read.format(fmt).schema(schema).option("table", table).option("tasks", tasks).load()


#: Keys of the tables that ``sinks.case_records`` and ``sinks.legislation_records`` give.
RECORD_KEYS = {"documents": ["id"], "nodes": ["id"], "edges": ["src", "dst", "kind"], "vectors": ["vector_id"]}


def upsert_records(records: dict[str, DataFrame], fmt: str, *, prefix: str = "", write_id: str | None = None, parts: int = 1) -> None:
    """Document, graph and vector-text tables of a load, each under the load's id; sent again, it goes on where it stopped.

    With ``parts``, a table goes in so many writes, by a hash of its key, each of them whole: then no more than one part of
    it is staged beside the stored rows, and the table is worked out once for each part.
    """
    for name, df in records.items():
        key = RECORD_KEYS[name]
        number = F.pmod(F.xxhash64(*key), F.lit(parts))
        for i in range(parts):
            of = f"{write_id}-{i}" if write_id and parts > 1 else write_id
            upsert(df if parts == 1 else df.where(number == i), fmt, prefix + name, key=key, write_id=of)
