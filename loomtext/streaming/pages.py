"""A paginated service as a table and as a stream that can be stopped and started again.

A service has ``total()``, the rows that it holds now, and ``page(start, count)``, rows in a fixed order. A batch is a range
of rows, cut into tasks of whole pages, each fetched by the task that needs it, with retries and a limiter; an error that
outlasts the retries fails the task, so no range ends early. The end of a batch is written down when the batch is
planned, so a reader that starts again goes on from there, in batches of bounded size, whatever stopped it: a batch that
was planned and not committed is planned again by Spark with the same ends.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from loomtext.sources.limits import RateLimiter, with_retries


class PageService(Protocol):
    """A service may also have ``batches(start, count)``, the rows of a page as Arrow batches; these do not become Python objects."""

    def total(self) -> int: ...

    def page(self, start: int, count: int) -> list[tuple]: ...


class Rows(InputPartition):
    """Rows ``first`` to ``last`` (not included)."""

    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class Position:
    """The end of the last planned batch, in one small file of any file system that Arrow opens; none is 0."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(uri)

    def read(self) -> int:
        from pyarrow import fs

        if self.fs.get_file_info(self.path).type == fs.FileType.NotFound:
            return 0
        with self.fs.open_input_stream(self.path) as f:
            return json.loads(f.read())["start"]

    def write(self, start: int) -> None:
        """A whole file is moved over the old one, so that a reader sees either."""
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        with self.fs.open_output_stream(self.path + ".new") as f:
            f.write(json.dumps({"start": start}).encode())
        self.fs.move(self.path + ".new", self.path)


class _Fetch:
    """Reads a range page by page."""

    def __init__(self, service: PageService, options: dict, schema: StructType):
        self.service, self.schema = service, schema
        self.count = int(options.get("count", 1000))
        self.pages = int(options.get("pages_per_task", 10))
        self.tries, self.pause = int(options.get("tries", 3)), float(options.get("pause", 1.0))
        self.limit, self.window, self.gap = int(options.get("calls", 0)), float(options.get("per_seconds", 60)), float(options.get("gap", 0))

    def cut(self, first: int, last: int) -> list[Rows]:
        step = self.count * self.pages
        return [Rows(a, min(a + step, last)) for a in range(first, last, step)]

    def total(self) -> int:
        return with_retries(self.service.total, tries=self.tries, pause=self.pause)

    def rows(self, part: Rows) -> Iterator:
        from pyspark.sql.pandas.types import to_arrow_schema

        whole = hasattr(self.service, "batches")
        fetch = (lambda at, n: list(self.service.batches(at, n))) if whole else self.service.page
        kinds = to_arrow_schema(self.schema) if whole else None
        limiter = RateLimiter(self.limit, self.window, self.gap) if self.limit else None
        for start in range(part.first, part.last, self.count):
            n = min(self.count, part.last - start)
            if limiter:
                limiter.wait()
            got = with_retries(lambda at=start, n=n: fetch(at, n), tries=self.tries, pause=self.pause)
            held = sum(b.num_rows for b in got) if whole else len(got)
            if held != n:
                raise OSError(f"{held} of {n} rows from {start} on: the service holds less than it said")
            yield from (b.select(kinds.names).cast(kinds) for b in got) if whole else map(tuple, got)


class PageSource(DataSource):
    """``spark.dataSource.register(PageSource.of(service, schema))``, then format ``pages`` of ``spark.read`` or ``spark.readStream``.

    Options: ``count`` rows a page (1000), ``pages_per_task`` (10), ``tries`` (3), ``pause`` seconds (1), ``calls`` in
    ``per_seconds`` for each task (0: no limit) with ``gap`` seconds between them; for streams ``rows_per_batch``
    (0: all there are) and, with it, ``position``, the URI of a file beside the stream's checkpoint.
    """

    service: PageService | None = None
    columns = ""

    @classmethod
    def of(cls, service: PageService, columns: str, name: str = "pages") -> type:
        return type("BoundPageSource", (cls,), {"service": service, "columns": columns, "name": classmethod(lambda c: name)})

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return type(self).columns

    def reader(self, schema) -> DataSourceReader:
        return _TableReader(_Fetch(type(self).service, dict(self.options), schema))

    def streamReader(self, schema) -> DataSourceStreamReader:
        most, position = int(self.options.get("rows_per_batch", 0)), self.options.get("position")
        if most and not position:
            raise ValueError("batches of bounded size need a position file")
        return _PageStream(_Fetch(type(self).service, dict(self.options), schema), most, position)


class _TableReader(DataSourceReader):
    def __init__(self, fetch: _Fetch):
        self.fetch = fetch

    def partitions(self) -> list[Rows]:
        return self.fetch.cut(0, self.fetch.total())

    def read(self, partition: Rows) -> Iterator[tuple]:
        return self.fetch.rows(partition)


class _PageStream(DataSourceStreamReader):
    def __init__(self, fetch: _Fetch, most: int, position: str | None):
        self.fetch, self.most, self.position = fetch, most, position

    def initialOffset(self) -> dict:
        return {"start": 0}

    def latestOffset(self) -> dict:
        total = self.fetch.total()
        return {"start": min(total, Position(self.position).read() + self.most) if self.most else total}

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        if self.most:
            Position(self.position).write(end["start"])
        return self.fetch.cut(start["start"], end["start"])

    def read(self, partition: Rows) -> Iterator[tuple]:
        return self.fetch.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing to give back: the service keeps its rows."""


class ParquetPages:
    """The rows of a parquet table as a paginated service, in the order of its files.

    A page reads the row groups that it needs, some thousand rows at a time, whatever the size of a row group.
    """

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def _files(self):
        from pyarrow import dataset

        return sorted(dataset.dataset(self.path, format="parquet").get_fragments(), key=lambda f: f.path)

    def total(self) -> int:
        return sum(f.metadata.num_rows for f in self._files())

    def batches(self, start: int, count: int) -> Iterator:
        from pyarrow import parquet

        at, end = 0, start + count
        for file in self._files():
            if at >= end:
                return
            sizes = [file.metadata.row_group(i).num_rows for i in range(file.metadata.num_row_groups)]
            if at + sum(sizes) <= start:
                at += sum(sizes)
                continue
            with file.open() as f:
                reader = parquet.ParquetFile(f, pre_buffer=False, buffer_size=1 << 20)
                for i, n in enumerate(sizes):
                    if at + n > start and at < end:
                        for b in reader.iter_batches(8192, row_groups=[i], columns=self.columns, use_threads=False):
                            if at + b.num_rows > start and at < end:
                                yield b.slice(max(start - at, 0), end - max(at, start)).select(self.columns)
                            at, n = at + b.num_rows, n - b.num_rows
                            if at >= end:
                                return
                    at += n

    def page(self, start: int, count: int) -> list[tuple]:
        return [row for b in self.batches(start, count) for row in zip(*[b.column(c).to_pylist() for c in self.columns], strict=True)]


def run_to_end(source: DataFrame, path: str, checkpoint: str, *, timeout: float = 600.0) -> None:
    """Write a stream of pages to parquet until it has all that the service holds now; it can be run again at any time."""
    query = source.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
        query.awaitTermination(int(timeout))


def page_stream(spark: SparkSession, service: PageService, columns: str, **options) -> DataFrame:
    """A stream over a service; the format is registered under a name of its own."""
    name = f"pages_{time.monotonic_ns()}"
    spark.dataSource.register(PageSource.of(service, columns, name))
    return spark.readStream.format(name).options(**options).load()
