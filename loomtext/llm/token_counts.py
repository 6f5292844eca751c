"""Token counts as delta-maintained rollups.

Every change to the corpus is a signed delta: an insert adds (documents, tokens) to its (source, language,
tokenizer version), a delete takes them away, a revision does both. A batch of changes is summed per key, written to a
folder of its own, and committed under its batch id by a small record that names this folder. A record is moved into
place only where there is none, so a retried, repeated or half-written batch never counts twice, and of two writers of
one batch the later one is told so. Totals are the sum over committed batches; ``compact`` sums them into one table
that stands for them. Sums are combined before each shuffle, so hot keys cost nothing.

Defined results: null text has 0 tokens; null source or language is a key of its own; totals of a key whose
documents are all gone are dropped; several rows with one id count each; an empty batch commits and adds
nothing; a ledger without batches has no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MULTI_RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The public pre-tokenisation pattern of the byte-level vocabularies (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "tokenizer_version"]
MAX_TABLE = 400_000


class Counter:
    """Counts tokens; keeps a bounded table of the pre-tokens met so far."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex
        import tiktoken

        self.split = regex.compile(PATTERN).findall
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        known, total = self.known, 0
        if len(known) > MAX_TABLE:
            known.clear()
        for part in self.split(text or ""):
            n = known.get(part)
            if n is None:
                n = len(self.encode(part))
                if len(part) < 40:
                    known[part] = n
            total += n
        return total


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def count_tokens(docs: DataFrame, *, version: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", ranks_path: str = RANKS) -> DataFrame:
    """id, source, lang, tokenizer_version and n_tokens for every row; texts are read whole."""
    shipped = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))  # one vocabulary: fixed size
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, source_col, lang_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shipped.value)
        for b in batches:
            n = pa.array([counter.count(t.as_py()) for t in b.column(3)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), n], ["id", "source", "lang", "n_tokens"])

    named = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    out = named.mapInArrow(run, f"id {kinds[0]}, source {kinds[1]}, lang {kinds[2]}, n_tokens long")
    return out.select(F.col("id").alias(id_col), "source", "lang", F.lit(version).alias("tokenizer_version"), "n_tokens")


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(1).cast("long").alias("d_docs"), F.col("n_tokens").cast("long").alias("d_tokens"))


def deletes(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(-1).cast("long").alias("d_docs"), (-F.col("n_tokens")).cast("long").alias("d_tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Old counts out, new counts in; source, language or version may change as well."""
    return deletes(before).unionByName(inserts(after))


class Ledger:
    """Committed batches of summed deltas under one folder of a Hadoop file system.

    ``data`` has a folder for each write, ``committed`` a record for each batch, ``compacted`` one for each compaction.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def _record(self, folder: str, name: str, content: str) -> bool:
        """Move a record into place; False, and nothing changes, if there is one."""
        final, staged = self._path(f"{self.root}/{folder}/{name}"), self._path(f"{self.root}/staged/{uuid.uuid4().hex}")
        self._fs.mkdirs(final.getParent())
        stream = self._fs.create(staged, False)
        stream.write(bytearray(content.encode()))
        stream.close()
        try:
            self._context.rename(staged, final, self._no_options)
        except Py4JJavaError as e:
            if not self._fs.exists(final):
                raise
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            self._fs.delete(staged, False)
            return False
        return True

    def _records(self, folder: str) -> dict[str, str]:
        top = self._path(f"{self.root}/{folder}")
        if not self._fs.exists(top) or not len(self._fs.listStatus(top)):
            return {}
        rows = self.spark.read.text(f"{self.root}/{folder}", wholetext=True).select(F.input_file_name(), "value").collect()
        return {name.rsplit("/", 1)[1]: value for name, value in rows}

    def _write(self, deltas: DataFrame) -> str:
        summed = deltas.groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        name = uuid.uuid4().hex
        summed.write.parquet(f"{self.root}/data/{name}")
        return name

    def committed(self) -> list[str]:
        return sorted(self._records("committed"))

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Sum and commit a batch; False, and nothing changes, if the id is committed already."""
        if not batch_id or not all(c.isalnum() or c in "-_." for c in batch_id) or batch_id.startswith((".", "_")):
            raise ValueError(f"unusable batch id {batch_id!r}")
        if self._fs.exists(self._path(f"{self.root}/committed/{batch_id}")):
            return False
        name = self._write(deltas)
        if self._record("committed", batch_id, name):
            return True
        self._fs.delete(self._path(f"{self.root}/data/{name}"), True)
        return False

    def _live(self, batches: dict[str, str], compactions: dict[str, str]) -> list[str]:
        """Data folders that count: the last compaction's and those of batches that it does not cover."""
        base = json.loads(compactions[max(compactions)]) if compactions else {"data": None, "covers": []}
        covered = set(base["covers"])
        rest = [data for batch, data in sorted(batches.items()) if batch not in covered]
        return ([base["data"]] if base["data"] else []) + rest

    def _deltas(self, names: list[str]) -> DataFrame:
        schema = "source string, lang string, tokenizer_version string, d_docs long, d_tokens long"
        paths = [f"{self.root}/data/{n}" for n in names]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def compact(self) -> bool:
        """Sum what is committed into one table; False if another compaction came first or there is nothing to do."""
        compactions, batches = self._records("compacted"), self._records("committed")
        live = self._live(batches, compactions)
        if len(live) < 2:
            return False
        name = self._write(self._deltas(live))
        return self._record("compacted", f"{len(compactions):012d}", json.dumps({"data": name, "covers": sorted(batches)}))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens over all committed batches."""
        compactions, batches = self._records("compacted"), self._records("committed")  # a later batch is in neither
        sums = self._deltas(self._live(batches, compactions)).groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")
