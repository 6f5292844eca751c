"""Row generators as table functions for SQL.

``register`` makes them known to a session: ``section_rows`` and ``overlapping_chunks`` are called by LATERAL for each
document, ``first_of_group`` takes a whole table, partitioned and ordered in the call.
"""

from __future__ import annotations

import re

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from .extract import QA_SECTIONS
SPACE = " \t\n\x0b\x0c\r"


class SectionRows:
    """(number, section) of a text, by the forms of ``extract.QA_SECTIONS``: the first that occurs more than once, else paragraphs.

    Parts of up to 100 characters are left out and keep their number; of paragraphs the first 20 that stay count. A null
    text has none.
    """

    def eval(self, text: str | None):
        if not text:
            return
        for form in QA_SECTIONS:
            parts = [m[0].strip(SPACE) for m in re.finditer(form.replace(r"\z", r"\Z"), text)]
            if len(parts) > 1:
                yield from ((n, p) for n, p in enumerate(parts, 1) if len(p) > 100)
                return
        paragraphs = [p.strip(SPACE) for p in text.split("\n\n")]
        yield from [(n, p) for n, p in enumerate(paragraphs, 1) if len(p) > 100][:20]


class OverlappingChunks:
    """(number, chunk): stretches of ``size`` characters, each ``overlap`` behind the end of the one before, until one reaches the end."""

    def eval(self, text: str | None, size: int, overlap: int):
        if text is None:
            return
        if not 0 <= overlap < size:
            raise ValueError("the overlap has to be smaller than the size")
        start, n = 0, 0
        while True:
            yield n, text[start : start + size]
            if start + size >= len(text):
                return
            start, n = start + size - overlap, n + 1


class FirstOfGroup:
    """(key, first, rows, total): of a table (key, id, size), partitioned by key and ordered in the call: the first id, and sums.

    A group is read row by row and never held.
    """

    def __init__(self):
        self.key, self.first, self.rows, self.total = None, None, 0, 0

    def eval(self, row: Row):
        if not self.rows:
            self.key, self.first = row[0], row[1]
        self.rows += 1
        self.total += row[2] or 0

    def terminate(self):
        if self.rows:
            yield self.key, self.first, self.rows, self.total


def register(spark: SparkSession) -> None:
    spark.udtf.register("section_rows", udtf(SectionRows, returnType="number int, section string"))
    spark.udtf.register("overlapping_chunks", udtf(OverlappingChunks, returnType="number int, chunk string"))
    spark.udtf.register("first_of_group", udtf(FirstOfGroup, returnType="key string, first bigint, rows bigint, total bigint"))
