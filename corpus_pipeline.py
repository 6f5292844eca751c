"""A training-corpus pipeline over ``documents``: clean, deduplicate, decontaminate, mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
``documents``. ``run`` writes each stage's result to the shared folder before the next one reads it.

Defined results of all stages: an empty table gives an empty table; extra columns pass through, and the columns that a
stage adds take names that no column has. What is null, empty, repeated or tied is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomtext.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules
from loomtext.llm.common import Scratch, table


def clean_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines go from the others.

    Null, empty and short texts are rejected; repeated rows are judged alike.
    """
    return quality_rules.clean(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and with them the documents that are left without a word.

    So an exact copy of a whole document goes, and of rows that share id and text, which are one document, all stay or
    all go; the earliest by id stays. Null, empty and blank texts go. A text without a repeated run stays as it is; what is
    left of a text is its own and stays, however short: the first stage's floor judges documents, not remainders.
    """
    return line_dedup.dedup(docs, keep_empty=False)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id: five-word shingles, similarity of 0.8 or more.

    Null and empty texts are linked with nothing and stay, as do rows with a null id; rows that share an id stay or go together.
    """
    return near_dedup.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts and items match nothing; rows that share an id stay or go together.
    """
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights; ``copy`` counts repeats.

    A null source is one source, last in order; a null text has no words; rows that share an id are decided alike.
    """
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", clean_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: Near-duplicate groups and line runs need iteration and hashing that SQL does not express at this size.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.put(docs, name)
    return docs
