"""File sources: paired metadata and text folders, XML, JSON records, mixed trees, and table readers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.udf import arrow_udf


def _stem() -> Column:
    return F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.[^.]*$", "")


def read_texts(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """(stem, text): whole files."""
    raw = spark.read.option("pathGlobFilter", pattern).option("wholetext", True).text(path)
    return raw.select(F.url_decode(_stem()).alias("stem"), F.col("value").alias("text"))


def read_metadata(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON files, a record each, with ``stem``; unreadable files are left out."""
    reader = spark.read.option("multiLine", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.json")
    if schema:
        reader = reader.schema(schema)
    return reader.json(path).withColumn("stem", F.url_decode(_stem()))


@arrow_udf("string")
def xml_text(xmls: pd.Series) -> pd.Series:
    """Texts and tails of all elements in document order, stripped and joined by a space; null if it does not parse."""
    import re
    import xml.etree.ElementTree as ET

    def one(xml: str | None) -> str | None:
        try:
            root = ET.fromstring(xml or "")
        except ET.ParseError:
            return None
        parts = [p.strip() for e in root.iter() for p in (e.text, e.tail) if p and p.strip()]
        return re.sub(r"\s+", " ", " ".join(parts)).strip()

    return xmls.map(one)


def raw_corpus(spark: SparkSession, root: str, *, least: int = 50) -> DataFrame:
    """Texts of at least ``least`` characters, then XML for stems without a kept text, with metadata or defaults."""
    texts = read_texts(spark, f"{root}/text").withColumn("text", F.trim("text")).where(F.length("text") >= least).withColumn("source", F.lit("text"))
    xml = read_texts(spark, f"{root}/xml", "*.xml").withColumn("text", xml_text("text")).where(F.length("text") >= least).withColumn("source", F.lit("xml"))
    every = texts.unionByName(xml.join(texts.select("stem"), "stem", "left_anti"))
    meta = read_metadata(spark, f"{root}/metadata", "type string, title string, year string, url string")
    joined = every.join(meta, "stem", "left")
    d = lambda c, v="": F.coalesce(F.col(c), F.lit(v)).alias(c)
    return joined.select(F.col("stem").alias("id"), "text", "source", d("type", "unknown"), d("title"), d("year"), d("url"), F.length("text").alias("length"))


def paired(spark: SparkSession, root: str, *, least: int = 0, how: str = "inner") -> DataFrame:
    """Text and metadata of one folder by stem; title defaults to 'Unknown', the folder's name is the source."""
    texts = read_texts(spark, f"{root}/text")
    meta = read_metadata(spark, f"{root}/metadata", "title string, url string")
    joined = meta.join(texts, "stem", how)
    name = root.rstrip("/").rsplit("/", 1)[-1]
    return joined.where(F.coalesce(F.length("text"), F.lit(0)) >= least).select(
        F.col("stem").alias("doc_id"), F.coalesce("title", F.lit("Unknown")).alias("title"), "url", F.lit(name).alias("source"), F.col("text").alias("content")
    )


def many_paired(spark: SparkSession, roots: list[str], *, least: int = 100, max_documents: int | None = None) -> DataFrame:
    out = None
    for root in roots:
        one = paired(spark, root, least=least)
        out = one if out is None else out.unionByName(one)
    return out if max_documents is None else out.orderBy("source", "doc_id").limit(max_documents)


def keyed_union(frames: dict[str, DataFrame], *, distinct: bool = True) -> DataFrame:
    """Several tables under their keys; a row that two keys share counts once unless ``distinct`` is False."""
    out = None
    for key, df in frames.items():
        one = df.withColumn("table_key", F.lit(key))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.dropDuplicates([c for c in out.columns if c != "table_key"]) if distinct else out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: parquet (or a folder of it), json, csv, orc, xml."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "json":
        return spark.read.option("multiLine", True).json(path)
    if suffix == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if suffix == "orc":
        return spark.read.orc(path)
    if suffix == "parquet" or "." not in path.rstrip("/").rsplit("/", 1)[-1]:
        return spark.read.parquet(path)
    raise ValueError(f"unsupported table: {path}")


def ingest_tree(spark: SparkSession, root: str) -> DataFrame:
    """All JSON (lists or records; progress and settings files left out) and text files of a tree: path, title, content, kind."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").option("wholetext", True).text(root)
    path = F.col("_metadata.file_path")
    case = F.when(F.lower(path).rlike("case_law|bailii"), "case").otherwise("legislation")
    one = texts.select(path.alias("path"), F.url_decode(_stem()).alias("title"), F.col("value").alias("content"), case.alias("kind"))
    schema = "title string, content string, court string, citation string, judges string, chapter string, sections string, year string"
    records = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("multiLine", True).json(root)
    two = records.withColumn("path", path).where(~F.lower("path").rlike("progress|settings"))
    return one.unionByName(two.select("path", "title", "content", route_record().alias("kind")).where("kind is not null"))


def route_record(parent: Column | None = None) -> Column:
    """case or legislation by the folder's name, else by which fields a record has; null if neither."""
    case = F.col("court").isNotNull() | F.col("citation").isNotNull() | F.col("judges").isNotNull()
    law = F.col("chapter").isNotNull() | F.col("sections").isNotNull() | F.col("year").isNotNull()
    rule = F.when(case, "case").when(law, "legislation")
    if parent is None:
        return rule
    low = F.lower(parent)
    return F.when(low.rlike("case|bailii"), "case").when(low.rlike("legislation|act"), "legislation").otherwise(rule)


def content_record(record: Column) -> Column:
    """Text of a nested content record (JSON string): body, parts, introduction and more, by blank lines; else its details."""
    v = F.try_parse_json(record)
    one = lambda p: F.try_variant_get(v, p, "string")
    parts = F.try_variant_get(v, "$.details.parts", "array<struct<body:string>>")
    joined = F.concat_ws("\n\n", one("$.details.body"), F.array_join(F.transform(parts, lambda x: x["body"]), "\n\n"), one("$.details.introduction"), one("$.details.more_information"))
    return F.coalesce(F.nullif(joined, F.lit("")), F.try_variant_get(v, "$.details", "string"))


def existing_urls(*frames: tuple[DataFrame, str], base: str) -> DataFrame:
    """Absolute addresses of several metadata tables."""
    out = None
    for df, col in frames:
        url = F.when(F.startswith(F.col(col), F.lit("http")), F.col(col)).otherwise(F.concat(F.lit(base), F.col(col)))
        one = df.where(F.col(col).isNotNull()).select(url.alias("url"))
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(extension, files, bytes) of a tree, from listings: contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return found.groupBy(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("extension")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json", *, files_per_trigger: int = 1000) -> DataFrame:
    """New files as a stream; with a checkpoint, every file counts once across restarts."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


#: Column of what could not be read as a record.
CORRUPT = "_corrupt_record"


def xml_records(spark: SparkSession, path: str, tag: str, schema: str, **options) -> DataFrame:
    """One row for each element ``tag`` of XML files, by a schema (attributes as ``_name``); Spark cuts large files between elements.

    An element that does not fit the schema has its text in ``_corrupt_record``, and its columns are not to be used. Give
    attributes as strings: Spark fails on one that does not fit.
    """
    reader = spark.read.format("xml").option("rowTag", tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(**options).schema(f"{schema}, {CORRUPT} string").load(path)


def parsed_xml(xml: Column, schema: str) -> Column:
    """A struct from the XML in a column; null if it does not parse. A null value gives null."""
    record = F.from_xml(xml, f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return F.when(xml.isNotNull() & record[CORRUPT].isNull(), record)
