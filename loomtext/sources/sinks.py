"""Sinks: tables and files for documents, graphs, vectors and tables; upserts by latest version."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators.chunk import chunks_until_end
from loomtext.operators.rank import latest


def export(df: DataFrame, path: str, fmt: str) -> None:
    if fmt not in ("parquet", "json", "csv", "orc"):
        raise ValueError(f"unsupported format: {fmt}")
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)


def by_domain(df: DataFrame, path: str, column: str = "tax_domain") -> None:
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def upsert(stored: DataFrame | None, changes: DataFrame, key: str, version: str) -> DataFrame:
    """The stored rows with changed ones replaced: the last version of each key."""
    both = changes if stored is None else stored.unionByName(changes, allowMissingColumns=True)
    return latest(both, key, version)


def case_records(cases: DataFrame) -> dict[str, DataFrame]:
    """id, title, content, court, legislation (array) in; document, node, edge and vector-text tables out."""
    heard = cases.where("court is not null").select(F.col("id").alias("src"), F.col("court").alias("dst"), F.lit("HEARD_IN").alias("kind"))
    about = cases.select(F.col("id").alias("src"), F.explode("legislation").alias("dst"), F.lit("RELATES_TO").alias("kind"))
    return {
        "documents": cases,
        "nodes": cases.select("id", "title", F.lit("Case").alias("label")),
        "edges": heard.unionByName(about).distinct(),
        "vectors": vector_texts(cases),
    }


def legislation_records(acts: DataFrame) -> dict[str, DataFrame]:
    """id, title, content, sections array<struct<number, text>> in; also a node and edge for each section."""
    parts = acts.select("id", F.explode("sections").alias("s")).select(F.concat("id", F.lit("_section_"), F.col("s")["number"]).alias("sid"), "id", F.col("s")["text"].alias("text"))
    nodes = acts.select("id", "title", F.lit("Act").alias("label")).unionByName(parts.select(F.col("sid").alias("id"), F.lit(None).cast("string").alias("title"), F.lit("Section").alias("label")))
    return {"documents": acts, "nodes": nodes, "edges": parts.select(F.col("id").alias("src"), F.col("sid").alias("dst"), F.lit("HAS_SECTION").alias("kind")), "vectors": vector_texts(acts)}


def vector_texts(df: DataFrame) -> DataFrame:
    """``{id}_chunk_{i}``, chunk text and a 500-character preview."""
    chunks = df.select("id", F.posexplode(chunks_until_end(F.col("content"))).alias("i", "c"))
    return chunks.select(F.concat(F.col("id"), F.lit("_chunk_"), F.col("i").cast("string")).alias("vector_id"), "id", F.col("c")["text"].alias("text"), F.substring(F.col("c")["text"], 1, 500).alias("preview"))


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def graph_json(nodes: DataFrame, edges: DataFrame, root: str) -> None:
    """Nodes, edges and a totals record as JSON lines."""
    nodes.write.mode("overwrite").json(f"{root}/nodes")
    edges.write.mode("overwrite").json(f"{root}/edges")
    totals = nodes.agg(F.count("*").alias("nodes")).withColumn("edges", edges.agg(F.count("*")).scalar())
    totals.write.mode("overwrite").json(f"{root}/totals")


def save_index(chunks: DataFrame, path: str, *, partition: str | None = None) -> None:
    """Chunks with vectors; partitioned by area or cell, so that searches prune."""
    writer = chunks.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)


def write_sidecar(spark: SparkSession, path: str, values: dict) -> None:
    """A small JSON record beside a table."""
    spark.createDataFrame([(json.dumps(values, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_sidecar(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])
