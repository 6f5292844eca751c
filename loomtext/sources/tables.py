"""Parquet tables of a folder, and the derived legal corpus used as a test fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Tables of texts, on which the work for each byte is large.
TEXT_TABLES = ("documents", "pages", "conversations")


def spread(df: DataFrame) -> DataFrame:
    """Deal out a table that the scan gives fewer tasks than there are cores, as a file of one row group is one task.

    Tables of more row groups than cores are split by the scan and not shuffled, whatever their size.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


#: Deterministic projection of ``documents`` with titles, citations, references and sections; the same in all engines.
LEGAL_CORPUS = """
SELECT doc_id, lang, source,
  concat(CASE doc_id % 8 WHEN 0 THEN 'Housing Act 1988' WHEN 1 THEN 'Smith v Jones' WHEN 2 THEN 'VAT Regulations 1995'
         WHEN 3 THEN 'HMRC Capital Gains Manual' WHEN 4 THEN 'Practice Direction' WHEN 5 THEN 'Employment note'
         WHEN 6 THEN 'Corporation tax bulletin' ELSE 'General commentary' END, ' no. ', CAST(doc_id AS VARCHAR(20))) AS title,
  concat('[', CAST(1990 + doc_id % 30 AS VARCHAR(20)), '] ', CASE doc_id % 4 WHEN 0 THEN 'UKSC' WHEN 1 THEN 'EWCA'
         WHEN 2 THEN 'EWHC' ELSE 'CSIH' END, ' ', CAST(doc_id AS VARCHAR(20))) AS own_citation,
  CAST(floor(doc_id / 2.0) AS BIGINT) AS cites_a, CAST(floor(doc_id / 3.0) AS BIGINT) AS cites_b,
  concat(
    'Section 1: Scope', chr(10), 'This text ', CASE doc_id % 5 WHEN 0 THEN 'follows the decision in ' WHEN 1 THEN 'distinguished from '
         WHEN 2 THEN 'overruled ' WHEN 3 THEN 'applying the principle from ' ELSE 'considered ' END,
    '[', CAST(1990 + CAST(floor(doc_id / 2.0) AS BIGINT) % 30 AS VARCHAR(20)), '] ',
    CASE CAST(floor(doc_id / 2.0) AS BIGINT) % 4 WHEN 0 THEN 'UKSC' WHEN 1 THEN 'EWCA' WHEN 2 THEN 'EWHC' ELSE 'CSIH' END, ' ',
    CAST(CAST(floor(doc_id / 2.0) AS BIGINT) AS VARCHAR(20)), '. It was ', CASE doc_id % 3 WHEN 0 THEN 'clearly' WHEN 1 THEN 'arguably' ELSE 'so' END,
    ' held; see [2001] 2 WLR 100 and TCGA 1992 s.', CAST(doc_id % 200 AS VARCHAR(20)), '(2), BIM', CAST(10000 + doc_id % 500 AS VARCHAR(20)), '.', chr(10),
    'Section 2: Application', chr(10), CASE doc_id % 6 WHEN 0 THEN 'The landlord and tenant in England agreed rent and lease terms.'
         WHEN 1 THEN 'VAT input tax and output tax for a company in Scotland.' WHEN 2 THEN 'Capital gains on disposal by a trustee of a trust.'
         WHEN 3 THEN 'PAYE, P60 and payroll for an employee.' WHEN 4 THEN 'Inheritance tax: for example a death estate in Northern Ireland.'
         ELSE 'Damages for negligence pursuant to the contract.' END, chr(10),
    'Section 3: General', chr(10), chr(10), text) AS content
FROM {documents}
"""


def legal_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LEGAL_CORPUS, documents=load(spark, sf_dir, "documents"))
