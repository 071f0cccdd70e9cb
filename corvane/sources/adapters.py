"""Adapters that read the benchmark tables as business records, in Spark and as the same SQL.

documents: source by doc_id mod 3, name and address cut from the text, country the language. part: source by key mod
3, name, type and brand, size. The SQL gives views s1, s2, s3 with the four source columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.operators.contracts import SOURCE_COLUMNS

DOCUMENTS = """
  SELECT 'S' || CAST(doc_id % 3 + 1 AS {text}) AS src, 'S' || CAST(doc_id % 3 + 1 AS {text}) || '-' || CAST(doc_id AS {text}) AS entity_id,
    substr(text, 1, 40) AS business_name, substr(text, 41, 60) AS business_address, lang AS country, text AS whole
  FROM documents"""
PARTS = """
  SELECT 'S' || CAST(p_partkey % 3 + 1 AS {text}) AS src, 'S' || CAST(p_partkey % 3 + 1 AS {text}) || '-' || CAST(p_partkey AS {text}) AS entity_id,
    p_name AS business_name, p_type || ' ' || p_brand AS business_address, 'c' || CAST(p_size AS {text}) AS country, '' AS whole
  FROM part"""


def _records(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(sql.format(text="string").replace(f"FROM {table}", "FROM {df}"), df=df)


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, the source columns, and the whole text."""
    return _records(spark, sf_dir, "documents", DOCUMENTS)


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "part", PARTS)


def three_sources(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(records.filter(f"src = 'S{i}'").select(*SOURCE_COLUMNS) for i in (1, 2, 3))


def document_truth(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gt_entity, gt_pair): records of other sources with the same whole text."""
    left = records.filter("src = 'S1'").selectExpr("entity_id AS source1_entity_id", "md5(whole) AS h")
    right = records.filter("src <> 'S1'").selectExpr("entity_id AS matched_id", "md5(whole) AS h")
    return left.select("source1_entity_id"), left.join(right, "h").select("source1_entity_id", "matched_id")
