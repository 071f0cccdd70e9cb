"""Schemas and contract checks of record linkage.

Each check is one aggregate over its table; only counts reach the driver, and a breach raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.text import strip

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
NORMALIZED_COLUMNS = ["business_name_normalized", "business_address_normalized", "country_normalized"]
FINGERPRINT_COLUMNS = ["name_fingerprint", "address_fingerprint", "country_fingerprint"]
CANDIDATE_KEY = ["source1_entity_id", "candidate_entity_id", "candidate_source"]
CANDIDATE_COLUMNS = [*CANDIDATE_KEY, "blocker_sources", "num_blockers"]
SCORED_COLUMNS = [*CANDIDATE_KEY, "score"]
TARGET_SOURCES = ["S2", "S3"]

SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS])
CANDIDATE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CANDIDATE_COLUMNS[:4]] + [T.StructField("num_blockers", T.LongType())])


def require_columns(df: DataFrame, columns: Sequence[str], name: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")


def require_none(df: DataFrame, faults: dict[str, Column], name: str, more: dict[str, Column] | None = None) -> dict:
    """Raise if any row has a fault; returns further aggregates asked for in ``more``."""
    keys, extra = list(faults), more or {}
    row = df.agg(*[F.count_if(faults[k]).alias(f"f{i}") for i, k in enumerate(keys)], *[c.alias(k) for k, c in extra.items()]).first()
    found = {k: row[f"f{i}"] for i, k in enumerate(keys) if row[f"f{i}"]}
    if found:
        raise ValueError(f"{name}: " + ", ".join(f"{n} rows with {k}" for k, n in found.items()))
    return {k: row[k] for k in extra}


def blank(c: str) -> Column:
    """Null, or nothing but white space."""
    return F.isnull(c) | (strip(c) == "")


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    again = df.groupBy(*keys).count().filter("count > 1").limit(1).count()
    if again:
        raise ValueError(f"{name}: {list(keys)} repeat")


def validate_source(df: DataFrame, source_name: str = "source") -> None:
    """Required columns, no null or blank ids, no id twice."""
    require_columns(df, SOURCE_COLUMNS, source_name)
    require_none(df, {"a null id": F.isnull("entity_id"), "a blank id": blank("entity_id")}, source_name)
    require_unique(df, ["entity_id"], source_name)


def validate_fingerprint_columns(df: DataFrame) -> None:
    require_columns(df, FINGERPRINT_COLUMNS, "source")


def validate_candidate_pairs(pairs: DataFrame) -> None:
    """Columns, sources, ids, at least one blocker, no pair twice."""
    require_columns(pairs, CANDIDATE_COLUMNS, "candidate pairs")
    require_none(
        pairs,
        {
            "a blank source-1 id": blank("source1_entity_id"),
            "a blank candidate id": blank("candidate_entity_id"),
            "an unknown source": F.isnull("candidate_source") | ~F.col("candidate_source").isin(TARGET_SOURCES),
            "no blocker": F.isnull("num_blockers") | (F.col("num_blockers") < 1),
        },
        "candidate pairs",
    )
    require_unique(pairs, CANDIDATE_KEY, "candidate pairs")


def validate_candidate_ids(pairs: DataFrame, source1: DataFrame, source2: DataFrame, source3: DataFrame) -> None:
    """Every id of a candidate pair is one of its source's."""
    unknown = {
        "source 1": pairs.join(source1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_anti"),
        "source 2": pairs.filter("candidate_source = 'S2'").join(source2.select(F.col("entity_id").alias("candidate_entity_id")), "candidate_entity_id", "left_anti"),
        "source 3": pairs.filter("candidate_source = 'S3'").join(source3.select(F.col("entity_id").alias("candidate_entity_id")), "candidate_entity_id", "left_anti"),
    }
    for name, rows in unknown.items():
        if rows.limit(1).count():
            raise ValueError(f"candidate pairs: ids that {name} lacks")


def validate_scored_pairs(scored: DataFrame) -> None:
    """Columns, ids, and scores that are numbers in [0, 1]."""
    require_columns(scored, SCORED_COLUMNS, "scored pairs")
    s = F.col("score").cast("double")
    require_none(
        scored,
        {
            "a blank source-1 id": blank("source1_entity_id"),
            "a blank candidate id": blank("candidate_entity_id"),
            "a null source": F.isnull("candidate_source"),
            "a score outside [0, 1]": F.isnull(s) | F.isnan(s) | (s < 0) | (s > 1),
        },
        "scored pairs",
    )


def checked_scores(scored: DataFrame) -> DataFrame:
    """``scored`` as it is, failing where a score is no number in [0, 1]: checked as the rows pass, without a pass of its own."""
    s = F.col("score").cast("double")
    wrong = F.isnull(s) | F.isnan(s) | (s < 0) | (s > 1)
    return scored.withColumn("score", F.when(wrong, F.raise_error(F.lit("a score outside [0, 1]")).cast("double")).otherwise(F.col("score")))


def validate_labels(df: DataFrame, label: str = "label") -> dict:
    """Labels 0 and 1, both present; returns their counts."""
    require_columns(df, [label], "training rows")
    y = F.col(label)
    counts = require_none(df, {"a label other than 0 and 1": F.isnull(y) | ~y.isin(0, 1)}, "training rows", {"n": F.count(F.lit(1)), "positive": F.count_if(y == 1)})
    if not counts["n"]:
        raise ValueError("training rows: none")
    if counts["positive"] in (0, counts["n"]):
        raise ValueError("training rows: both labels are needed")
    return counts


def validate_features(df: DataFrame, columns: Sequence[str]) -> None:
    """All features present and finite."""
    require_columns(df, columns, "features")
    wrong = F.lit(False)
    for c in columns:
        x = F.col(c).cast("double")
        wrong = wrong | F.isnull(x) | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    require_none(df, {"a feature that is no number": wrong}, "features")
