"""Pairwise features: 25 numeric columns per candidate pair, in a fixed order.

Features read the raw, trimmed texts. The two edit measures of name and address come from one Arrow pass; all
else is built-in. Records are looked up by two equi-joins, and an id that its source lacks is an error.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import similarity, text
from corvane.operators import contracts
from corvane.operators.blocking import blocker_names
from corvane.operators.contracts import CANDIDATE_KEY

FEATURE_COLUMNS = [
    "name_exact", "name_ratio", "name_jaccard", "name_levenshtein", "name_token_similarity", "name_length_difference",
    "address_exact", "address_ratio", "address_jaccard", "address_token_similarity", "address_length_difference",
    "address_available_both", "address_missing_source2", "address_missing_source3", "country_exact",
    "name_address_agreement", "name_address_gap", "combined_name_address_score",
    "was_name_block", "was_address_block", "was_country_block", "has_exact_name_block", "has_exact_address_block",
    "multiple_independent_blockers", "num_blockers",
]


def get_feature_columns() -> list[str]:
    """The features in their fixed order."""
    return list(FEATURE_COLUMNS)


_EDIT = T.StructType([T.StructField(c, T.DoubleType()) for c in ("name_ratio", "name_set", "address_ratio", "address_set")])


@F.pandas_udf(_EDIT)
def _edit_measures(name1: pd.Series, name2: pd.Series, address1: pd.Series, address2: pd.Series) -> pd.DataFrame:
    out = []
    for a, b in ((name1, name2), (address1, address2)):
        pairs, at = similarity.distinct_pairs(a, b)
        out += [similarity.indel_ratios(pairs)[at], similarity.set_ratios(pairs)[at]]
    return pd.DataFrame(dict(zip(("name_ratio", "name_set", "address_ratio", "address_set"), out, strict=True)), dtype="float64")


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def _equal(a: Column, b: Column) -> Column:
    return _flag((a != "") & (a == b))


def name_features(a: Column | str, b: Column | str) -> dict[str, Column]:
    a, b = text.strip(a), text.strip(b)
    return _name(a, b, similarity.token_jaccard(a, b), similarity.ratio(a, b), similarity.token_set_ratio(a, b))


def _name(a: Column, b: Column, jaccard: Column, ratio: Column, token_set: Column) -> dict[str, Column]:
    return {
        "name_exact": _equal(a, b),
        "name_ratio": ratio,
        "name_jaccard": jaccard,
        "name_levenshtein": ratio,
        "name_token_similarity": token_set,
        "name_length_difference": similarity.length_difference(a, b).cast("double"),
    }


def address_features(a: Column | str, b: Column | str, source: Column | str) -> dict[str, Column]:
    a, b = text.strip(a), text.strip(b)
    source = F.col(source) if isinstance(source, str) else source
    return _address(a, b, source, similarity.token_jaccard(a, b), similarity.ratio(a, b), similarity.token_set_ratio(a, b))


def _address(a: Column, b: Column, source: Column, jaccard: Column, ratio: Column, token_set: Column) -> dict[str, Column]:
    return {
        "address_exact": _equal(a, b),
        "address_ratio": ratio,
        "address_jaccard": jaccard,
        "address_token_similarity": token_set,
        "address_length_difference": similarity.length_difference(a, b).cast("double"),
        "address_available_both": _flag((a != "") & (b != "")),
        "address_missing_source2": _flag((source == "S2") & (b == "")),
        "address_missing_source3": _flag((source == "S3") & (b == "")),
    }


def country_features(a: Column | str, b: Column | str) -> dict[str, Column]:
    return {"country_exact": _equal(text.strip(a), text.strip(b))}


def cross_field_features(name_token_set: Column, address_token_set: Column, available: Column) -> dict[str, Column]:
    """Agreement, gap and mean of the two token-set scores; without both addresses 0, 0 and the name's score."""
    both = available == 1.0
    return {
        "name_address_agreement": F.when(both, F.least(name_token_set, address_token_set)).otherwise(F.lit(0.0)),
        "name_address_gap": F.when(both, F.abs(name_token_set - address_token_set)).otherwise(F.lit(0.0)),
        "combined_name_address_score": F.when(both, (name_token_set + address_token_set) / F.lit(2.0)).otherwise(name_token_set),
    }


def provenance_features(names: Column, num_blockers: Column) -> dict[str, Column]:
    """From an array of blocker names; num_blockers is taken as given."""
    joined = F.lower(F.array_join(names, ","))  # a word of a name is a word of the list: none spans a comma
    contains = lambda word: _flag(F.contains(joined, F.lit(word)))
    return {
        "was_name_block": contains("name"),
        "was_address_block": contains("address"),
        "was_country_block": contains("country"),
        "has_exact_name_block": _flag(F.array_contains(names, "name_exact")),
        "has_exact_address_block": _flag(F.array_contains(names, "address_exact")),
        "multiple_independent_blockers": _flag(F.size(names) >= 2),
        "num_blockers": num_blockers.cast("double"),
    }


class FeatureEngineer:
    """Turns candidate pairs into feature rows."""

    def validate_candidate_contract(self, candidate_pairs: DataFrame) -> None:
        contracts.require_columns(candidate_pairs, contracts.CANDIDATE_COLUMNS, "candidate pairs")
        unknown = F.isnull("candidate_source") | ~F.col("candidate_source").isin(contracts.TARGET_SOURCES)
        contracts.require_none(candidate_pairs, {"an unknown source": unknown}, "candidate pairs")

    def validate_source_contract(self, source: DataFrame, source_name: str) -> None:
        contracts.require_columns(source, contracts.SOURCE_COLUMNS, source_name)

    def attach_records(self, source1: DataFrame, source2: DataFrame, source3: DataFrame, candidate_pairs: DataFrame) -> DataFrame:
        """Candidate pairs with both records' trimmed texts (name_1, address_1, country_1 and _2) and word sets (name_set_1,
        address_set_1 and _2). Those are made once a record, before it meets its pairs. Unknown ids raise when run."""

        def record(df: DataFrame, n: int, *ids: Column) -> DataFrame:
            trimmed = df.select(*ids, *[text.strip(c).alias(f"{a}_{n}") for c, a in zip(contracts.SOURCE_COLUMNS[1:], ("name", "address", "country"), strict=True)])
            return trimmed.select("*", *[text.token_set(f"{a}_{n}").alias(f"{a}_set_{n}") for a in ("name", "address")])

        left = record(source1, 1, F.col("entity_id").alias("source1_entity_id"))
        target = lambda df, source: record(df, 2, F.lit(source).alias("candidate_source"), F.col("entity_id").alias("candidate_entity_id"))
        right = target(source2, "S2").unionByName(target(source3, "S3"))
        met = candidate_pairs.join(left, "source1_entity_id", "left").join(right, ["candidate_source", "candidate_entity_id"], "left")
        known = lambda c, who: F.when(F.isnotnull(c), F.col(c)).otherwise(F.raise_error(F.concat(F.lit(f"id that {who} lacks: "), F.coalesce(F.col("source1_entity_id"), F.lit("null")), F.lit(" "), F.coalesce(F.col("candidate_entity_id"), F.lit("null")))))
        return met.withColumns({"name_1": known("name_1", "source 1"), "name_2": known("name_2", "the candidate's source")})

    def transform(self, source1: DataFrame, source2: DataFrame, source3: DataFrame, candidate_pairs: DataFrame) -> DataFrame:
        """The pair key and the features, one row per candidate pair. Lazy: unknown sources raise when run."""
        contracts.require_columns(candidate_pairs, contracts.CANDIDATE_COLUMNS, "candidate pairs")
        for df, name in ((source1, "source 1"), (source2, "source 2"), (source3, "source 3")):
            self.validate_source_contract(df, name)
        is_array = candidate_pairs.schema["blocker_sources"].dataType.typeName() == "array"
        source = F.when(F.col("candidate_source").isin(contracts.TARGET_SOURCES), F.col("candidate_source")).otherwise(F.raise_error(F.lit("candidate pairs: an unknown source")))
        pairs = candidate_pairs.select(*CANDIDATE_KEY[:2], source.alias("candidate_source"), blocker_names(F.col("blocker_sources"), is_array).alias("_names"), F.col("num_blockers").alias("_num"))
        met = self.attach_records(source1, source2, source3, pairs)
        met = met.withColumn("_edit", _edit_measures("name_1", "name_2", "address_1", "address_2"))
        jaccard = {c: similarity.set_jaccard(F.col(f"{c}_set_1"), F.col(f"{c}_set_2")) for c in ("name", "address")}
        name = _name(F.col("name_1"), F.col("name_2"), jaccard["name"], F.col("_edit.name_ratio"), F.col("_edit.name_set"))
        address = _address(F.col("address_1"), F.col("address_2"), F.col("candidate_source"), jaccard["address"], F.col("_edit.address_ratio"), F.col("_edit.address_set"))
        cross = cross_field_features(F.col("_edit.name_set"), F.col("_edit.address_set"), address["address_available_both"])
        every = name | address | {"country_exact": _equal(F.col("country_1"), F.col("country_2"))} | cross | provenance_features(F.col("_names"), F.col("_num"))
        return met.select(*CANDIDATE_KEY, *[every[c].alias(c) for c in FEATURE_COLUMNS])
