"""Candidate generation: twelve blockers as one equi-join, frequency caps, provenance fusion.

Every record of a side becomes rows (entity_id, bit, k1, k2), one per key of each blocker; one join on
(bit, k1, k2) serves all blockers, and ``bit_or`` over the pairs fuses their provenance at the same time.

A cap drops a key outright if more targets of one source have it than allowed. Keys are counted by an aggregate,
combined before the shuffle, and the surviving (key, source) rows filter the targets by a semi-join: no key's
rows ever need to meet in one task, however frequent it is. After the cap a key has few targets, so the
join's output is bounded by the source-1 side times the cap.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text
from corvane.operators import contracts
from corvane.operators.contracts import CANDIDATE_COLUMNS, CANDIDATE_KEY

#: Each blocker's provenance bit.
BLOCKER_BITS = {
    "name_exact": 1,
    "address_exact": 2,
    "name_country": 4,
    "address_country": 8,
    "name_token_country": 16,
    "name_prefix_country": 32,
    "address_token_country": 64,
    "address_prefix_country": 128,
    "name_token_pair_country": 256,
    "address_token_pair_country": 512,
    "name_token": 1024,
    "name_soundex_country": 2048,
}
FUZZY_BLOCKER = "fuzzy_name_address"
FUZZY_BIT = 4096
EXACT_BLOCKERS = ("name_exact", "address_exact", "name_country", "address_country")


@dataclass(frozen=True)
class BlockingConfig:
    """Which blockers run, and their limits."""

    enable_name_exact: bool = True
    enable_address_exact: bool = True
    enable_name_country: bool = True
    enable_address_country: bool = True
    enable_name_token_country: bool = True
    enable_name_prefix_country: bool = True
    enable_address_token_country: bool = True
    enable_address_prefix_country: bool = True
    enable_name_token_pair_country: bool = True
    enable_address_token_pair_country: bool = True
    enable_name_token: bool = True
    enable_name_soundex_country: bool = True
    min_token_length: int = 3
    max_token_signatures_per_record: int = 3
    pair_min_token_length: int = 2
    max_signature_frequency: int = 100
    max_exact_key_frequency: int = 100
    prefix_length: int = 4
    name_token_min_length: int = 4

    def only(self, *blockers: str) -> BlockingConfig:
        """The same limits with these blockers alone."""
        return replace(self, **{f.name: f.name.removeprefix("enable_") in blockers for f in fields(self) if f.name.startswith("enable_")})

    @classmethod
    def exact_only(cls) -> BlockingConfig:
        return cls().only(*EXACT_BLOCKERS)

    @property
    def blockers(self) -> list[str]:
        return [b for b in BLOCKER_BITS if getattr(self, f"enable_{b}")]

    def cap(self, blocker: str) -> int | None:
        """Most targets that a key may have; None for no limit."""
        if blocker in EXACT_BLOCKERS:
            return self.max_exact_key_frequency if self.max_exact_key_frequency > 0 else None
        return max(1, self.max_signature_frequency) if blocker == "name_token" else max(0, self.max_signature_frequency)


# ---- prepared columns


def add_normalized_columns(df: DataFrame) -> DataFrame:
    """Adds the three normalised columns."""
    contracts.require_columns(df, contracts.SOURCE_COLUMNS[1:], "source")
    return df.withColumns({n: text.normalize_text(c) for n, c in zip(contracts.NORMALIZED_COLUMNS, contracts.SOURCE_COLUMNS[1:], strict=True)})


def add_fingerprint_columns(df: DataFrame) -> DataFrame:
    """Adds the three fingerprint columns, of the normalised columns."""
    if not isinstance(df, DataFrame):
        raise TypeError("a DataFrame is expected")
    contracts.require_columns(df, contracts.NORMALIZED_COLUMNS, "source")
    return df.withColumns({f: text.fingerprint_text(c) for f, c in zip(contracts.FINGERPRINT_COLUMNS, contracts.NORMALIZED_COLUMNS, strict=True)})


def non_empty_fingerprint(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) != ""


def prepare(df: DataFrame) -> DataFrame:
    return add_fingerprint_columns(add_normalized_columns(df))


# ---- keys


def _keys(blocker: str, config: BlockingConfig) -> Column:
    """The record's keys (k1, k2) for a blocker, as an array."""
    name, address = "business_name", "business_address"
    name_print, address_print, country = (text.strip(c) for c in contracts.FINGERPRINT_COLUMNS)
    none = F.array().cast("array<struct<k1:string,k2:string>>")
    one = lambda k1, k2: F.array(F.struct(k1.alias("k1"), k2.alias("k2")))
    each = lambda words: F.transform(words, lambda t: F.struct(t.alias("k1"), country.alias("k2")))
    full = lambda k1, k2: F.when((k1 != "") & (k2 != ""), one(k1, k2)).otherwise(none)
    some = lambda k1: F.when(k1 != "", one(k1, country)).otherwise(none)
    alone = lambda k1: F.when(k1 != "", one(k1, F.lit(""))).otherwise(none)
    least, most = config.min_token_length, config.max_token_signatures_per_record
    match blocker:
        case "name_exact":
            return alone(name_print)
        case "address_exact":
            return alone(address_print)
        case "name_country":
            return full(name_print, country)
        case "address_country":
            return full(address_print, country)
        case "name_token_country":
            return each(text.token_signatures(name, least, most))
        case "address_token_country":
            return each(text.token_signatures(address, least, most))
        case "name_prefix_country":
            return some(text.prefix_signature(name, least, config.prefix_length))
        case "address_prefix_country":
            return some(text.prefix_signature(address, least, config.prefix_length))
        case "name_token_pair_country":
            return some(text.token_pair_signature(name, config.pair_min_token_length))
        case "address_token_pair_country":
            return some(text.token_pair_signature(address, config.pair_min_token_length))
        case "name_token":
            words = text.name_tokens("business_name_normalized", config.name_token_min_length)
            return F.transform(words, lambda t: F.struct(t.alias("k1"), F.lit("").alias("k2")))
        case "name_soundex_country":
            return each(text.soundex_signatures(name, least, most))
    raise ValueError(f"unknown blocker {blocker!r}")


def blocking_keys(df: DataFrame, config: BlockingConfig, keep: tuple[str, ...] = ("entity_id",)) -> DataFrame:
    """(kept columns, bit, k1, k2) of every record and enabled blocker."""
    rows = [_tagged(b, config) for b in config.blockers]
    if not rows:
        return df.select(*keep, F.lit(0).alias("bit"), F.lit("").alias("k1"), F.lit("").alias("k2")).limit(0)
    return df.select(*keep, F.inline(F.concat(*rows)))


def _tagged(blocker: str, config: BlockingConfig) -> Column:
    bit = F.lit(BLOCKER_BITS[blocker])
    return F.transform(_keys(blocker, config), lambda k: F.struct(bit.alias("bit"), k["k1"].alias("k1"), k["k2"].alias("k2")))


def apply_key_frequency_cap(keys: DataFrame, config: BlockingConfig, by: tuple[str, ...] = ("source", "bit", "k1", "k2")) -> DataFrame:
    """Target rows whose key is not more frequent within its source than the blocker's cap."""
    limits = {b: config.cap(b) for b in config.blockers}
    limit = F.lit(None).cast("long")
    for b, n in limits.items():
        if n is not None:
            limit = F.when(F.col("bit") == BLOCKER_BITS[b], F.lit(n)).otherwise(limit)
    rare = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.isnull(limit) | (F.col("n") <= limit)).select(*by)
    return keys.join(rare, list(by), "left_semi")


def cap_key_frequency(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Rows whose key occurs at most ``most`` times; all rows if ``most`` is not positive."""
    if most <= 0:
        return df
    return df.join(df.groupBy(*keys).count().filter(F.col("count") <= most).select(*keys), keys, "left_semi")


def _check_prepared(df: DataFrame, config: BlockingConfig, name: str) -> None:
    contracts.require_columns(df, [*contracts.SOURCE_COLUMNS, *contracts.FINGERPRINT_COLUMNS], name)
    if config.enable_name_token:
        contracts.require_columns(df, ["business_name_normalized"], name)


def blocker_rows(source1: DataFrame, targets: DataFrame, config: BlockingConfig) -> DataFrame:
    """(pair key, bit): the unfused output; ``targets`` has a column ``source``. A pair may repeat under a bit."""
    left = blocking_keys(source1, config).withColumnRenamed("entity_id", "source1_entity_id")
    capped = apply_key_frequency_cap(blocking_keys(targets, config, ("source", "entity_id")), config)
    met = left.join(capped, ["bit", "k1", "k2"])
    return met.select("source1_entity_id", F.col("entity_id").alias("candidate_entity_id"), F.col("source").alias("candidate_source"), "bit")


# ---- provenance


def render_blockers(mask: Column | str) -> Column:
    """A mask as comma-separated names in alphabetical order, the fuzzy blocker last."""
    mask = F.col(mask) if isinstance(mask, str) else mask
    named = [(n, BLOCKER_BITS[n]) for n in sorted(BLOCKER_BITS)] + [(FUZZY_BLOCKER, FUZZY_BIT)]
    return F.concat_ws(",", *[F.when(mask.bitwiseAND(F.lit(bit)) != 0, F.lit(n)) for n, bit in named])


def blocker_names(column: Column, is_array: bool) -> Column:
    """Provenance, a comma-separated string or an array, as an array of names."""
    return F.array_distinct(F.filter(F.transform(column if is_array else F.split(text.text_of(column), ","), lambda x: F.trim(x)), lambda x: x != ""))


def blocker_mask(names: Column) -> Column:
    """Names as a mask; unknown names count for nothing."""
    return reduce(lambda m, b: m.bitwiseOR(F.when(F.array_contains(names, b[0]), F.lit(b[1])).otherwise(0)), [*BLOCKER_BITS.items(), (FUZZY_BLOCKER, FUZZY_BIT)], F.lit(0))


def _fused(rows: DataFrame, bit: str) -> DataFrame:
    masks = rows.groupBy(*CANDIDATE_KEY).agg(F.bit_or(bit).alias("_mask"))
    return masks.select(*CANDIDATE_KEY, render_blockers("_mask").alias("blocker_sources"), F.bit_count("_mask").cast("long").alias("num_blockers"))


def fuse_candidate_pairs(frames: Iterable[DataFrame] | DataFrame) -> DataFrame:
    """One row per pair with all its blockers; raises for unknown or missing blocker names. Fused frames may be fused again."""
    frames = [frames] if isinstance(frames, DataFrame) else list(frames)
    if not frames:
        raise ValueError("no candidate frames")
    parts = []
    for f in frames:
        contracts.require_columns(f, CANDIDATE_COLUMNS[:4], "candidate frame")
        names = blocker_names(F.col("blocker_sources"), f.schema["blocker_sources"].dataType.typeName() == "array")
        parts.append(f.select(*CANDIDATE_KEY, names.alias("_names")))
    rows = reduce(DataFrame.unionByName, parts)
    known = F.array(*[F.lit(n) for n in [*BLOCKER_BITS, FUZZY_BLOCKER]])
    contracts.require_none(rows, {"an unknown or no blocker": (F.size("_names") == 0) | (F.size(F.array_except("_names", known)) > 0)}, "candidate frames")
    return _fused(rows.select(*CANDIDATE_KEY, blocker_mask(F.col("_names")).alias("_bit")), "_bit")


# ---- entry points


def empty_candidates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], contracts.CANDIDATE_SCHEMA)


def generate_candidate_pairs(source1: DataFrame, source2: DataFrame, source3: DataFrame, config: BlockingConfig | None = None) -> DataFrame:
    """Fused candidate pairs of source 1 with both targets, whose keys are capped apart."""
    config = config or BlockingConfig()
    for df, name in ((source1, "source 1"), (source2, "source 2"), (source3, "source 3")):
        _check_prepared(df, config, name)
    columns = [*contracts.SOURCE_COLUMNS, *contracts.FINGERPRINT_COLUMNS, *(["business_name_normalized"] if config.enable_name_token else [])]
    targets = source2.select(*columns).withColumn("source", F.lit("S2")).unionByName(source3.select(*columns).withColumn("source", F.lit("S3")))
    return _fused(blocker_rows(source1, targets, config), "bit")


def generate_candidates_for_target(source1: DataFrame, target: DataFrame, target_source: str, config: BlockingConfig | None = None) -> DataFrame:
    """Fused candidate pairs of source 1 with one target."""
    if target_source not in contracts.TARGET_SOURCES:
        raise ValueError(f"unknown target source {target_source!r}")
    config = config or BlockingConfig()
    for df, name in ((source1, "source 1"), (target, target_source)):
        _check_prepared(df, config, name)
    return _fused(blocker_rows(source1, target.withColumn("source", F.lit(target_source)), config), "bit")


def run_single_key_block(source1: DataFrame, target: DataFrame, target_source: str, key_column: str, blocker_name: str, max_exact_key_frequency: int = 100) -> DataFrame:
    """Pairs that agree on one non-empty column."""
    return _column_block(source1, target, target_source, [key_column], blocker_name, max_exact_key_frequency)


def run_composite_block(source1: DataFrame, target: DataFrame, target_source: str, left_column: str, right_column: str, blocker_name: str, max_exact_key_frequency: int = 100) -> DataFrame:
    """Pairs that agree on two non-empty columns."""
    return _column_block(source1, target, target_source, [left_column, right_column], blocker_name, max_exact_key_frequency)


def _column_block(source1: DataFrame, target: DataFrame, target_source: str, columns: list[str], blocker: str, cap: int) -> DataFrame:
    key = [f"_k{i}" for i in range(len(columns))]
    keyed = lambda df: df.select("entity_id", *[text.strip(c).alias(k) for c, k in zip(columns, key, strict=True)]).filter(" AND ".join(f"{k} <> ''" for k in key))
    right = cap_key_frequency(keyed(target), key, cap)
    met = keyed(source1).withColumnRenamed("entity_id", "source1_entity_id").join(right, key)
    return _one_blocker(met.select("source1_entity_id", F.col("entity_id").alias("candidate_entity_id")), target_source, blocker)


def run_signature_block(source1: DataFrame, target: DataFrame, target_source: str, blocker_name: str, config: BlockingConfig | None = None) -> DataFrame:
    """Pairs of one blocker, whichever."""
    config = (config or BlockingConfig()).only(blocker_name)
    rows = blocker_rows(source1, target.withColumn("source", F.lit(target_source)), config)
    return _one_blocker(rows.select(*CANDIDATE_KEY[:2]), target_source, blocker_name)


def run_name_token_block(source1: DataFrame, target: DataFrame, target_source: str, config: BlockingConfig | None = None) -> DataFrame:
    return run_signature_block(source1, target, target_source, "name_token", config)


def _one_blocker(pairs: DataFrame, target_source: str, blocker: str) -> DataFrame:
    return pairs.distinct().select(
        "source1_entity_id", "candidate_entity_id", F.lit(target_source).alias("candidate_source"), F.lit(blocker).alias("blocker_sources"), F.lit(1).cast("long").alias("num_blockers")
    )


#: The variant's blockers and the columns of their keys.
SIMPLE_KEYS = {
    "name_exact": ("name",), "address_exact": ("address",), "name_country": ("name", "country"), "address_country": ("address", "country"),
    "name_token_country": ("name_tokens", "country"), "name_prefix_country": ("name_prefix", "country"),
    "address_token_country": ("address_tokens", "country"), "address_prefix_country": ("address_prefix", "country"),
}


def generate_simple_candidates(source1: DataFrame, source2: DataFrame, source3: DataFrame, cap: int = 100) -> DataFrame:
    """The eight-blocker variant: sorted word sets and 8-character prefixes of the recovery form as keys."""

    def keyed(df: DataFrame, source: str) -> DataFrame:
        name, address, country = (text.recovery_normalize(c) for c in contracts.SOURCE_COLUMNS[1:])
        base = df.select("entity_id", name.alias("name"), address.alias("address"), country.alias("country"))
        forms = base.select(
            "*", text.sorted_tokens("name").alias("name_tokens"), text.sorted_tokens("address").alias("address_tokens"),
            text.leading_text("name").alias("name_prefix"), text.leading_text("address").alias("address_prefix"),
        )
        keys = [
            F.when(F.greatest(*[F.col(c) == "" for c in columns], F.lit(False)), None).otherwise(
                F.struct(F.lit(BLOCKER_BITS[b]).alias("bit"), F.col(columns[0]).alias("k1"), (F.col(columns[1]) if columns[1:] else F.lit("")).alias("k2"))
            )
            for b, columns in SIMPLE_KEYS.items()
        ]
        rows = F.filter(F.array(*keys), lambda k: F.isnotnull(k))
        return forms.select(F.lit(source).alias("source"), "entity_id", F.inline(rows))

    targets = cap_key_frequency(keyed(source2, "S2").unionByName(keyed(source3, "S3")), ["source", "bit", "k1", "k2"], cap)
    left = keyed(source1, "S1").select(F.col("entity_id").alias("source1_entity_id"), "bit", "k1", "k2")
    met = left.join(targets, ["bit", "k1", "k2"])
    return _fused(met.select("source1_entity_id", F.col("entity_id").alias("candidate_entity_id"), F.col("source").alias("candidate_source"), "bit"), "bit")
