"""Retrieval and matching metrics as aggregates.

Ground truth is two tables: gt_entity(source1_entity_id), true singletons included, and gt_pair(source1_entity_id,
matched_id). Every metric is a DataFrame of one row, or one row per group; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators import contracts
from corvane.operators.blocking import BLOCKER_BITS, blocker_mask, blocker_names


def _pairs(df: DataFrame, column: str) -> DataFrame:
    return df.select("source1_entity_id", F.col(column).alias("id")).distinct()


def _ratio(a: Column, b: Column, empty: float) -> Column:
    return F.when(b == 0, F.lit(empty)).otherwise(a.cast("double") / b)


def _f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    b2 = beta * beta
    return F.when(b2 * p + r == 0, F.lit(0.0)).otherwise((1 + b2) * p * r / (b2 * p + r))


def true_matches(gt_pair: DataFrame, source1_entity_id: str) -> DataFrame:
    return gt_pair.filter(F.col("source1_entity_id") == source1_entity_id).select("matched_id").distinct()


def is_true_match(gt_pair: DataFrame, source1_entity_id: str, candidate_entity_id: str) -> bool:
    """Whether one pair is true; for many pairs use ``label_candidate_pairs``."""
    return bool(true_matches(gt_pair, source1_entity_id).filter(F.col("matched_id") == candidate_entity_id).limit(1).count())


def entity_metrics(gt_entity: DataFrame, gt_pair: DataFrame, predictions: DataFrame, predicted: str = "candidate_entity_id") -> DataFrame:
    """tp, fp, fn, precision, recall and f05 per ground-truth entity.

    Both sides empty counts as perfect, one side alone empty as zero. Predictions of other entities play no part.
    """
    truth, guess = _pairs(gt_pair, "matched_id").withColumn("t", F.lit(1)), _pairs(predictions, predicted).withColumn("p", F.lit(1))
    both = truth.join(guess, ["source1_entity_id", "id"], "full")
    per = both.groupBy("source1_entity_id").agg(
        F.count_if(F.isnotnull("t") & F.isnotnull("p")).alias("tp"), F.count_if(F.isnull("t")).alias("fp"), F.count_if(F.isnull("p")).alias("fn")
    )
    out = gt_entity.select("source1_entity_id").distinct().join(per, "source1_entity_id", "left").fillna(0, ["tp", "fp", "fn"])
    t, n = F.col("tp") + F.col("fn"), F.col("tp") + F.col("fp")
    none = (t == 0) & (n == 0)
    p = F.when(none, F.lit(1.0)).otherwise(_ratio(F.col("tp"), n, 0.0))
    r = F.when(none, F.lit(1.0)).otherwise(_ratio(F.col("tp"), t, 0.0))
    out = out.withColumn("precision", p).withColumn("recall", r)
    return out.withColumn("f05", _f_beta(F.col("precision"), F.col("recall")))


def macro_metrics(gt_entity: DataFrame, gt_pair: DataFrame, predictions: DataFrame, predicted: str = "candidate_entity_id") -> DataFrame:
    """Means of the entity metrics; zeros without entities."""
    per = entity_metrics(gt_entity, gt_pair, predictions, predicted)
    return per.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in ("precision", "recall", "f05")])


def candidate_recall(gt_pair: DataFrame, candidates: DataFrame) -> DataFrame:
    """total_true_matches, retrieved_true_matches, candidate_recall (1 without truths)."""
    met = _pairs(gt_pair, "matched_id").join(_pairs(candidates, "candidate_entity_id").withColumn("c", F.lit(1)), ["source1_entity_id", "id"], "left")
    out = met.agg(F.count(F.lit(1)).alias("total_true_matches"), F.count("c").alias("retrieved_true_matches"))
    return out.withColumn("candidate_recall", _ratio(F.col("retrieved_true_matches"), F.col("total_true_matches"), 1.0))


def _distribution(counts: DataFrame, suffix: str) -> list[Column]:
    n = F.col("n").cast("double")
    point = lambda q: F.coalesce(F.percentile(n, F.lit(q)), F.lit(0.0))
    return [
        F.coalesce(F.avg(n), F.lit(0.0)).alias(f"avg{suffix}"), point(0.5).alias(f"median{suffix}"), point(0.9).alias(f"p90{suffix}"),
        point(0.95).alias(f"p95{suffix}"), point(0.99).alias(f"p99{suffix}"), F.coalesce(F.max("n"), F.lit(0)).cast("long").alias(f"max{suffix}"),
    ]


def candidate_distribution(entities: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates per source-1 entity, entities without any included; percentiles interpolate."""
    per = _pairs(candidates, "candidate_entity_id").groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n"))
    counts = entities.select("source1_entity_id").distinct().join(per, "source1_entity_id", "left").fillna(0, ["n"])
    return counts.agg(
        F.count(F.lit(1)).alias("num_source1_entities"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_candidate_pairs"), *_distribution(counts, "_candidates_per_s1")
    )


def summarize_candidates(candidate_pairs: DataFrame) -> DataFrame:
    """Totals, by target, and mean, median and maximum over the source-1 entities that have candidates."""
    per = candidate_pairs.groupBy("source1_entity_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("candidate_source") == "S2").alias("s2"), F.count_if(F.col("candidate_source") == "S3").alias("s3")
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per.agg(
        total("n").alias("total_candidate_pairs"), F.count(F.lit(1)).alias("unique_source1_entities"), total("s2").alias("s2_candidate_pairs"), total("s3").alias("s3_candidate_pairs"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("average_candidates_per_source1"),
        F.coalesce(F.percentile(F.col("n").cast("double"), F.lit(0.5)), F.lit(0.0)).alias("median_candidates_per_source1"),
        F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("max_candidates_per_source1"),
    )


def label_candidate_pairs(candidate_pairs: DataFrame, gt_pair: DataFrame) -> DataFrame:
    """Candidate pairs with label 1 if the pair is true, else 0."""
    truth = gt_pair.select("source1_entity_id", F.col("matched_id").alias("candidate_entity_id"), F.lit(1).alias("_true")).distinct()
    met = candidate_pairs.join(truth, ["source1_entity_id", "candidate_entity_id"], "left")
    return met.select(*candidate_pairs.columns, F.coalesce("_true", F.lit(0)).alias("label"))


def retrieval_report(gt_entity: DataFrame, gt_pair: DataFrame, candidate_pairs: DataFrame) -> DataFrame:
    """Recall overall and by target (id prefix), missed entities, counts per ground-truth entity, and the blocks of
    entities without and with several matches. total_candidate_pairs counts every row; other rows of entities
    outside the ground truth play no part."""
    truth = _pairs(gt_pair, "matched_id").withColumn("t", F.lit(1))
    rows = candidate_pairs.groupBy("source1_entity_id", F.col("candidate_entity_id").alias("id")).agg(F.count(F.lit(1)).alias("c"))
    met = truth.join(rows, ["source1_entity_id", "id"], "full")
    hit = F.isnotnull("t") & F.isnotnull("c")
    of = lambda p: F.isnotnull("t") & F.startswith("id", F.lit(p))
    per = met.groupBy("source1_entity_id").agg(
        F.count("t").alias("truths"), F.count_if(hit).alias("hits"), F.count("c").alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("every"),
        F.count_if(of("S2-")).alias("s2"), F.count_if(of("S2-") & hit).alias("s2_hits"), F.count_if(of("S3-")).alias("s3"), F.count_if(of("S3-") & hit).alias("s3_hits"),
    )
    every = gt_entity.select("source1_entity_id").distinct().withColumn("known", F.lit(True)).join(per, "source1_entity_id", "full")
    every = every.fillna(0).withColumn("known", F.coalesce("known", F.lit(False)))
    known = F.col("known")
    total = lambda c, when=known: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0)).cast("long")
    n = F.when(known, F.col("every").cast("double"))
    point = lambda q: F.coalesce(F.percentile(n, F.lit(q)), F.lit(0.0))
    many = known & (F.col("truths") > 1)
    out = every.agg(
        total("truths").alias("total_true_matches"), total("hits").alias("true_matches_retrieved"),
        F.count_if(known & (F.col("truths") > 0) & (F.col("hits") == 0)).alias("s1_entities_with_completely_missed_true_matches"),
        F.coalesce(F.avg(n), F.lit(0.0)).alias("candidate_count_mean"), point(0.5).alias("candidate_count_median"), point(0.9).alias("candidate_count_p90"),
        point(0.95).alias("candidate_count_p95"), point(0.99).alias("candidate_count_p99"), F.coalesce(F.max(n), F.lit(0.0)).cast("long").alias("candidate_count_max"),
        F.coalesce(F.sum("every"), F.lit(0)).cast("long").alias("total_candidate_pairs"),
        total("s2").alias("s2_true_matches"), total("s2_hits").alias("s2_retrieved"), total("s3").alias("s3_true_matches"), total("s3_hits").alias("s3_retrieved"),
        F.count_if(known & (F.col("truths") == 0)).alias("no_match_s1_entities"), F.count_if(known & (F.col("truths") == 0) & (F.col("n") > 0)).alias("no_match_s1_entities_with_candidates"),
        F.count_if(many).alias("multi_match_s1_entities"), total("truths", many).alias("multi_match_true_matches"),
        F.count_if(many & (F.col("hits") == F.col("truths"))).alias("multi_match_fully_retrieved_entities"),
    )
    return out.select(
        "*",
        (F.col("total_true_matches") - F.col("true_matches_retrieved")).alias("true_matches_missed"),
        _ratio(F.col("true_matches_retrieved"), F.col("total_true_matches"), 1.0).alias("candidate_recall"),
        *[(F.col(f"{s}_true_matches") - F.col(f"{s}_retrieved")).alias(f"{s}_missed") for s in ("s2", "s3")],
        *[_ratio(F.col(f"{s}_retrieved"), F.col(f"{s}_true_matches"), 1.0).alias(f"{s}_recall") for s in ("s2", "s3")],
    )


def binary_metrics(scored: DataFrame, threshold: float, label: str = "label", score: str = "score", beta: float = 0.5) -> DataFrame:
    """tp, fp, fn, tn, precision, recall and f05 of score >= threshold; zero where a division would be by zero."""
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("the threshold must lie in [0, 1]")
    return _confusion(scored, F.lit(float(threshold)), [], label, score, beta)


def _confusion(df: DataFrame, threshold: Column, by: list[str], label: str, score: str, beta: float) -> DataFrame:
    yes, true = F.col(score) >= threshold, F.col(label) == 1
    counts = [F.count_if(yes & true).alias("tp"), F.count_if(yes & ~true).alias("fp"), F.count_if(~yes & true).alias("fn"), F.count_if(~yes & ~true).alias("tn")]
    out = df.groupBy(*by).agg(*counts) if by else df.agg(*counts)
    return _rates(out, beta)


def _rates(out: DataFrame, beta: float = 0.5) -> DataFrame:
    out = out.withColumn("precision", _ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0.0)).withColumn("recall", _ratio(F.col("tp"), F.col("tp") + F.col("fn"), 0.0))
    return out.withColumn("f05", _f_beta(F.col("precision"), F.col("recall"), beta))


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float], label: str = "label", score: str = "score", beta: float = 0.5) -> DataFrame:
    """Confusion counts and rates for each threshold (a fixed, short list), in one pass over the scores."""
    points = F.array(*[F.lit(float(t)) for t in thresholds])
    per = scored.select(F.col(label).alias("label"), F.col(score).alias("score"), F.explode(points).alias("threshold"))
    return _confusion(per, F.col("threshold"), ["threshold"], "label", "score", beta)


def precision_recall_curve(scored: DataFrame, label: str = "label", score: str = "score", beta: float = 0.5) -> DataFrame:
    """Counts and rates with every distinct score as threshold.

    Running sums go over counts per score, summed by score range first, so no window holds more than a range.
    """
    counts = scored.groupBy(F.col(score).alias("threshold")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    counts = counts.withColumn("_range", F.floor(F.col("threshold") * 1024).cast("int"))
    above = Window.partitionBy("_range").orderBy(F.desc("threshold"))
    ranges = counts.groupBy("_range").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    order = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)  # at most 1025 rows
    whole = Window.partitionBy()
    ranges = ranges.select(
        "_range", F.coalesce(F.sum("rp").over(order), F.lit(0)).alias("bp"), F.coalesce(F.sum("rn").over(order), F.lit(0)).alias("bn"),
        F.sum("rp").over(whole).alias("all_p"), F.sum("rn").over(whole).alias("all_n"),
    )
    met = counts.withColumn("cp", F.sum("pos").over(above)).withColumn("cn", F.sum("neg").over(above)).join(F.broadcast(ranges), "_range")
    out = met.select("threshold", (F.col("bp") + F.col("cp")).alias("tp"), (F.col("bn") + F.col("cn")).alias("fp"), "all_p", "all_n")
    out = out.select("threshold", "tp", "fp", (F.col("all_p") - F.col("tp")).alias("fn"), (F.col("all_n") - F.col("fp")).alias("tn"))
    return _rates(out, beta)


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row with the greatest f05, then precision, then threshold."""
    top = curve.agg(F.max(F.struct("f05", "precision", "threshold", "recall", "tp", "fp", "fn", "tn")).alias("b"))
    return top.select("b.*")


def classify_candidate_errors(candidate_pairs: DataFrame, gt_pair: DataFrame, predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    """(pair, error_class): TP, FP, FN_WITH_CANDIDATE or BLOCKING_FAILURE; true negatives are left out.

    ``predictions``: the candidate pairs with a 0/1 column; one that is missing or anything else raises when run.
    """
    key = ["source1_entity_id", "candidate_entity_id"]
    guess = predictions.groupBy(*key).agg(F.max(prediction).alias("_p"))
    candidates = candidate_pairs.select(*key).distinct().withColumn("_c", F.lit(1)).join(guess, key, "left")
    wrong = F.isnull("_p") | ~F.col("_p").isin(0, 1)
    candidates = candidates.withColumn("_p", F.when(wrong, F.raise_error(F.lit("a candidate pair without a 0/1 prediction"))).otherwise(F.col("_p")).cast("int"))
    truth = gt_pair.select("source1_entity_id", F.col("matched_id").alias("candidate_entity_id")).distinct().withColumn("_t", F.lit(1))
    met = candidates.join(truth, key, "full")
    found, true, yes = F.isnotnull("_c"), F.isnotnull("_t"), F.col("_p") == 1
    error = F.when(~found, "BLOCKING_FAILURE").when(yes & true, "TP").when(yes, "FP").when(true, "FN_WITH_CANDIDATE")
    return met.select(*key, error.alias("error_class")).filter(F.isnotnull("error_class"))


def blocker_usage(candidate_pairs: DataFrame) -> DataFrame:
    """(blocker, pairs, percent) over fused pairs."""
    is_array = candidate_pairs.schema["blocker_sources"].dataType.typeName() == "array"
    per = candidate_pairs.select(F.explode(blocker_names(F.col("blocker_sources"), is_array)).alias("blocker")).groupBy("blocker").agg(F.count(F.lit(1)).alias("pairs"))
    total = candidate_pairs.agg(F.count(F.lit(1)).alias("total"))
    return per.join(F.broadcast(total)).select("blocker", "pairs", (F.lit(100.0) * F.col("pairs") / F.col("total")).alias("percent"))


def unfused_counts(rows: DataFrame) -> DataFrame:
    """(blocker, candidate_source, pairs) before fusion, from ``blocker_rows``."""
    name = F.coalesce(*[F.when(F.col("bit") == b, F.lit(n)) for n, b in BLOCKER_BITS.items()])
    return rows.distinct().groupBy(name.alias("blocker"), "candidate_source").agg(F.count(F.lit(1)).alias("pairs"))


def unique_contribution(candidate_pairs: DataFrame) -> DataFrame:
    """(blocker, touches, unique_only): fused pairs a blocker found, and those that no other did."""
    is_array = candidate_pairs.schema["blocker_sources"].dataType.typeName() == "array"
    mask = candidate_pairs.select(blocker_mask(blocker_names(F.col("blocker_sources"), is_array)).alias("m"))
    each = F.array(*[F.struct(F.lit(n).alias("blocker"), F.lit(b).alias("bit")) for n, b in BLOCKER_BITS.items()])
    rows = mask.select("m", F.inline(each))
    return rows.groupBy("blocker").agg(F.count_if(F.col("m").bitwiseAND(F.col("bit")) != 0).alias("touches"), F.count_if(F.col("m") == F.col("bit")).alias("unique_only"))


def singleton_safety(gt_entity: DataFrame, gt_pair: DataFrame, candidate_pairs: DataFrame) -> DataFrame:
    """Entities without truths: how many, how many still have candidates, and mean and maximum of those."""
    alone = gt_entity.select("source1_entity_id").distinct().join(gt_pair, "source1_entity_id", "left_anti")
    per = _pairs(candidate_pairs, "candidate_entity_id").groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n"))
    met = alone.join(per, "source1_entity_id", "left")
    return met.agg(
        F.count(F.lit(1)).alias("singletons"), F.count("n").alias("with_candidates"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean_candidates"),
        F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("max_candidates"),
    )


def resolve_targets(gt_pair: DataFrame, source2: DataFrame, source3: DataFrame) -> DataFrame:
    """gt_pair with target_source: S2, S3, AMBIGUOUS if both have the id, NOT_IN_SLICE if neither."""
    ids = lambda df, c: df.select(F.col("entity_id").alias("matched_id"), F.lit(True).alias(c)).distinct()
    met = gt_pair.join(ids(source2, "_2"), "matched_id", "left").join(ids(source3, "_3"), "matched_id", "left")
    in2, in3 = F.isnotnull("_2"), F.isnotnull("_3")
    source = F.when(in2 & in3, "AMBIGUOUS").when(in2, "S2").when(in3, "S3").otherwise("NOT_IN_SLICE")
    return met.select("source1_entity_id", "matched_id", source.alias("target_source"))


def union_recall(coverable: DataFrame, base: DataFrame, more: DataFrame) -> DataFrame:
    """Recall of base, of more, and of their union over coverable true pairs, in all and by target source."""
    key = ["source1_entity_id", "matched_id"]
    mark = lambda df, c: df.select("source1_entity_id", F.col("candidate_entity_id").alias("matched_id")).distinct().withColumn(c, F.lit(True))
    met = coverable.filter(F.col("target_source").isin("S2", "S3")).join(mark(base, "b"), key, "left").join(mark(more, "f"), key, "left")
    both = F.explode(F.array(F.lit("ALL"), F.col("target_source")))
    per = met.withColumn("scope", both).groupBy("scope").agg(
        F.count(F.lit(1)).alias("pairs"), F.count("b").alias("base_hits"), F.count("f").alias("more_hits"),
        F.count_if(F.isnotnull("b") | F.isnotnull("f")).alias("union_hits"), F.count_if(F.isnull("b") & F.isnotnull("f")).alias("new_hits"),
    )
    return per.select("*", *[_ratio(F.col(f"{c}_hits"), F.col("pairs"), 1.0).alias(f"{c}_recall") for c in ("base", "more", "union")])


def new_against_base(pairs: DataFrame, base: DataFrame) -> DataFrame:
    """Pairs that the base lacks."""
    return pairs.join(base, contracts.CANDIDATE_KEY[:2], "left_anti")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).summary()
