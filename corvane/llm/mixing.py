"""Mixing sources to target weights by subset-sum budget fitting.

Sources, in code point order with null last, get the weights in turn and share ``share`` times all words.
No target exceeds ``max_repeats`` times its source's words; what is over goes to the others by weight until no
target is above (one water level, found from running sums over the sources).

A target is then fitted exactly where the lengths allow it: every document is taken floor(target / words)
times, and for the rest a bounded knapsack chooses how many documents of each exact length to take once
more. Lengths first get their even share, then longest first while they fit; the last words are fitted by
dynamic programming over sums up to ``FIT``, with each length's remaining count as its bound. Which documents
of a length are taken is decided by a seeded hash of id and text.

Only counts by (source, length) are gathered, one task per source; documents never are. Ranks within a length
come from hash ranges counted first, so a length that holds a large share of all rows spreads over many tasks; only
the one range of a length that is taken in part is ranked at all. Rows that repeat id and text are told apart by the
partition they were read in, so no task ranks them all.

Defined results: a null text has size 0 and takes 0. Null is a source of its own. Rows that repeat an id are
ranked side by side and are equal in everything that is returned. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 20
FIT = 8192
RANGES = 256


def text_size(text: Column) -> Column:
    """Number of words: runs of anything but ASCII white space."""
    spaced = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(spaced == "", F.lit(0)).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1).cast("long")


NO_SOURCE = "n"


def source_key(source: Column) -> Column:
    """A source as a non-null key; null's is ``NO_SOURCE``, others start with s."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(NO_SOURCE))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_repeats: int) -> DataFrame:
    """(src, source_size, target) from (src, size); the windows' rows are sources, not documents."""
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    order = [F.col("src") == NO_SOURCE, F.col("src")]
    turn = (F.row_number().over(Window.orderBy(*order)) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    per = per.withColumn("most", F.col("source_size").cast("double") * max_repeats)
    everything = Window.partitionBy()
    full = Window.orderBy(F.col("most") / F.col("weight"), *order).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("budget", F.sum("source_size").over(everything).cast("double") * share - F.coalesce(F.sum("most").over(full), F.lit(0.0)))
    per = per.withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0.0)))
    # sources fill up in order of most / weight; the first that does not fill up fixes the level for all after it
    fits = F.col("budget") * F.col("weight") <= F.col("most") * F.col("open")
    per = per.withColumn("level", F.when(fits, F.struct(F.col("most") / F.col("weight"), F.col("budget").alias("budget"), F.col("open").alias("open"))))
    per = per.withColumn("level", F.min("level").over(everything))
    shared = F.col("level.budget") * F.col("weight") / F.col("level.open")
    return per.select("src", "source_size", F.least(F.col("most"), F.coalesce(shared, F.col("most"))).alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, fit: int = FIT) -> np.ndarray:
    """How many documents of each length (distinct, positive) to take, at most ``counts``, to sum to about ``budget``.

    The sum never exceeds the budget and is the largest that the last step can reach.
    """
    total = int((lengths * counts).sum())
    budget = max(0, min(int(budget), total))
    take = np.zeros(len(lengths), np.int64)
    if not total or not budget:
        return take
    if budget == total:
        return counts.astype(np.int64)
    hold = min(fit // 2, budget)  # left for the exact step
    take = (counts * ((budget - hold) / total)).astype(np.int64)
    left = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths):
        if left <= fit:
            break
        more = min(int(counts[i] - take[i]), (left - hold) // int(lengths[i]))
        if more > 0:
            take[i] += more
            left -= more * int(lengths[i])
    return take + knapsack(lengths, counts - take, left)


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """The counts, within their bounds, whose sum is the largest that does not exceed ``budget``."""
    pieces = []  # (length index, number of documents): bounds in binary parts
    for i in np.argsort(lengths):
        left, step = min(int(counts[i]), budget // int(lengths[i])), 1
        while left > 0:
            pieces.append((i, min(step, left)))
            left -= step
            step *= 2
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    by = np.full(budget + 1, -1, np.int64)
    for p, (i, number) in enumerate(pieces):
        w = int(lengths[i]) * number
        if w > budget:
            continue
        fresh = np.zeros(budget + 1, bool)
        fresh[w:] = reached[: budget + 1 - w]
        fresh &= ~reached
        by[fresh] = p
        reached |= fresh
        if reached[budget]:
            break
    take, at = np.zeros(len(lengths), np.int64), int(np.flatnonzero(reached)[-1])
    while at:
        i, number = pieces[by[at]]
        take[i] += number
        at -= int(lengths[i]) * number
    return take


PLAN = "src string, size long, base long, extra long, source_size long, target double"


def plan_lengths(histogram: DataFrame) -> DataFrame:
    """PLAN's columns: repeats of every document, and how many of the length are taken once more."""

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        whole, target = float(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        base = int(target // whole) if whole else 0
        lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        some = lengths > 0
        extra = np.zeros(len(pdf), np.int64)
        extra[some] = fit_budget(lengths[some], counts[some], int(round(target - base * whole)))
        return pdf[["src", "size", "source_size", "target"]].assign(base=np.int64(base), extra=extra)

    return histogram.groupBy("src").applyInPandas(plan, PLAN)


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(key, size, source_size, target, taken) per row; taken is size times the number of times it is taken. Eager."""
    ident = F.col(key).cast("string")
    rows = docs.select(
        F.col(key).alias("id"), source_key(F.col(source_col)).alias("src"), text_size(F.col(text_col)).alias("size"),
        F.xxhash64(ident, F.col(text_col), F.lit(seed)).alias("rank"), F.xxhash64(F.isnull(ident), ident).alias("tie"), F.spark_partition_id().alias("part"),
    )
    rows = cut(rows.withColumn("range", F.pmod("rank", F.lit(RANGES)).cast("int")))
    by_range = cut(rows.groupBy("src", "size", "range").agg(F.count(F.lit(1)).alias("n")))
    by_length = by_range.groupBy("src", "size").agg(F.sum("n").alias("n"))
    targets = cut(source_targets(by_length.select("src", (F.col("size") * F.col("n")).alias("size")), weights, share, max_repeats))
    plan = cut(plan_lengths(by_length.join(targets, "src")))
    # where the first ``extra`` of a length end: lower hash ranges are taken whole, one range in part
    before = F.sum("n").over(Window.partitionBy("src", "size").orderBy("range")) - F.col("n")
    more = F.greatest(F.least(F.col("extra") - before, F.col("n")), F.lit(0))
    ranges = by_range.join(plan, ["src", "size"]).select("src", "size", "range", "n", "base", more.alias("more"), "source_size", "target")
    met = cut(rows.join(ranges, ["src", "size", "range"]))
    in_part = (F.col("more") > 0) & (F.col("more") < F.col("n"))
    whole = met.filter(~in_part).withColumn("once_more", F.col("more") > 0)
    chosen = whole.unionByName(_first_of_ranges(met.filter(in_part)))
    times = F.col("base") + F.col("once_more").cast("long")
    return chosen.select(F.col("id").alias(key), "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))


def _first_of_ranges(met: DataFrame) -> DataFrame:
    """Adds once_more: whether a row is among the first ``more`` of its range, by rank and tie.

    Rows of one rank and tie are equal in all that is returned, so any of them may come first: they are counted by the
    partition they were read in, and no task ranks more of them than one partition held.
    """
    alike = ["src", "size", "range", "rank", "tie", "part"]
    ends = F.sum("alike").over(Window.partitionBy("src", "size", "range").orderBy("rank", "tie", "part"))
    groups = met.groupBy(*alike).agg(F.count(F.lit(1)).alias("alike")).withColumn("before", ends - F.col("alike")).drop("alike")
    place = F.row_number().over(Window.partitionBy(*alike).orderBy("rank"))
    return met.withColumn("place", place).join(groups, alike).withColumn("once_more", F.col("before") + F.col("place") <= F.col("more")).drop("before", "place")
