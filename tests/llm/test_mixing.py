"""Mixing: targets against an iterated restatement, fits against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    open_, budget = set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if budget * weight[s] / total > repeats * sizes[s]]
        if not over:
            return target | {s: budget * weight[s] / total for s in open_}
        for s in over:
            target[s] = repeats * sizes[s]
        budget -= sum(target[s] for s in over)
        open_ -= set(over)
    return target


def test_knapsack_is_the_best_sum():
    rng = random.Random(1)
    for _ in range(200):
        lengths = np.array(sorted(rng.sample(range(1, 30), 4)))
        counts = np.array([rng.randint(0, 4) for _ in lengths])
        budget = rng.randint(0, 120)
        take = mixing.knapsack(lengths, counts, budget)
        assert (take <= counts).all() and (take >= 0).all()
        best = max(s for c in itertools.product(*[range(n + 1) for n in counts]) if (s := int((np.array(c) * lengths).sum())) <= budget)
        assert int((take * lengths).sum()) == best


def test_fit_budget_is_exact_when_lengths_allow():
    rng = np.random.default_rng(2)
    lengths = np.unique(rng.integers(1, 4000, 500))
    counts = rng.integers(1, 50, len(lengths))
    total = int((lengths * counts).sum())
    for share in (0.0, 0.01, 0.37, 0.5, 0.999, 1.0):
        take = mixing.fit_budget(lengths, counts, int(total * share))
        assert (take <= counts).all() and int((take * lengths).sum()) == int(total * share)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, " ".join(["w"] * min(900, int(rng.expovariate(0.01)))), rng.choice(["a", "é", "B", "b1", None, "z"] + ["hot"] * 3)) for i in range(1500)]
    return out + [(2000, None, "a"), (2001, "", "empty"), (2002, " \t\n", "empty"), (2003, "one\x1ctoken  ", "b1"), (2003, "one", "b1"), (2004, "w " * 4000, "z")]


def test_mix_is_near_its_targets_and_repeatable(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, size string")
    got = mixing.mix_sources(docs).collect()
    size = {None: 0}
    source_of = {}
    for i, text, source in rows:
        n = len((text or "").encode().split())
        size[source] = size.get(source, 0) + n
        source_of.setdefault(i, source)
    targets = plain_targets(size)
    taken = dict.fromkeys(size, 0)
    assert len(got) == len(rows)
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(targets[s], rel=1e-12)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(1, 0.002 * t), s
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["size"], r["taken"]) for r in got) == sorted((r["doc_id"], r["size"], r["taken"]) for r in again)


def test_sizes_by_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r["doc_id"], r["size"]) for r in mixing.mix_sources(docs).collect())
    assert got == sorted((i, len((t or "").encode().split())) for i, t, _ in rows)


def test_empty_table_and_one_source(spark):
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    one = mixing.mix_sources(spark.createDataFrame([(1, "a b", None), (2, None, None), (3, "c", None)], "doc_id long, text string, source string")).collect()
    assert {r["target"] for r in one} == {4.5} and sum(r["taken"] for r in one) in (4, 5)


@pytest.mark.parametrize("ranges", [1, 4, 256])
def test_choice_follows_ranges_and_ranks(spark, rows, monkeypatch, ranges):
    """Of each source and length the first rows by hash range and rank are taken once more, with a hot text without id among them."""
    monkeypatch.setattr(mixing, "RANGES", ranges)
    hot = [(None, "hot words here", "hot")] * 900 + [(None, "", "hot")] * 500 + [(7000 + i, "hot words too", "hot") for i in range(60)]
    docs = spark.createDataFrame([*rows, *hot], "doc_id long, text string, source string").repartition(6)
    rank = docs.withColumn("rank", F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit(mixing.SEED)))
    groups = {}
    for r in rank.collect():
        n = len((r["text"] or "").encode().split())
        groups.setdefault((r["source"], n), []).append((r["rank"] % ranges, r["rank"], -1 if r["doc_id"] is None else r["doc_id"]))
    source_size, found = {}, {}
    for (s, n), g in groups.items():
        source_size[s] = source_size.get(s, 0) + n * len(g)
    got = [tuple(r) for r in mixing.mix_sources(docs).collect()]
    assert len(got) == sum(map(len, groups.values()))
    targets = plain_targets(source_size)
    source_of = {(source_size[s], pytest.approx(targets[s]).expected): s for s in source_size}
    assert len(source_of) == len(source_size)
    for i, n, whole, target, taken in got:
        s = next(s for (size, t), s in source_of.items() if size == whole and abs(t - target) < 1e-6 * max(1, t))
        found.setdefault((s, n), []).append((-1 if i is None else i, taken))
    assert found.keys() == groups.keys()
    for (s, n), g in groups.items():
        low = int(targets[s] // source_size[s]) if source_size[s] else 0
        more = sum(t for _, t in found[s, n]) // n - low * len(g) if n else 0
        expected = [(i, n * (low + (k < more))) for k, (_, _, i) in enumerate(sorted(g))]
        assert sorted(found[s, n]) == sorted(expected)


def test_rows_alike_are_ranked_by_parts(spark):
    """A range of rows alike is ranked within the partitions they were read in, never all in one window."""
    met = spark.range(0, 4000, 1, 8).select(
        F.lit("s").alias("src"), F.lit(3).alias("size"), F.lit(0).alias("range"), F.lit(5).alias("rank"), F.lit(1).alias("tie"), F.spark_partition_id().alias("part"), F.lit(1234).alias("more")
    )
    out = mixing._first_of_ranges(met)
    assert out.filter("once_more").count() == 1234 and out.count() == 4000
    assert {r["n"] for r in out.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()} == {500}
