"""Decontamination against a plain restatement."""

import random

import pytest

from corvane.llm import decontamination
from tests.llm import plain


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(6)
    vocabulary = ["the", "of", "a", "É", "naïve", "x1", "42", "blue", "Green", "sea"]
    words = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    items = [(i, " ".join(words(n))) for i, n in enumerate([40, 13, 14, 12, 5, 3, 2, 30, 30])]
    items += [(20, None), (21, ""), (22, " ,.;"), (7, items[0][1]), (None, " ".join(words(20))), (23, items[1][1])]
    docs = []
    for i in range(120):
        parts = words(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            source = rng.choice([t for _, t in items if t]).split()
            a = rng.randint(0, max(0, len(source) - 5))
            parts += source[a : a + rng.randint(3, 25)] + words(rng.randint(0, 20))
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(500, None), (501, ""), (502, "!!!"), (503, "blue " * 20000 + items[0][1]), (3, docs[3][1]), (3, docs[4][1]), (None, items[0][1])]
    return docs, items


@pytest.mark.parametrize("max_literals", [100_000, 0])
def test_equals_brute_force(spark, tables, max_literals):
    docs, items = tables
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, gram string, n_words long")
    b = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, win string")
    got = [tuple(r) for r in decontamination.decontaminate(d, b, max_literals=max_literals).collect()]
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(got, key=key) == sorted(plain.contamination(docs, items), key=key)


@pytest.mark.parametrize("max_literals", [100_000, 0])
def test_joins_without_broadcast(spark, tables, monkeypatch, max_literals):
    """Beyond the byte bound windows and items are joined, with many items of one window among them."""
    monkeypatch.setattr(decontamination, "MAX_BROADCAST", -1)
    docs, items = tables
    items = items + [(1000 + i, items[1][1]) for i in range(300)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in decontamination.decontaminate(d, b, max_literals=max_literals).collect()]
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(got, key=key) == sorted(plain.contamination(docs, items), key=key)


@pytest.mark.parametrize("which", ["docs", "items", "both", "words"])
def test_empty_tables(spark, which):
    none = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    docs = none if which in ("docs", "both") else spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = no_items if which in ("items", "both") else spark.createDataFrame([(1, None if which == "words" else "a b")], "item_id long, text string")
    out = decontamination.decontaminate(docs, items).collect()
    assert len(out) == (0 if which in ("docs", "both") else 1)
    assert all(r["n_hit"] == 0 for r in out)
