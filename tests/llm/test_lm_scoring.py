"""Language-model scores against a plain restatement of the formulas, and held-out gain."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corvane.llm import blocks, lm_scoring


def tokens_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w] + [None]


def plain_scores(rows, mu=lm_scoring.MU, kept=lm_scoring.KEPT):
    """Each text is walked through an automaton of states (), (v,) and (u, v), arc by arc and failure by failure."""
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in rows}
    grams, texts = Counter(), 0
    for i, text in rows:
        if not held[i]:
            seq = [0, *tokens_of(text)]
            texts += 1
            for k in (1, 2, 3):
                grams.update(tuple(seq[j : j + k]) for j in range(1 if k == 1 else 0, len(seq) - k + 1))
    words = {g[0]: c for g, c in grams.items() if len(g) == 1}
    n, v = sum(words.values()), len(words)
    total_of = lambda state: texts if state == (0,) else grams[state]

    def p(state, w):
        if not state:
            return (words.get(w, 0) + 1) / (n + v + 1)
        m = mu[len(state) - 1]
        return (grams[*state, w] + m * p(state[1:], w)) / (total_of(state) + m)

    def step(state, w):
        if not state:
            return math.log10(p((), w))
        if grams[*state, w]:
            return math.log10(p(state, w))
        m = mu[len(state) - 1]
        return math.log10(m / (total_of(state) + m)) + step(state[1:], w)

    out = []
    for i, text in rows:
        seq = tokens_of(text)
        total, before = 0.0, [0]
        for w in seq:
            state = tuple(before[-2:])
            if len(state) == 2 and grams[state] < kept:
                state = state[1:]
            total += step(state, w)
            before.append(w)
        base = sum(math.log10(p((), w)) for w in seq)
        out.append((i, held[i], len(seq), sum(w in words for w in seq), n, base, total))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "THE", "the", "a\x1cb"]
    out = [(i, " ".join(rng.choice(vocabulary[: rng.choice([5, 65])]) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    return out + [(400, None), (401, ""), (402, " \n\t"), (403, "hot " * 20000), (3, "w1 w2"), (3, "w1 w2"), (404, "end \n start")]


@pytest.mark.parametrize(("block_bytes", "fan"), [(None, 12), (700, 12), (700, 2)])
def test_scores_equal_the_formulas(spark, rows, block_bytes, fan):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    got = [tuple(r) for r in lm_scoring.lm_scores(docs, block_bytes=block_bytes, fan=fan).collect()]
    want = plain_scores(rows)
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_probabilities_sum_to_one():
    """Over each state: its arcs, and through its failure arc those of the states below it."""
    texts = [b"a b a b c", b"b b d", b"a b d"]
    docs = pa.table({"_text": pa.array(texts, pa.binary()), "held_out": [False] * len(texts)})
    own = lm_scoring.BlockTokens(docs)
    merged = own.entries
    own.hear(pa.table({"bucket": [0], "v0": [blocks._pack_any(merged.info)], "number": pa.nulls(1, pa.binary()), "v1": pa.nulls(1, pa.binary()), "v2": pa.nulls(1, pa.binary()),
                       "extra": [blocks._pack_any(np.array(lm_scoring._total(merged).extra))]}))
    own.triple_counts = np.zeros(0)
    triples = own.triples(1)
    own.triple_counts = triples.info[np.argsort(own.triple_order)]
    assert (own.known, own.tokens, int(own.word_counts[lm_scoring.START]), int(own.triple_counts.sum())) == (5, 14, 3, 11)
    model, size = lm_scoring.BackoffAutomaton(own, lm_scoring.MU), own.vocabulary
    tokens = list(range(1, size))
    unknown = math.log10(1 / (own.tokens + own.known + 1))
    low = {}
    for v in [x for x in range(size) if x != lm_scoring.END]:
        pairs = {int(own.right[k]): k for k in np.flatnonzero(own.left == v)}
        fail = model.failure2[next(iter(pairs.values()))]
        low[v] = [model.arc2[pairs[w]] if w in pairs else fail + model.root[w] for w in tokens] + [fail + unknown]
        assert sum(10**x for x in low[v]) == pytest.approx(1.0)
    for state in set(own.state.tolist()):
        arcs = {int(own.right[own.last[t]]): t for t in np.flatnonzero(own.state == state)}
        fail, v = model.failure3[next(iter(arcs.values()))], int(own.right[state])
        total = [model.arc3[arcs[w]] if w in arcs else fail + x for w, x in zip([*tokens, None], low[v], strict=True)]
        assert sum(10**x for x in total) == pytest.approx(1.0)


def test_longer_contexts_help_on_held_out_text(spark):
    rng = random.Random(2)
    follow = {w: rng.sample(range(200), 3) for w in range(200)}
    rows = []
    for i in range(600):
        w, words = rng.randrange(200), []
        for _ in range(30):
            words.append(f"v{w}")
            w = rng.choice(follow[w])
        rows.append((i, " ".join(words)))
    out = lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").toPandas()
    assert len(out) > 30 and out["score"].sum() > out["base_score"].sum() * 0.6


def test_empty_table_and_null_id(spark):
    assert lm_scoring.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = lm_scoring.lm_scores(spark.createDataFrame([(None, "a")], "doc_id long, text string")).first()
    assert not one["held_out"] and one["n_known"] == 2
