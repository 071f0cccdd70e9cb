"""Suffix-array dedup against a plain restatement of its rule, and the interval tree against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from corvane.llm import suffix_dedup as sd


def plain_removed(rows, length):
    """Covered bytes per row: in a string that also starts in a row with a smaller id (null the largest)."""
    key = lambda i: sd.LAST_ID if i is None else i
    first = {}
    for i, t in rows:
        t = (t or "").encode()
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            first[s] = min(first.get(s, key(i)), key(i))
    out = []
    for i, t in rows:
        t = (t or "").encode()
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < key(i):
                gone[p : p + length] = True
        out.append(gone)
    return out


def make_rows(seed, n=150):
    rng = random.Random(seed)
    syllables = ["an", "er", "th ", "the ", "é", "ß ", "ing ", "\n", "a", "ation "]
    text = lambda k: "".join(rng.choice(syllables) for _ in range(k))
    shared = [text(rng.randint(15, 60)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            parts += [text(rng.randint(0, 30)), s[a : a + rng.randint(20, 90)] if rng.random() < 0.6 else s]
        rows.append((rng.randint(0, 400) if i % 9 else None, "".join(parts)))
    rows += [(500, None), (501, ""), (502, "x" * 400), (503, "x" * 300), (504, "ab" * 150), (505, rows[3][1]), (506, rows[3][1]), (506, rows[3][1])]
    return rows


@pytest.mark.parametrize(
    ("length", "hot", "block_bytes", "seed", "fan"),
    [(50, 20_000, None, 1, 12), (50, 3, 900, 2, 12), (20, 20_000, 900, 3, 2), (20, 2, 3000, 4, 1), (5, 20_000, 3000, 5, 12)],
)
def test_removed_bytes_equal_the_rule(spark, length, hot, block_bytes, seed, fan):
    rows = make_rows(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    out = sd.suffix_dedup(docs, length=length, hot=hot, block_bytes=block_bytes, fan=fan).collect()
    got, want = defaultdict(list), defaultdict(list)
    for r in out:
        got[r["doc_id"]].append((r["n_bytes"], tuple((s["start"], s["length"]) for s in r["spans"]), bytes(r["kept"] or b"")))
    for (i, t), gone in zip(rows, plain_removed(rows, length), strict=True):
        t = (t or "").encode()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        spans = tuple((int(a), int(b - a)) for a, b in edges.reshape(-1, 2))
        want[i].append((len(t), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    assert got.keys() == want.keys()
    for i in want:
        assert sorted(got[i]) == sorted(want[i]), i


@pytest.mark.parametrize("seed", range(6))
def test_maximal_repeats_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = list({bytes(rng.choice([0, 97, 98]) for _ in range(rng.randint(3, 40))) for _ in range(25)})
    length = 4
    got = {}
    for size, own, off in sd.maximal_repeats(texts, length):
        places = sorted(zip(own.tolist(), off.tolist(), strict=True))
        s = texts[places[0][0]][places[0][1] : places[0][1] + size]
        got[s] = places
    want = {}
    for t in texts:
        for a in range(len(t)):
            for b in range(a + length, len(t) + 1):
                want.setdefault(t[a:b], None)
    for s in list(want):
        places = [(i, p) for i, t in enumerate(texts) for p in range(len(t) - len(s) + 1) if t[p : p + len(s)] == s]
        before = {texts[i][p - 1] if p else (i, "start") for i, p in places}
        after = {texts[i][p + len(s)] if p + len(s) < len(texts[i]) else (i, "end") for i, p in places}
        want[s] = places if len(places) > 1 and len(before) > 1 and len(after) > 1 else None
    want = {s: p for s, p in want.items() if p}
    assert {s: p for s, p in got.items() if s in want} == want
    for s, places in got.items():  # beyond that, only repeats of which some occurrence stands at a text's start
        assert s in want or any(p == 0 for _, p in places)


def test_suffix_array_orders_suffixes():
    rng = random.Random(8)
    texts = [bytes(rng.choice([0, 1, 255]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    data = b"".join(texts)
    pos, left, at = [], [], 0
    for t in texts:
        pos += range(at, at + len(t))
        left += range(len(t), 0, -1)
        at += len(t)
    order, lcp = sd.suffix_array(data, np.array(pos), np.array(left))
    suffixes = [data[pos[i] : pos[i] + left[i]] for i in order.tolist()]
    assert suffixes == sorted(suffixes)
    for a, b, n in zip(suffixes, suffixes[1:], lcp[1:].tolist(), strict=False):
        assert n == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_segments_hold_every_string_once():
    rng = np.random.default_rng(1)
    buf = rng.integers(97, 100, 200_000).astype(np.uint8)
    sizes = np.array([0, 49, 50, 150_000, 0, 49_901], np.int64)
    starts = np.cumsum(sizes) - sizes
    _, first, last = sd.anchor_segments(buf, starts, sizes)
    held = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
    want = np.concatenate([np.arange(s, s + n - 49) for s, n in zip(starts, sizes, strict=True) if n >= 50])
    assert (np.sort(held) == want).all() and (last - first < 36).all()


@pytest.mark.parametrize("limit", [1, 300, 5000])
def test_slices_of_a_bucket_give_what_one_array_gives(limit):
    rng = random.Random(limit)
    parts = [bytes(rng.choice(b"ab") for _ in range(30)) for _ in range(12)]
    data = b"".join(rng.choice(parts) for _ in range(400))
    buf, size = np.frombuffer(data, np.uint8), np.full(20, len(data) // 20)
    hashes, first, last = sd.anchor_segments(buf, np.cumsum(size) - size, size, 20, 8)
    least = {}
    for h, a, b in zip(hashes.tolist(), first.tolist(), last.tolist(), strict=True):
        text = data[a : b + 20]
        least[h, text] = min(least.get((h, text), 99), a // int(size[0]))
    keys = sorted(least)
    entries = sd.Entries(np.array([h for h, _ in keys], np.uint64), np.array([least[k] for k in keys]), [t for _, t in keys])
    cuts = list(sd.slices(entries.keys, np.array([len(t) for _, t in keys]), limit))
    assert [i for s in cuts for i in range(s.start, s.stop)] == list(range(len(keys))) and len(cuts) > 1
    assert all(entries.keys[s.start] != entries.keys[s.start - 1] for s in cuts[1:])
    got, want = sd._repeats(20, limit)(entries), sd._repeats(20, 1 << 40)(entries)
    assert (got.number == want.number).all() and all((a == b).all() for a, b in zip(got.columns, want.columns, strict=True))
    assert sd._repeats(20)(sd.Entries(entries.keys[:0], entries.info[:0], [])).number.tolist() == []


def test_empty_table(spark):
    assert sd.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
