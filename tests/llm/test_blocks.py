"""The exchange between blocks and buckets: its answers, and rows in proportion to the input."""

import random

import numpy as np
import pyarrow as pa
import pytest

from corvane.llm import blocks, lm_scoring, suffix_dedup


def texts(n, seed=3):
    rng = random.Random(seed)
    return [(i, " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(40))) for i in range(n)]


@pytest.mark.parametrize("levels", [(3,), (2, 2), (1, 1, 2)])
def test_cells_of_all_levels_hold_every_key(levels):
    rng = np.random.default_rng(1)
    entries = blocks.Entries(np.sort(rng.integers(0, 1 << 64, 500, dtype=np.uint64)), np.arange(500))
    tables = [entries.rows(0, 0, levels[0], 7, False)]
    done = levels[0]
    for bits in levels[1:]:
        cells = [tables[-1].slice(i, 1) for i in range(tables[-1].num_rows)]
        merged = [(c.column("bucket")[0].as_py(), blocks.merge(c, lm_scoring._sum)[0]) for c in cells]
        tables.append(pa.concat_tables([m.rows(b, done, bits, 0, False) for b, m in merged]))
        done += bits
    last = tables[-1].sort_by("bucket")
    keys = np.concatenate([blocks.unpack_sorted(k) for k in last.column("keys").to_pylist()])
    assert (keys == entries.keys).all() and (last.column("bucket").to_numpy() == np.unique(entries.keys >> np.uint64(64 - done))).all()


@pytest.mark.parametrize("kind", ["words", "anchors"])
def test_rows_grow_with_the_input(spark, kind):
    """1, 4 and 16 times the documents in blocks of 800 bytes, four cells a block and level."""
    depth = []
    for times in (1, 4, 16):
        docs = spark.createDataFrame([(i, t, False) for i, t in texts(25 * times)], "doc_id long, text string, held boolean")
        dealt = blocks.deal(docs, ["doc_id"], "text", 800, fan=2, held_out=docs["held"])
        first = dealt.levels[0]
        ask, combine, every = (lm_scoring._ask(first), lm_scoring._sum, True) if kind == "words" else (suffix_dedup._ask(first, 50), suffix_dedup._gather, False)
        up = blocks.climb(dealt.docs.groupBy("_block").applyInArrow(ask, blocks.CELLS), dealt, combine, every)
        counts = [df.count() for df in up]
        assert all(c <= 4 * dealt.blocks * 1.1 + 8 for c in counts), (counts, dealt.blocks)  # the last group may not be full
        depth.append(len(dealt.levels))
    assert depth == sorted(set(depth))  # a level more for four times the input
    assert sum(counts) < dealt.blocks * 2 ** sum(dealt.levels) / 5  # what blocks times buckets would make
