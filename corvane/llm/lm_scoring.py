"""Language-model scoring with a weighted backoff automaton of order 3.

Tokens are a text's words (A-Z lower-cased, runs without ASCII white space) and one end. With c the counts in the
training texts, N all training tokens and V the distinct ones:

    p(w)    = (c(w) + 1) / (N + V + 1)
    p(w|v)  = (c(v w) + MU[0] p(w)) / (c(v) + MU[0])
    p(w|uv) = (c(u v w) + MU[1] p(w|v)) / (c(u v) + MU[1])     if c(u v) >= KEPT, else p(w|v)

Each sums to one over the V known tokens and one unknown. As an automaton: each known word is a state (and so is
the start of a text), and so is each pair of words that occurs ``KEPT`` times or more. An arc for each seen pair or
triple carries log10 of its probability. A pair's state has a failure arc of weight log10 MU[1] / (c(u v) + MU[1]) to
the state of its last word; a word's state has one of weight log10 MU[0] / (c(v) + MU[0]) to the root, whose arcs carry
log10 p(w). From left to right, the state before a token is the longest state that ends there; where it has no arc for
the token, failure arcs are followed, one after another, until a state has one; the weights met on the way add up.

Counts are exchanged between blocks of documents and buckets of hashed keys (see ``blocks``), words and pairs first,
then the triples whose pair is a state; so a block builds just the part of the automaton that its own texts can
reach, from counts over all training texts. Words are told apart by 63 bits of hash, pairs and triples by 52 (with 10**13
of them in a corpus, one in 450 shares its count with another).

Defined results: a null or blank text is its end token alone. A null id is not held out. Repeated rows each count
and are each scored. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.blocks import CELLS, FAN, Answers, Entries, deal, exchange, in_order, pair_hash

MU = 8.0, 4.0
KEPT = 2
START, END = 0, 1  # token numbers; words have higher ones
PAIR = np.uint64((1 << 64) - (1 << 12))  # a pair's or triple's key: 52 bits, and 12 zeros that cost nothing to send


class BlockTokens:
    """A block's tokens as numbers, text after text, and its distinct words and pairs."""

    def __init__(self, docs: pa.Table):
        texts = docs.column("_text").combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null(b"").view(pa.string())))
        flat, text = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy()
        word = pc.binary_length(flat).to_numpy() > 0  # white space at either end gives an empty one
        text = text[word]
        coded = flat.filter(pa.array(word)).dictionary_encode()
        self.sizes = np.bincount(text, minlength=len(texts)) + 1
        self.first = np.cumsum(self.sizes) - self.sizes
        self.ids = np.full(int(self.sizes.sum()), END, np.int64)
        self.ids[np.arange(len(text)) + text] = coded.indices.to_numpy() + 2
        words = [b"\t", b"\n", *coded.dictionary.view(pa.binary()).to_pylist()]  # the start and the end are never words
        self.vocabulary = len(words)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self.learn = np.repeat(~np.array(docs.column("held_out").to_pylist(), bool), self.sizes)
        before = np.empty_like(self.ids)
        before[1:] = self.ids[:-1]
        before[self.first] = START
        codes, self.pair = np.unique(before * self.vocabulary + self.ids, return_inverse=True)
        self.left, self.right = codes // self.vocabulary, codes % self.vocabulary
        self.pair_keys = pair_hash(self.hashes[self.left], self.hashes[self.right]) & PAIR
        keys = np.concatenate([self.hashes | np.uint64(1), self.pair_keys])
        self.order = np.argsort(keys)
        counts = np.concatenate([np.bincount(self.ids[self.learn], minlength=self.vocabulary), np.bincount(self.pair[self.learn], minlength=len(codes))])
        self.entries = Entries(keys[self.order], counts[self.order].astype(np.int64))

    def hear(self, told: pa.Table) -> None:
        """Take the counts over all training texts from the buckets' answers."""
        answers = Answers.read(told)
        counts = np.zeros(len(self.order), np.int64)
        if answers.columns:
            counts[self.order] = answers.columns[0]
            self.known, self.tokens = answers.extra
        else:
            self.known = self.tokens = 0
        self.word_counts, self.pair_counts = counts[: self.vocabulary], counts[self.vocabulary :]
        self.word_counts[START] = self.word_counts[END]  # the start stands before each training text

    def triples(self, kept: int) -> Entries:
        """The distinct triples whose pair is a state; ``triple`` has each token's number among them, -1 for none."""
        context = np.empty_like(self.pair)
        context[1:] = self.pair[:-1]
        context[self.first] = -1
        context[(context >= 0) & (self.pair_counts[context] < kept)] = -1
        at = np.flatnonzero(context >= 0)
        codes, number = np.unique(context[at] * len(self.pair_keys) + self.pair[at], return_inverse=True)
        self.triple = np.full(len(self.ids), -1)
        self.triple[at] = number
        self.state, self.last = codes // len(self.pair_keys), codes % len(self.pair_keys)  # pairs u v and v w
        keys = pair_hash(self.pair_keys[self.state], self.hashes[self.right[self.last]]) & PAIR
        self.triple_order = np.argsort(keys)
        counts = np.bincount(number[self.learn[at]], minlength=len(codes)).astype(np.int64)
        return Entries(keys[self.triple_order], counts[self.triple_order])

    def hear_triples(self, told: pa.Table) -> None:
        answers = Answers.read(told)
        self.triple_counts = np.zeros(len(self.triple_order), np.int64)
        if answers.columns:
            self.triple_counts[self.triple_order] = answers.columns[0]


class BackoffAutomaton:
    """The arcs and failure arcs that a block's texts can reach."""

    def __init__(self, own: BlockTokens, mu: Sequence[float]):
        p1 = (own.word_counts + 1) / (own.tokens + own.known + 1)
        p2 = (own.pair_counts + mu[0] * p1[own.right]) / (own.word_counts[own.left] + mu[0])
        p3 = (own.triple_counts + mu[1] * p2[own.last]) / (own.pair_counts[own.state] + mu[1])
        self.root, self.arc2, self.arc3 = np.log10(p1), np.log10(p2), np.log10(p3)
        self.has2, self.has3 = own.pair_counts > 0, own.triple_counts > 0
        self.failure2 = np.log10(mu[0] / (own.word_counts + mu[0]))[own.left]
        self.failure3 = np.log10(mu[1] / (own.pair_counts + mu[1]))[own.state]

    def walk(self, ids: np.ndarray, pair: np.ndarray, triple: np.ndarray) -> np.ndarray:
        """The weight of each token's transition: its state's arc, or failure arcs down to the first state that has one."""
        weight = np.zeros(len(ids))
        deep = np.flatnonzero(triple >= 0)  # tokens met in a pair's state
        found = self.has3[triple[deep]]
        weight[deep] = np.where(found, self.arc3[triple[deep]], self.failure3[triple[deep]])
        rest = np.ones(len(ids), bool)
        rest[deep[found]] = False
        at = np.flatnonzero(rest)  # tokens met in a word's state, or failed down to it
        found = self.has2[pair[at]]
        weight[at] += np.where(found, self.arc2[pair[at]], self.failure2[pair[at]])
        at = at[~found]
        weight[at] += self.root[ids[at]]
        return weight


def _sum(at: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, at, counts)
    return out


def _total(entries: Entries) -> Answers:
    """Counts as they are; and how many words occur, and how often in all (word keys are odd)."""
    word = (entries.keys & np.uint64(1)).astype(bool)
    counts = entries.info[word]
    return Answers([entries.info], None, (int((counts > 0).sum()), int(counts.sum())))


def _ask(bits: int):
    def run(table: pa.Table) -> pa.Table:
        block = table.column("_block")[0].as_py()
        return BlockTokens(in_order(table)).entries.rows(0, 0, bits, block, every=True)  # every block learns all buckets' sums

    return run


def _ask_triples(bits: int, kept: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return Entries(np.zeros(0, np.uint64), np.zeros(0, np.int64)).rows(0, 0, bits, 0, every=False)
        own = BlockTokens(in_order(docs))
        own.hear(told)
        return own.triples(kept).rows(0, 0, bits, docs.column("_block")[0].as_py(), every=False)

    return run


def _score(keys: int, mu: Sequence[float], kept: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        docs = in_order(docs)
        own = BlockTokens(docs)
        triple = told.column("triple").combine_chunks()
        own.hear(told.filter(pc.invert(triple)))
        own.triples(kept)
        own.hear_triples(told.filter(triple))
        weight = BackoffAutomaton(own, mu).walk(own.ids, own.pair, own.triple)
        base = np.log10((own.word_counts + 1) / (own.tokens + own.known + 1))[own.ids].tolist()
        weight = weight.tolist()
        seen = np.add.reduceat((own.word_counts > 0)[own.ids].astype(np.int64), own.first) if len(own.first) else own.first
        spans = [(a, a + n) for a, n in zip(own.first.tolist(), own.sizes.tolist(), strict=True)]
        return pa.table(
            {f"_k{i}": docs.column(f"_k{i}") for i in range(keys)}
            | {
                "held_out": docs.column("held_out"),
                "n_tokens": pa.array(own.sizes, pa.int64()),
                "n_known": pa.array(seen, pa.int64()),
                "train_tokens": pa.array([own.tokens] * len(spans), pa.int64()),
                "base_score": pa.array([math.fsum(base[a:b]) for a, b in spans], pa.float64()),
                "score": pa.array([math.fsum(weight[a:b]) for a, b in spans], pa.float64()),
            }
        )

    return run


def held_out_by_id(key: Column) -> Column:
    """One seventh of the texts by the CRC-32 of their id as text."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def lm_scores(
    docs: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    held_out: Column | None = None,
    mu: Sequence[float] = MU,
    kept: int = KEPT,
    block_bytes: int | None = None,
    fan: int = FAN,
) -> DataFrame:
    """``keys``, held_out, n_tokens, n_known, train_tokens, base_score and score per row.

    ``held_out``: a boolean column of ``docs`` for texts to score but not to learn from.
    """
    flag = held_out if held_out is not None else held_out_by_id(F.col(keys[0]))
    dealt = deal(docs, keys, text_col, block_bytes, fan=fan, held_out=flag)
    blocks = lambda: dealt.docs.groupBy("_block")
    first = dealt.levels[0]
    told = exchange(blocks().applyInArrow(_ask(first), CELLS), dealt, _sum, _total, every=True)
    triples = blocks().cogroup(told.groupBy("block")).applyInArrow(_ask_triples(first, kept), CELLS)
    both = told.withColumn("triple", F.lit(False)).unionByName(exchange(triples, dealt, _sum, _total).withColumn("triple", F.lit(True)))
    ddl = ", ".join(f"_k{i} {dealt.docs.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keys)))
    out = blocks().cogroup(both.groupBy("block")).applyInArrow(
        _score(len(keys), mu, kept), f"{ddl}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)})
