"""Blocks of documents that exchange statistics with buckets of hashed keys.

Some operators need, for every key that occurs in a text (a word, an n-gram, an anchor of a repeat), a figure
over all texts. Sending a row per key occurrence would multiply the input. Here documents are dealt to blocks of
a few MB by a hash of id and text (many null ids do not meet in one block); a block sends each distinct key once, as
sorted 64-bit hashes cut into cells by their leading bits; a bucket sees every block's keys of its range and answers
each block in the same order. A key that a third of all documents hold costs one entry a block, wherever it lands.

A block sends at most 2**FAN cells. Where there are more buckets than that, the way there has several levels, like a
radix sort: groups of 2**FAN blocks meet by the first bits of their keys, merge equal keys, and send cells by the next
bits; answers come back the same way. So every level sends at most 2**FAN rows a block and each distinct key at most once
a block: rows and bytes grow with the input (times the levels, one up to 64 GB of text, two up to 250 TB), not with
blocks times buckets.

The documents are shuffled to their blocks once; later steps that need the texts again reuse that exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BLOCK, LARGEST_BLOCK = 4 << 20, 16 << 20  # bytes of text; a task needs about 20 times as much memory
LEAST_BUCKET, LARGEST_BUCKET = 8 << 20, 32 << 20  # bytes of all texts over the number of buckets
FAN = 12  # bits of a key that one level tells apart
MULTIPLY = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
CELLS = "bucket long, block long, keys binary, info binary, data binary, sizes binary"
TOLD = "bucket long, block long, number binary, v0 binary, v1 binary, v2 binary, extra binary"


@dataclass(frozen=True)
class Dealt:
    """Documents by block (_block, _k0.., _text), the number of blocks, the bits of each level and the blocks a group has."""

    docs: DataFrame
    blocks: int
    levels: tuple[int, ...]
    group: int


def deal(docs: DataFrame, keys: Sequence[str], text_col: str, block_bytes: int | None = None, largest_bucket: int = LARGEST_BUCKET, fan: int = FAN, **extra) -> Dealt:
    """Deal documents to blocks. Both block and bucket sizes grow with the root of the input up to what a task can hold.

    ``extra``: further columns to carry, by name. The driver gets one number, the bytes of all texts.
    """
    text = F.col(text_col).cast("binary")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    root = total**0.5
    block = block_bytes or min(LARGEST_BLOCK, max(LEAST_BLOCK, int(136 * root)))
    bucket = min(largest_bucket, max(LEAST_BUCKET, int(272 * root)))
    blocks = max(1, -(-total // block))
    bits = max(1, (total // (block_bytes or bucket)).bit_length())
    depth = -(-bits // fan)
    levels = tuple(bits // depth + (i < bits % depth) for i in range(depth))
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    dealt = F.pmod(F.xxhash64(F.col(keys[0]), text), F.lit(blocks)).cast("long").alias("_block")
    rows = docs.select(dealt, *named, *[c.alias(n) for n, c in extra.items()], text.alias("_text"))
    return Dealt(rows.mapInArrow(_compress, rows.schema), blocks, levels, 1 << fan)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd with their sizes in front: about two thirds of what the shuffle's own compression leaves."""
    codec = pa.Codec("zstd")
    for batch in batches:
        texts = [None if t is None else len(t).to_bytes(4, "little") + (codec.compress(t, asbytes=True) if t else b"") for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield batch.set_column(batch.num_columns - 1, "_text", pa.array(texts, pa.binary()))


def _whole(data: bytes | None) -> bytes | None:
    if data is None or len(data) == 4:
        return None if data is None else b""
    return pa.decompress(data[4:], int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)


def in_order(table: pa.Table) -> pa.Table:
    """A block's documents, their texts unpacked, by id (null last), then text: the same order in every step that sees them."""
    table = table.set_column(table.column_names.index("_text"), "_text", pa.array(map(_whole, table.column("_text").to_pylist()), pa.binary()))
    ids = table.column("_k0").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
    if any(ids[a] == ids[b] for a, b in zip(order, order[1:], strict=False)):
        texts = table.column("_text").to_pylist()
        order = sorted(order, key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, texts[i] or b""))
    return table.take(pa.array(order, pa.int64()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * MULTIPLY[0] + mix(b + MULTIPLY[1]))


def pack(values: np.ndarray) -> bytes:
    """An array's bytes, compressed byte plane by byte plane: counts are mostly small, so the upper planes are empty."""
    values = np.ascontiguousarray(values)
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack(data: bytes, dtype) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).ravel()


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences."""
    return pack(np.diff(hashes, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _pack_any(values: np.ndarray) -> bytes:
    return values.dtype.str.encode().ljust(4) + pack(values)


def _unpack_any(data: bytes) -> np.ndarray:
    return unpack(data[4:], np.dtype(data[:4].decode().strip()))


def cut_evenly(total: int, sizes: Sequence[int]) -> Iterator[slice]:
    """Consecutive slices of the given sizes."""
    at = 0
    for size in sizes:
        yield slice(at, at + size)
        at += size
    assert at == total


# ---- what cells hold


@dataclass
class Entries:
    """Keys in ascending order, each with a figure and, if the keys stand for texts, the text."""

    keys: np.ndarray
    info: np.ndarray
    texts: list[bytes] | None = None

    def rows(self, bucket: int, done: int, bits: int, block: int, every: bool) -> pa.Table:
        """A cell for each value of the ``bits`` bits after the first ``done``, which are ``bucket``; empty ones if ``every``."""
        first = (bucket << bits) * (1 << (64 - done - bits))
        starts = np.arange(1 << bits, dtype=np.uint64) * np.uint64(1 << (64 - done - bits)) + np.uint64(first)
        at = np.append(np.searchsorted(self.keys, starts), len(self.keys))
        at[0] = 0
        some = np.arange(1 << bits) if every else np.flatnonzero(np.diff(at))
        spans = [slice(a, b) for a, b in zip(at[some].tolist(), at[some + 1].tolist(), strict=True)]
        none = pa.nulls(len(spans), pa.binary())
        sizes = np.fromiter(map(len, self.texts), np.int32, len(self.texts)) if self.texts is not None else None
        return pa.table({
            "bucket": pa.array((bucket << bits) + some, pa.int64()), "block": pa.array(np.full(len(spans), block), pa.int64()),
            "keys": pa.array([pack_sorted(self.keys[s]) for s in spans], pa.binary()),
            "info": pa.array([pack(self.info[s]) for s in spans], pa.binary()),
            "data": none if sizes is None else pa.array([b"".join(self.texts[s]) for s in spans], pa.binary()),
            "sizes": none if sizes is None else pa.array([pack(sizes[s]) for s in spans], pa.binary()),
        })


Combine = Callable[[np.ndarray, np.ndarray, int], np.ndarray]


def merge(cells: pa.Table, combine: Combine) -> tuple[Entries, list[np.ndarray]]:
    """The distinct entries of cells of one range, and where each cell's are among them.

    ``combine`` gets every entry's place, its figure and the number of places, and gives the places' figures.
    """
    keys = [unpack_sorted(k) for k in cells.column("keys").to_pylist()]
    info = [unpack(x, np.int64) for x in cells.column("info").to_pylist()]
    every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    figures = np.concatenate(info) if info else np.zeros(0, np.int64)
    texts = None
    if cells.num_rows and cells.column("data").null_count == 0:
        number: dict[bytes, int] = {}
        places = []
        for data, sizes in zip(cells.column("data").to_pylist(), cells.column("sizes").to_pylist(), strict=True):
            ends = np.cumsum(unpack(sizes, np.int32).astype(np.int64)).tolist()
            places += [number.setdefault(data[a:b], len(number)) for a, b in zip([0, *ends], ends, strict=False)]
        at, texts = np.array(places, np.int64), list(number)
        distinct = np.zeros(len(texts), np.uint64)
        distinct[at] = every
        order = np.argsort(distinct, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at, distinct, texts = rank[at], distinct[order], [texts[i] for i in order.tolist()]
    else:
        distinct, at = np.unique(every, return_inverse=True)
    sizes = list(map(len, keys))
    return Entries(distinct, combine(at, figures, len(distinct)), texts), [at[s] for s in cut_evenly(len(every), sizes)]


@dataclass
class Answers:
    """For each entry ``number`` values (None: one) in each of up to three columns; and figures of the range as a whole."""

    columns: list[np.ndarray]
    number: np.ndarray | None = None
    extra: tuple[int, ...] = ()

    def take(self, at: np.ndarray) -> Answers:
        if self.number is None:
            return Answers([c[at] for c in self.columns], None, self.extra)
        begin, number = np.cumsum(self.number) - self.number, self.number[at]
        places = np.repeat(begin[at] - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))
        return Answers([c[places] for c in self.columns], number, self.extra)

    @staticmethod
    def read(told: pa.Table) -> Answers:
        """The answers of cells, in the order of their ranges; their extra figures added up."""
        told = told.sort_by("bucket")
        column = lambda c: [_unpack_any(x) for x in told.column(c).to_pylist() if x is not None]
        columns = [np.concatenate(parts) for parts in map(column, ("v0", "v1", "v2")) if parts]
        number, extra = column("number"), column("extra")
        return Answers(columns, np.concatenate(number) if number else None, tuple(np.sum(extra, axis=0).tolist()) if extra else ())

    def row(self) -> list[bytes | None]:
        """number, v0, v1, v2 and extra of one row of TOLD."""
        values = [*map(_pack_any, self.columns), None, None, None][:3]
        return [None if self.number is None else _pack_any(self.number), *values, _pack_any(np.array(self.extra, np.int64)) if self.extra else None]


def _told(cells: pa.Table, answers: list[Answers]) -> pa.Table:
    columns = list(zip(*[a.row() for a in answers], strict=True)) or [()] * 5
    named = {c: pa.array(list(v), pa.binary()) for c, v in zip(("number", "v0", "v1", "v2", "extra"), columns, strict=True)}
    return pa.table({"bucket": cells.column("bucket").combine_chunks(), "block": cells.column("block").combine_chunks()} | named)


def _split(done: int, bits: int, combine: Combine, every: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        merged, _ = merge(table, combine)
        return merged.rows(key[0].as_py(), done, bits, key[1].as_py(), every)

    return run


def climb(cells: DataFrame, dealt: Dealt, combine: Combine, every: bool = False) -> list[DataFrame]:
    """The cells of each level (CELLS), the blocks' own first."""
    up, done = [cells], dealt.levels[0]
    for bits in dealt.levels[1:]:
        up.append(_grouped(up[-1], dealt.group).groupBy("bucket", "group").applyInArrow(_split(done, bits, combine, every), CELLS))
        done += bits
    return up


def exchange(cells: DataFrame, dealt: Dealt, combine: Combine, answer: Callable[[Entries], Answers], every: bool = False) -> DataFrame:
    """TOLD: the answer of the key's bucket to every entry of the blocks' first-level ``cells`` (CELLS).

    ``answer`` gets a bucket's distinct entries with their figures over all blocks, and gives answers in the same order.
    """
    up = climb(cells, dealt, combine, every)

    def settle(table: pa.Table) -> pa.Table:
        merged, places = merge(table, combine)
        found = answer(merged)
        return _told(table, [found.take(at) for at in places])

    told = up[-1].groupBy("bucket").applyInArrow(settle, TOLD)
    for bits, own in zip(reversed(dealt.levels[1:]), reversed(up[:-1]), strict=True):

        def descend(table: pa.Table, told: pa.Table) -> pa.Table:
            _, places = merge(table, combine)
            found = Answers.read(told)
            return _told(table, [found.take(at) for at in places])

        parent = told.withColumn("parent", F.shiftright("bucket", bits))
        told = _grouped(own, dealt.group).groupBy("bucket", "group").cogroup(parent.groupBy("parent", "block")).applyInArrow(descend, TOLD)
    return told


def _grouped(cells: DataFrame, group: int) -> DataFrame:
    return cells.withColumn("group", F.floor(F.col("block") / group).cast("long"))
