"""Suffix-array dedup: removes byte runs that a document shares with an earlier one.

A byte goes if it lies in a ``length``-byte string that also starts in a document with a smaller id. Repeats come
from the common-prefix interval tree of an enhanced suffix array: intervals are read off the array of common
prefixes with a stack, and an interval is a maximal repeat if what precedes its occurrences differs. The
occurrences of a maximal repeat in other than its smallest document are removed; every repeated string of
``length`` bytes lies in a maximal repeat of the same documents, so this is the rule above.

To spread the array over a cluster, texts are cut into segments around anchors. The anchor of a string of
``length`` bytes is the ``GRAM``-byte gram in it with the smallest hash (the leftmost of equals), so equal strings
have equal anchors. Neighbouring strings with one anchor form a segment; segments with equal anchors meet in
one bucket, and in one of its suffix arrays. A segment's first string counts as preceded by
something of its own, so no repeat is lost at a cut.

1. Each block of documents (see ``blocks``) sends its distinct anchors; buckets answer which occur in two
   documents or more, and which are hot: in over ``hot`` segments.
2. Blocks send the distinct segments of shared anchors with their smallest document. Segments of hot anchors go
   as single strings, dealt by their own hash, so that a hot anchor's many contexts spread over all buckets.
3. Buckets build the arrays, a slice of whole anchors at a time, and answer each segment with runs of bytes and the smallest document that has them.
4. Blocks remove from each document the runs that a smaller document has.

Texts are the UTF-8 bytes; matches never cross documents, and are judged on the input, not on what is left.
Defined results: null is an empty text. A null id counts as larger than any other, and null ids as one document;
so do rows that repeat an id, whose copies are left alone. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.blocks import CELLS, FAN, MULTIPLY, Answers, Entries, deal, exchange, in_order, mix

LENGTH = 50
GRAM = 16
HOT = 20_000
LARGEST_BUCKET = 16 << 20  # bytes of all texts over the number of buckets
SLICE = 1 << 20  # bytes of a bucket's segments in one suffix array, which takes about 50 times as many
STEP = 1 << 16  # window starts worked on at a time
LAST_ID = np.iinfo(np.int64).max


# ---- anchors


def anchor_segments(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first string's start, last string's start) of each run of strings with one anchor.

    ``buf`` holds the documents one after another, at ``starts`` with ``sizes``.
    """
    gram = min(gram, length)
    span, n = length - gram + 1, len(buf)
    fits = np.maximum(sizes - length + 1, 0)
    valid = np.repeat(np.tile([True, False], len(sizes)), np.column_stack([fits, sizes - fits]).ravel())
    padded = np.concatenate([buf, np.zeros(24, np.uint8)])
    low = np.uint64((1 << 18) - 1)
    found: list[tuple] = []
    for a in range(0, max(0, n - length + 1), STEP):
        m = min(STEP, n - length + 1 - a)
        ok = valid[a : a + m]
        if not ok.any():
            continue
        q = m + span - 1
        words = np.ascontiguousarray(np.ndarray((q + 8,), "<u8", padded.data, a, (1,)))
        head, tail = words[:q], words[gram - 8 : gram - 8 + q] if gram >= 8 else words[:q]
        if gram < 8:
            head = head & np.uint64((1 << 8 * gram) - 1)
            tail = head
        x = head * MULTIPLY[0] + (tail ^ (tail >> np.uint64(29))) * MULTIPLY[1]
        x ^= x >> np.uint64(32)
        x *= MULTIPLY[2]
        key = (x & ~low) | np.arange(q, dtype=np.uint64)
        least, width = key, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:m], least[span - width : span - width + m])
        at = least & low
        step = np.empty(m + 1, bool)
        step[0] = step[m] = True
        step[1:m] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1])
        edges = np.flatnonzero(step)
        first, last = edges[:-1], edges[1:] - 1
        good = ok[first]
        first, last = first[good], last[good]
        # minima are small; mixed again they spread evenly over the buckets
        found.append((mix(x[at[first].astype(np.int64)]), first + a, last + a))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


class BlockTexts:
    """A block's texts in one buffer, with their anchors' segments."""

    def __init__(self, table: pa.Table, length: int):
        table = in_order(table)
        texts = [t or b"" for t in table.column("_text").to_pylist()]
        self.table, self.length = table, length
        self.data = b"".join(texts)
        self.buf = np.frombuffer(self.data, np.uint8)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = np.array([LAST_ID if i is None else i for i in table.column("_k0").to_pylist()], np.int64)
        self.hash, self.first, self.last = anchor_segments(self.buf, self.starts, self.sizes, length)
        self.doc = np.searchsorted(self.starts, self.first, "right") - 1  # empty texts share a start; the last is it
        self.anchors, self.inverse = np.unique(self.hash, return_inverse=True)

    def pieces(self, flags: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct segments of shared anchors, with their keys, and occurrences (piece, document, start).

        Pieces come in the order of their keys. Equal pieces have equal anchors, hence equal keys.
        """
        number: dict[bytes, int] = {}
        flag = flags[self.inverse]
        whole, hot = np.flatnonzero(flag == 1), np.flatnonzero(flag == 2)
        many = self.last[hot] - self.first[hot] + 1
        single = np.repeat(self.first[hot] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        start = np.concatenate([self.first[whole], single])
        end = np.concatenate([self.last[whole], single]) + self.length
        data = self.data
        piece = np.fromiter((number.setdefault(data[a:b], len(number)) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.int64, len(start))
        texts = list(number)
        _, seen = np.unique(piece, return_index=True)
        key = np.zeros(len(texts), np.uint64)
        key[seen < len(whole)] = self.hash[whole[seen[seen < len(whole)]]]
        late = np.flatnonzero(seen >= len(whole))
        key[late] = np.fromiter((xxhash.xxh64_intdigest(texts[i]) for i in late.tolist()), np.uint64, len(late))
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        doc = np.concatenate([self.doc[whole], np.repeat(self.doc[hot], many)])
        return [texts[i] for i in order.tolist()], key[order], rank[piece], doc, start


# ---- the enhanced suffix array


def suffix_array(data: bytes, pos: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix with the suffix before) of the suffixes at ``pos``, each of ``left`` bytes.

    Suffixes are compared eight bytes at a time; each round works on those still tied.
    """
    n = len(pos)
    order, lcp = np.arange(n), np.zeros(n, np.int64)
    if n < 2:
        return order, lcp
    words = np.ndarray((len(data),), ">u8", data + bytes(8), 0, (1,)).astype(np.uint64)

    def word(suffixes: np.ndarray, done: int) -> np.ndarray:
        rest = left[suffixes] - done
        w = words[np.minimum(pos[suffixes] + done, len(data) - 1)]
        cut = np.flatnonzero(rest < 8)
        gone = np.clip(8 - rest[cut], 0, 8).astype(np.uint64) * np.uint64(8)
        w[cut] = np.where(gone < 64, w[cut] >> np.minimum(gone, np.uint64(63)) << np.minimum(gone, np.uint64(63)), np.uint64(0))
        return w

    tied, group, done, most = np.arange(n), np.zeros(n, np.int64), 0, int(left.max())
    while True:
        own = order[tied]
        w = word(own, done) if done < most else left[own].astype(np.uint64)  # equal to the end: the shorter first
        by = np.lexsort((w, group))
        own, w = own[by], w[by]
        order[tied] = own
        same = group[1:] == group[:-1]
        differ = w[1:] ^ w[:-1]
        if done >= most:
            lcp[tied[1:][same]] = most
            break
        clear = same & (differ != 0)
        d = differ[clear]
        lcp[tied[1:][clear]] = done + sum((d < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8))
        still = same & (differ == 0)
        keep = np.zeros(len(tied), bool)
        keep[1:] |= still
        keep[:-1] |= still
        if not keep.any():
            break
        group = np.cumsum(np.concatenate([[True], ~still]))[keep]
        tied, done = tied[keep], done + 8
    lcp[1:] = np.minimum(lcp[1:], np.minimum(left[order[1:]], left[order[:-1]]))
    return order, lcp


def intervals(lcp: Sequence[int], before: Sequence[int], length: int):
    """(common prefix, first, last) of the left-diverse intervals with a common prefix of ``length`` or more.

    ``before``: what precedes each suffix; -1 for the start of a segment, which differs from everything.
    One scan with a stack of open intervals; each carries the least and greatest of what precedes it.
    """
    stack: list[list[int]] = []
    n = len(lcp)
    for i in range(1, n + 1):
        now = lcp[i] if i < n else 0
        at, low, high = i - 1, before[i - 1], before[i - 1]
        while stack and stack[-1][0] > now:
            size, at, least, most = stack.pop()
            low, high = min(low, least), max(high, most)
            if low != high or low < 0:
                yield size, at, i - 1
        if stack and stack[-1][0] == now:
            top = stack[-1]
            top[2], top[3] = min(top[2], low), max(top[3], high)
        elif now >= length:
            stack.append([now, at, low, high])


def maximal_repeats(texts: Sequence[bytes], length: int):
    """(size, texts' numbers, offsets) of each maximal repeat among the texts, with all its occurrences.

    A repeat of ``length`` bytes or more that the text's start or end, or what surrounds it, keeps from being longer.
    Equal texts are expected once.
    """
    data = b"".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    fits = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(texts)), fits)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(fits) - fits, fits)
    pos = starts[owner] + offset
    order, lcp = suffix_array(data, pos, sizes[owner] - offset)
    inside = lcp >= length
    if not inside.any():
        return
    own, off = owner[order], offset[order]
    buf = np.frombuffer(data, np.uint8)
    before = np.where(off == 0, -1, buf[pos[order] - 1].astype(np.int64))
    # runs of suffixes that share ``length`` bytes; one that is not left-diverse has no interval that is
    first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) - 1
    last = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]]))
    bounds = np.column_stack([first, last + 1]).ravel()
    if bounds[-1] == len(before):
        bounds = bounds[:-1]
    low, high = np.minimum.reduceat(before, bounds)[::2], np.maximum.reduceat(before, bounds)[::2]
    for i in np.flatnonzero((low != high) | (low < 0)).tolist():
        a, b = int(first[i]), int(last[i]) + 1
        for size, x, y in intervals(lcp[a:b].tolist(), before[a:b].tolist(), length):
            yield size, own[a + x : a + y + 1], off[a + x : a + y + 1]


def earliest(texts: Sequence[bytes], least: np.ndarray, length: int) -> np.ndarray:
    """For each byte of the joined texts, the smallest document with a repeat there; at least its own text's."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    out = np.repeat(least, sizes)
    for size, own, off in maximal_repeats(texts, length):
        docs = least[own]
        m = docs.min()
        later = docs > m
        for a in (starts[own[later]] + off[later]).tolist():
            np.minimum(out[a : a + size], m, out=out[a : a + size])
    return out


def slices(keys: np.ndarray, sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive ranges of texts of about ``limit`` bytes that never part equal keys, which stand together.

    Equal strings have equal keys, so no repeat reaches from one range into another. A key's own texts are bounded: a
    segment is less than twice a string long, and an anchor of over ``HOT`` segments is dealt by whole strings.
    """
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - np.uint64(1)) != 0) if len(keys) else np.zeros(0, np.int64)
    bounds = np.append(first, len(keys)).tolist()
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    for here, after in pairwise(bounds):
        if total[after] - total[at] > limit and here > at:
            yield slice(at, here)
            at = here
    if at < len(keys):
        yield slice(at, len(keys))


# ---- the four steps


def _ask(bits: int, length: int):
    """Each distinct anchor with twice the number of its segments, and one more if they lie in several documents."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("_block")[0].as_py()
        own = BlockTexts(table, length)
        order = np.argsort(own.inverse, kind="stable")
        ids = own.ids[own.doc[order]] if len(order) else own.ids[:0]
        counts = np.bincount(own.inverse, minlength=len(own.anchors)).astype(np.int64)
        at = np.cumsum(counts) - counts
        several = np.minimum.reduceat(ids, at) != np.maximum.reduceat(ids, at) if len(at) else np.zeros(0, bool)
        return Entries(own.anchors, counts * 2 + several).rows(0, 0, bits, block, every=False)

    return run


def _gather(at: np.ndarray, info: np.ndarray, n: int) -> np.ndarray:
    """An anchor that comes from two blocks lies in several documents."""
    several = (np.bincount(at, minlength=n) > 1) | (np.bincount(at, weights=info & 1, minlength=n) > 0)
    segments = np.zeros(n, np.int64)
    np.add.at(segments, at, info >> 1)
    return segments * 2 + several


def _flag(hot: int):
    """1 for an anchor in several documents, 2 for one that is hot as well, else 0."""

    def run(entries: Entries) -> Answers:
        shared = entries.info & 1
        return Answers([(shared + (shared & (entries.info >> 1 > hot))).astype(np.uint8)])

    return run


def _flags_of(told: pa.Table) -> np.ndarray:
    found = Answers.read(told).columns
    return found[0] if found else np.zeros(0, np.uint8)


def _least(at: np.ndarray, least: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, LAST_ID)
    np.minimum.at(out, at, least)
    return out


def _send(bits: int, length: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return Entries(np.zeros(0, np.uint64), np.zeros(0, np.int64), []).rows(0, 0, bits, 0, every=False)
        own = BlockTexts(docs, length)
        texts, keys, piece, doc, _ = own.pieces(_flags_of(told))
        return Entries(keys, _least(piece, own.ids[doc], len(texts)), texts).rows(0, 0, bits, docs.column("_block")[0].as_py(), every=False)

    return run


def _runs(texts: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of bytes that have one smallest document: how many each text has; their offsets, lengths and documents."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    out = earliest(texts, least, length)
    step = np.concatenate([[True], out[1:] != out[:-1]])
    step[starts] = True
    first = np.flatnonzero(step)
    owner = np.searchsorted(starts, first, "right") - 1
    number = np.bincount(owner, minlength=len(texts)).astype(np.int32)
    return number, (first - starts[owner]).astype(np.int32), np.diff(np.append(first, len(out))).astype(np.int32), out[first]


def _repeats(length: int, limit: int = SLICE):
    """For each segment runs of bytes (offset, length) with the smallest document that has them."""

    def run(entries: Entries) -> Answers:
        texts = entries.texts or []
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        parts = [_runs(texts[s], entries.info[s], length) for s in slices(entries.keys, sizes, limit)]
        none = [(np.zeros(0, np.int32),) * 3 + (np.zeros(0, np.int64),)]
        number, *columns = (np.concatenate(c) for c in zip(*(parts or none), strict=True))
        return Answers(columns, number)

    return run


def whole_characters(buf: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """Only characters of which every byte is covered."""
    starts = np.flatnonzero((buf & 0xC0) != 0x80)
    if not len(starts):
        return covered
    starts[0] = 0
    return np.repeat(np.logical_and.reduceat(covered, starts), np.diff(np.append(starts, len(buf))))


def _remove(keys: int, length: int, whole: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        names = [f"_k{i}" for i in range(keys)]
        own = BlockTexts(docs, length)
        runs = pa.compute.is_valid(told.column("number"))
        _, _, piece, doc, start = own.pieces(_flags_of(told.filter(pa.compute.invert(runs))))
        n = len(own.buf)
        covered = np.zeros(n, bool)
        if len(piece):
            found = Answers.read(told.filter(runs)).take(piece)
            offset, size, least = (c.astype(np.int64) for c in found.columns)
            earlier = least < np.repeat(own.ids[doc], found.number)
            a = (np.repeat(start, found.number) + offset)[earlier]
            b = a + size[earlier]
            steps = np.zeros(n + 1, np.int32)
            np.add.at(steps, a, 1)
            np.subtract.at(steps, b, 1)
            covered = np.cumsum(steps, out=steps)[:n] > 0
        if whole:
            covered = whole_characters(own.buf, covered)
        ends = own.starts + own.sizes
        edge = covered.copy()
        edge[1:] &= ~covered[:-1]
        real = own.starts[own.sizes > 0]
        edge[real] = covered[real]
        span_first = np.flatnonzero(edge)
        edge = covered.copy()
        edge[:-1] &= ~covered[1:]
        edge[ends[own.sizes > 0] - 1] = covered[ends[own.sizes > 0] - 1]
        span_size = np.flatnonzero(edge) + 1 - span_first
        at = np.append(np.searchsorted(span_first, own.starts), len(span_first))
        owner = np.repeat(np.arange(len(own.starts)), np.diff(at))
        spans = pa.ListArray.from_arrays(
            pa.array(at, pa.int32()),
            pa.StructArray.from_arrays([pa.array(span_first - own.starts[owner], pa.int64()), pa.array(span_size, pa.int64())], names=["start", "length"]),
        )
        kept = [own.buf[a:b][~covered[a:b]].tobytes() if i < j else own.data[a:b] for a, b, i, j in zip(own.starts.tolist(), ends.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)]
        kept = [None if t is None else k for t, k in zip(own.table.column("_text").to_pylist(), kept, strict=True)]
        return pa.table({k: own.table.column(k) for k in names} | {"n_bytes": pa.array(own.sizes, pa.int64()), "spans": spans, "kept": pa.array(kept, pa.binary())})

    return run


def suffix_dedup(
    docs: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    length: int = LENGTH,
    hot: int = HOT,
    block_bytes: int | None = None,
    whole_characters: bool = False,
    fan: int = FAN,
) -> DataFrame:
    """``keys`` (the first an integer id), n_bytes, spans (start and length of removed runs) and kept (the bytes left).

    kept is null for a null text. ``whole_characters``: characters that would lose some of their bytes stay whole.
    """
    dealt = deal(docs, keys, text_col, block_bytes, LARGEST_BUCKET, fan)
    blocks = lambda: dealt.docs.groupBy("_block")
    first = dealt.levels[0]
    flags = exchange(blocks().applyInArrow(_ask(first, length), CELLS), dealt, _gather, _flag(hot))
    sent = blocks().cogroup(flags.groupBy("block")).applyInArrow(_send(first, length), CELLS)
    told = flags.unionByName(exchange(sent, dealt, _least, _repeats(length)))
    ddl = ", ".join(f"_k{i} {dealt.docs.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keys)))
    out = blocks().cogroup(told.groupBy("block")).applyInArrow(
        _remove(len(keys), length, whole_characters), f"{ddl}, n_bytes long, spans array<struct<start: long, length: long>>, kept binary"
    )
    return out.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)})
