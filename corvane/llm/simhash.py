"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: a text's A-Z are lower-cased, its words are runs without ASCII white space, and every k-word
shingle (repeats included) votes on 64 bits with its XXH64, seed 42. Texts of fewer words are one shingle;
texts without words have fingerprint zero and link like any other. With ``parts`` over 1 a fingerprint has that many
times 64 bits; the hashes of later parts are mixed from the first.

Covering, part by part: bit i gets a non-zero vector m(i) of radius+1 bits. Table v (each non-zero vector) keeps the
bits with odd m(i).v. Two parts that differ in at most ``radius`` bits agree on every bit of some table, because that
many vectors cannot span all of the space; so no pair within the radius in any of its parts is lost. Pairs that meet
in a table link if they differ in at most ``max_distance`` bits of the whole fingerprint. With one part and
max_distance = radius that is exactly the pairs within the radius.

A similarity of s (Jaccard, of shingle sets) makes two fingerprints differ in about arccos(2s / (1 + s)) / pi of their
bits: ``expected_distance``. Far pairs meet by chance only, so for similarities well below the radius some are lost.

Distinct fingerprints are the nodes, so exact copies never meet in a bucket. A bucket of over ``MAX_BUCKET``
fingerprints is split by a second covering over the bits its table left free, which keeps the guarantee and
bounds a bucket by the patterns of the roughly 16 bits then left. Buckets give stars of links, not all pairs.

Defined results: null is an empty text. Rows with one fingerprint share a component whatever their number;
component_id is the smallest id reachable (nulls ignored; null if all are null). Empty tables are allowed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.blocks import MULTIPLY, mix
from corvane.llm.common import cut, map_texts, packed
from corvane.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
MAX_BUCKET = 2048
#: Table rows that one task makes, as far as ``spark.sql.shuffle.partitions`` allows.
TASK_ROWS = 1 << 18
SEED = 42


def shingle_hashes(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """The XXH64 of every k-word shingle of a UTF-8 text, repeats included."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if n <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = [0, *(ends[: n - k] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :].tolist(), strict=True)), np.uint64, n - k + 1)


def fingerprint(text: bytes | None, k: int = SHINGLE, parts: int = 1) -> np.ndarray:
    """The SimHash of a UTF-8 text: ``parts`` unsigned 64-bit values."""
    hashes = shingle_hashes(text, k)
    votes = np.zeros((parts, 64), np.int64)
    for at in range(0, len(hashes), 1 << 15):  # bounded memory for very long texts
        some = hashes[at : at + (1 << 15)]
        for p in range(parts):
            values = some if p == 0 else mix(some + np.uint64(p * int(MULTIPLY[0]) % (1 << 64)))
            votes[p] += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > len(hashes), axis=1, bitorder="little").view(np.uint64).ravel()


def expected_distance(similarity: float, bits: int) -> int:
    """How many of ``bits`` differ, on average, between texts whose shingle sets have this Jaccard similarity."""
    return round(math.acos(2 * similarity / (1 + similarity)) / math.pi * bits)


def part_names(parts: int) -> list[str]:
    return [f"fp{p}" for p in range(parts)]


def fingerprints(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text_col: str = "text", k: int = SHINGLE, parts: int = 1) -> DataFrame:
    """``keys`` and the fingerprint's parts fp0.. (signed longs) per row."""
    names = part_names(parts)

    def make():
        def compute(texts):
            found = np.array([fingerprint(t, k, parts) for t in texts], np.uint64).reshape(-1, parts).view(np.int64)
            return {c: pa.array(np.ascontiguousarray(found[:, p])) for p, c in enumerate(names)}

        return compute

    return map_texts(docs, keys, text_col, make, ", ".join(f"{c} long" for c in names))


def covering_masks(bits: Sequence[int], radius: int) -> list[int]:
    """One mask over ``bits`` per non-zero vector of radius+1 bits; vectors are dealt to bits in turn."""
    size = 1 << (radius + 1)
    vector = {b: i % (size - 1) + 1 for i, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() & 1) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _labels_of_pairs(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the pairs, for 0..n-1."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, whose parts lie along the last axis."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def bucket_links(fps: np.ndarray, bucket: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, star centre) of the rows of ``fps`` (one fingerprint each) in whole buckets, which stand together."""
    n = len(fps)
    new = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1) != 0) if n else np.zeros(0, int)
    sizes = np.diff(np.append(new, n))
    left, right = [], []
    small = np.repeat(sizes <= 64, sizes)
    for d in range(1, int(min(64, sizes.max(initial=1)))):
        i = np.flatnonzero((bucket[:-d] == bucket[d:]) & small[:-d])
        i = i[_distance(fps[i], fps[i + d]) <= most]
        left.append(i)
        right.append(i + d)
    for s, m in zip(new[sizes > 64], sizes[sizes > 64], strict=True):
        part = fps[s : s + m]
        label = np.arange(m)
        while True:  # smallest label among neighbours, a block of rows at a time
            low = label.copy()
            for r in range(0, m, 256):
                near = _distance(part[r : r + 256, None], part[None, :]) <= most
                low[r : r + 256] = np.where(near, low[None, :], m).min(axis=1)
            low = low[low]
            if (low == label).all():
                break
            label = low
        i = np.flatnonzero(label != np.arange(m))
        left.append(s + label[i])
        right.append(s + i)
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    label = _labels_of_pairs(n, np.concatenate(left), np.concatenate(right))
    i = np.flatnonzero(label != np.arange(n))
    return i, label[i]


def _tables(parts: int, masks: Sequence[int]) -> Column:
    """(t, h) per table: its number and the hash of the bits it keeps. Chance collisions only make more pairs meet."""
    kept = lambda p, m: F.col(f"fp{p}").bitwiseAND(F.lit(_signed(m)))
    numbered = [(p * len(masks) + v, kept(p, m)) for p in range(parts) for v, m in enumerate(masks)]
    return F.inline(F.array(*[F.struct(F.lit(t).alias("t"), F.xxhash64(F.lit(t), key).alias("h")) for t, key in numbered]))


def near_links(nodes: DataFrame, parts: int = 1, radius: int = RADIUS, max_distance: int | None = None, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) of ``node``s whose components are those of all pairs that meet in a table and link.

    ``nodes``: a distinct long ``node`` and the parts fp0.. of its fingerprint.
    """
    return counted_links(nodes, nodes.count(), parts, radius, max_distance, max_bucket)[0]


def counted_links(nodes: DataFrame, n: int, parts: int = 1, radius: int = RADIUS, max_distance: int | None = None, max_bucket: int = MAX_BUCKET) -> tuple[DataFrame, int]:
    """``near_links`` of ``n`` nodes, and a bound on their number: a bucket gives less links than it has members."""
    most = radius if max_distance is None else max_distance
    masks, names = covering_masks(range(64), radius), part_names(parts)
    # nodes are few bytes each, so that bytes alone would pack them into few tasks; each gives a row a table
    made = n * parts * len(masks)
    tasks = math.ceil(made / TASK_ROWS)
    spread = nodes.repartition(max(1, min(tasks, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))), "node")
    rows = spread.select("node", _tables(parts, masks))
    counts = cut(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), made)
    # never broadcast: estimates, which the checkpoints keep, know nothing of the rows that a node gives, so that buckets
    # and nodes of any number would pass for a few MB and be gathered by the driver
    held, known = counts.hint("merge"), nodes.hint("merge")
    met = rows.select("h", "node").join(held.filter(F.col("n") <= max_bucket).select("h"), "h")
    members = met.join(known, "node").select("h", "node", *names)
    small, large = counts.agg(*[F.coalesce(F.sum(F.when(x, F.col("n"))), F.lit(0)) for x in (F.col("n") <= max_bucket, F.col("n") > max_bucket)]).first()
    if large:
        free = [[b for b in range(64) if not m >> b & 1] for m in masks]
        second = [(p * len(masks) + v, p, u, _signed(m)) for p in range(parts) for v, bits in enumerate(free) for u, m in enumerate(covering_masks(bits, radius))]
        table = nodes.sparkSession.createDataFrame(second, "t int, part int, u int, mask long")  # parts * (2**(radius+1)-1)**2 rows
        hot = rows.join(held.filter(F.col("n") > max_bucket).select("h"), "h").join(known, "node").join(F.broadcast(table), "t")
        part = F.element_at(F.array(*names), F.col("part") + 1)
        members = members.union(hot.select(F.xxhash64("h", "u", part.bitwiseAND(F.col("mask"))).alias("h"), "node", *names))
    dealt = members.repartition("h").sortWithinPartitions("h")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def out(table):
            h, node = (table.column(c).to_numpy() for c in ("h", "node"))
            bucket = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
            a, b = bucket_links(np.column_stack([table.column(c).to_numpy().view(np.uint64) for c in names]), bucket, most)
            return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            h = table.column("h").to_numpy()
            other = np.flatnonzero(h != h[-1])
            whole = int(other[-1]) + 1 if len(other) else 0  # the last bucket may go on in the next batch
            if whole:
                yield out(table.slice(0, whole).combine_chunks())
            rest = table.slice(whole)
        if rest is not None and rest.num_rows:
            yield out(rest.combine_chunks())

    return dealt.mapInArrow(link, "a long, b long"), small + large * len(masks)


def simhash_components(
    docs: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    k: int = SHINGLE,
    radius: int = RADIUS,
    parts: int = 1,
    max_distance: int | None = None,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """``keys`` (the first is the id), fingerprint (16 hex digits a part), component_id and root per row. Eager.

    root, a long, tells components apart whatever their ids.
    """
    names = part_names(parts)
    rows = cut(fingerprints(docs, keys, text_col, k, parts))
    total = rows.count()
    # numbered once: the numbers are part of the checkpoint
    nodes = cut(rows.groupBy(*names).agg(F.min(keys[0]).alias("first")).withColumn("node", F.monotonically_increasing_id()), total)
    n = nodes.count()
    links, most = counted_links(nodes.select("node", *names), n, parts, radius, max_distance, max_bucket)
    roots = connected_components(links, "a", "b", most)
    with_root = nodes.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(*names, "first", F.coalesce("root", "node").alias("root"))
    with_root = cut(with_root, n)
    # materialised, so that the join below sees two plain exchanges and can split a large component
    smallest = with_root.groupBy("root").agg(F.min("first").alias("component_id"))
    smallest = cut(smallest, n)
    ids = with_root.join(smallest, "root").select(*names, "component_id", "root")
    out = packed(rows.join(ids, names, "left"), total)
    return out.select(*keys, F.concat(*[F.lower(F.lpad(F.hex(c), 16, "0")) for c in names]).alias("fingerprint"), "component_id", "root")
