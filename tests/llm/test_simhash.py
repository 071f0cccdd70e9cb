"""SimHash: fingerprints and components against plain restatements."""

import random
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
import xxhash

from corvane.llm import simhash
from corvane.llm.components import connected_components


def plain_fingerprint(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] * bool(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids, radius=4):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            parent[find(j)] = find(i)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    return {ids[i]: min(groups[find(i)]) for i in range(len(fps))}


@pytest.mark.parametrize("text", [None, "", " \t", "one", "One two THREE", "a b c d", "É a b c d e f É", "x " * 5000, "a b c\x1cd e f g"])
def test_fingerprint_is_the_plain_one(text):
    assert simhash.fingerprint(text.encode() if text is not None else None).tolist() == [plain_fingerprint(text)]


def test_parts_differ_and_the_first_is_the_plain_one():
    text = "a b c d e f g h i j k"
    parts = simhash.fingerprint(text.encode(), parts=4).tolist()
    assert parts[0] == plain_fingerprint(text) and len(set(parts)) == 4 and simhash.fingerprint(None, parts=3).tolist() == [0, 0, 0]
    assert (simhash.expected_distance(1.0, 256), simhash.expected_distance(0.0, 256), simhash.expected_distance(0.8, 256)) == (0, 128, 39)


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = simhash.covering_masks(range(64), 4)
    assert len(masks) == 31
    rng = random.Random(5)
    for _ in range(3000):
        flips = rng.sample(range(64), rng.randint(1, 4))
        d = sum(1 << b for b in flips)
        assert any(d & m == 0 for m in masks)


@pytest.mark.parametrize("max_bucket", [2048, 8])
def test_components_equal_brute_force(spark, max_bucket):
    rng = random.Random(7)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(60)) for _ in range(25)]
    rows, n = [], 0
    for text in base:
        for _ in range(8):
            words = text.split()
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(60)] = rng.choice("xyz")
            rows.append((n, " ".join(words), "x"))
            n += 1
    rows += [(n, None, "y"), (n + 1, "", "y"), (n + 2, "  ", "y"), (n + 3, "w " * 30000, "y"), (n + 4, rows[0][1], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.simhash_components(docs, max_bucket=max_bucket).collect()}
    ids = [r[0] for r in rows]
    fps = [plain_fingerprint(r[1]) for r in rows]
    assert {i: got[i][0] for i in ids} == dict(zip(ids, fps, strict=True))
    assert {i: got[i][1] for i in ids} == plain_components(fps, ids)


def test_bucket_links_of_a_large_bucket_join_what_is_near():
    rng = np.random.default_rng(3)
    walk = [0]
    for _ in range(299):  # a chain: neighbours differ in one bit, ends in many
        walk.append(walk[-1] ^ 1 << int(rng.integers(0, 64)))
    fps = np.unique(np.array(walk, np.uint64))
    a, b = simhash.bucket_links(fps[:, None], np.zeros(len(fps), int), 4)
    assert len(a) == len(fps) - 1 and len(set(b.tolist())) == 1


@pytest.mark.parametrize("max_bucket", [2048, 4])
def test_several_parts_find_pairs_of_five_word_similarity(spark, max_bucket):
    """Links at an estimated 0.8: nearly all pairs of 0.9 or more, none far below 0.8."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=6))
    rows, close = [], 0
    for i in range(120):
        base = [word() for _ in range(200)]
        edited = list(base)
        tail = [3, 9, 60][i % 3]  # similarity 0.97, 0.91, 0.53
        edited[200 - tail :] = [word() for _ in range(tail)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited))]
        close += tail < 60
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.simhash_components(docs, k=5, parts=4, max_distance=simhash.expected_distance(0.8, 256), max_bucket=max_bucket).collect()
    root = {r["doc_id"]: r["component_id"] for r in found}
    linked = [i for i in range(120) if root[2 * i + 1] == 2 * i]
    assert not any(i % 3 == 2 for i in linked) and all(root[2 * i] == 2 * i for i in range(120))
    assert len(linked) >= 0.9 * close


def test_empty_table_and_null_ids(spark):
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.simhash_components(docs).collect()] == [3, 3, 3]


def test_components_of_a_star_a_chain_and_a_cycle(spark):
    links = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2001), (2001, 2002), (2002, 2000), (5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "p long, q long"), "p", "q").collect()}
    want = {i: 0 for i in range(1, 200)} | {i: 1000 for i in range(1001, 1101)} | {2001: 2000, 2002: 2000}
    assert got == want


def test_rows_of_tables_and_nodes_are_never_broadcast(spark):
    """The estimates of a small table's nodes know nothing of the rows that each gives, which may be many."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        nodes = simhash.cut(spark.range(300).selectExpr("id AS node", "id % 7 AS fp0"))
        for max_bucket, fixed in ((2048, 0), (8, 1)):  # the second covering's own table has a fixed size
            links = simhash.near_links(nodes, max_bucket=max_bucket)
            assert links._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") == fixed
            assert {r["node"] for r in connected_components(links, "a", "b").collect()} == set(range(1, 300))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_few_rows_make_few_files(spark, tmp_path):
    """Each file of a checkpoint is two processes that an executor starts; hundreds of them for a few rows are not needed."""
    was = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.glob("*/*/part-*"))
    rows = [(i, f"{i // 3} a b c d e f g h") for i in range(90)] + [(90 + i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    try:
        for c, v in zip(was, ("37", "false"), strict=True):
            spark.conf.set(c, v)
        found = simhash.simhash_components(docs)
        found.write.parquet(str(tmp_path / "out"))
        got = {r["doc_id"]: r["component_id"] for r in found.collect()}
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    by_folder = {}
    for f in set(shared.glob("*/*/part-*")) - before:
        by_folder[f.parent] = by_folder.get(f.parent, 0) + 1
    assert len(by_folder) >= 6 and max(by_folder.values()) <= 2 and len(list((tmp_path / "out").glob("part-*"))) == 1
    fps = [plain_fingerprint(r[1]) for r in rows]
    assert got == plain_components(fps, [r[0] for r in rows])
