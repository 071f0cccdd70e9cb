"""Benchmark decontamination: a prefix-filtered set join, in DataFrame operations only.

Words are runs of digits, ASCII letters (A-Z lower-cased) and non-ASCII characters. An item's windows are its
runs of ``window`` consecutive words; an item of fewer words is one window. A window occurs in a document where
its words stand there in a row. For containment, one shingle is a sufficient prefix: a window can only occur
where its rarest shingle (by corpus frequency) does.

1. Each document keeps the places whose ``SHINGLE``-word shingle belongs to any item, with the words around.
2. Those places give every item shingle's corpus frequency, hence each window's rarest shingle.
3. Only places of such prefix shingles join with windows; the offset within the window fixes its start, and
   starts that leave the document are dropped (length and position bound).
4. The words at that start are compared with the window's words: exact containment.

The item shingles' hashes are a literal set in the scan while their number is at most ``MAX_LITERALS``
(counted first); beyond it places travel as hashes through a semi-join, and only the places that items know get
their words. Windows, and then the items of the windows found, are broadcast if their bytes, counted first, are at most
``MAX_BROADCAST``; else Spark chooses the join.

Defined results: a null or wordless text has no words, no hits and is not contaminated; its ``items_sha256`` is
the hash of the empty string. A null item text has no windows; a null item_id counts for hits, not as an item.
Repeated documents are judged one by one; items repeated under one id count once. Empty tables are allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import ascii_lower, cut

WINDOW = 13
SHINGLE = 3
MAX_LITERALS = 100_000
MAX_BROADCAST = 32 << 20
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    spaced = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), NO_WORD, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _at(words: Column, i: Column, k: int) -> Column:
    """The k-word shingle at 0-based place i, as text."""
    return F.array_join(F.slice(words, i + 1, F.lit(k)), " ")


def _places(n: Column, k: int) -> Column:
    return F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))


def _is_in(words: Column, k: int, hashes: list[int]):
    return lambda i: F.xxhash64(_at(words, i, k)).isin(hashes)


def _with_hash(words: Column, k: int):
    return lambda i: F.struct(i.alias("pos"), F.xxhash64(_at(words, i, k)).alias("h"))


def _with_words(words: Column, k: int, window: int):
    """A place with its shingle and the words that a window through it can reach."""
    first = lambda i: F.greatest(i - (window - k), F.lit(0))
    return lambda i: F.struct(
        i.alias("pos"), _at(words, i, k).alias("gram"), first(i).alias("first"),
        F.slice(words, first(i) + 1, F.lit(2 * window - k)).alias("near"),
    )


def item_windows(items: DataFrame, item_id: str, text_col: str, window: int) -> DataFrame:
    """win (text), len, item_id (as a string) for each distinct window of each item."""
    base = items.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(text_col)).alias("w"))
    base = base.withColumn("len", F.least(F.size("w"), F.lit(window))).filter("len > 0")
    starts = F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)
    wins = base.select("item_id", "len", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.col("len")), " "))).alias("win"))
    return wins.distinct()


def find_occurrences(
    docs: DataFrame,
    items: DataFrame,
    keys: Sequence[str],
    text_col: str,
    item_id: str,
    item_text: str,
    window: int,
    max_literals: int,
) -> tuple[DataFrame, DataFrame]:
    """(one row per document: _row, keys as _k0.., n_words; one per occurrence and item: _row, start, len, item_id)."""
    spark = docs.sparkSession
    per_item = cut(item_windows(items, item_id, item_text, window))
    wins = per_item.select("win", "len").distinct().withColumn("k", F.least("len", F.lit(SHINGLE)))
    split = F.split("win", " ")
    grams = wins.select("win", "len", "k", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("len") - F.col("k") + 1), lambda i: F.array_join(F.slice(split, i, F.col("k")), " "))).alias("offset", "gram"))
    grams = cut(grams)
    wanted = grams.select("k", F.xxhash64("gram").alias("h")).distinct()
    few = wanted.limit(max_literals + 1).count() <= max_literals

    named = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]
    base = docs.select(F.monotonically_increasing_id().alias("_row"), *named, words_of(F.col(text_col)).alias("_w"))
    base = base.withColumn("n_words", F.size("_w").cast("long"))
    sizes = sorted(r["k"] for r in wanted.select("k").distinct().collect())
    if few:
        found = []
        for k in sizes:
            hashes = [r["h"] for r in wanted.filter(F.col("k") == k).collect()]
            base = base.withColumn(f"_p{k}", F.filter(_places(F.size("_w"), k), _is_in(F.col("_w"), k, hashes)))
            found.append(F.transform(f"_p{k}", _with_words(F.col("_w"), k, window)))
        none = F.array().cast("array<struct<pos:int,gram:string,first:int,near:array<string>>>")
        kept = base.select("_row", *[f"_k{i}" for i in range(len(keys))], "n_words", (F.concat(*found) if found else none).alias("_hits"))
        kept = cut(kept)
        rows = kept.drop("_hits")
        hits = kept.select("_row", "n_words", F.inline("_hits"))
    else:
        kept = cut(base)
        rows = kept.drop("_w")
        parts = []
        for k in sizes:
            # places travel as (row, place, hash); the words are fetched for those that items know
            hashed = F.transform(_places(F.size("_w"), k), _with_hash(F.col("_w"), k))
            known = kept.select("_row", F.inline(hashed)).join(wanted.filter(F.col("k") == k).select("h"), "h", "left_semi")
            places = known.groupBy("_row").agg(F.collect_list("pos").alias("places"))
            parts.append(kept.join(places, "_row").select("_row", "n_words", F.inline(F.transform("places", _with_words(F.col("_w"), k, window)))))
        hits = cut(reduce(DataFrame.unionByName, parts))

    frequency = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))
    prefix = (
        grams.join(frequency, "gram", "left")
        .groupBy("win", "len")
        .agg(F.min(F.coalesce("freq", F.lit(0))).alias("least"), F.min(F.struct(F.coalesce("freq", F.lit(0)), "gram", "offset")).alias("p"))
        .filter("least > 0")
        .select("win", "len", F.col("p.gram").alias("gram"), F.col("p.offset").alias("offset"))
    )
    prefix = cut(prefix)
    near = hits.join(_small(prefix, "win", "gram"), "gram")
    start = F.col("pos") - F.col("offset")
    inside = near.filter((start >= 0) & (start + F.col("len") <= F.col("n_words")))
    exact = inside.filter(F.array_join(F.slice("near", start - F.col("first") + 1, F.col("len")), " ") == F.col("win"))
    found = exact.select("_row", start.alias("start"), "len", "win").join(_small(per_item.select("win", "item_id"), "win", "item_id"), "win")
    return rows, found.select("_row", "start", "len", "item_id")


def _small(df: DataFrame, *texts: str) -> DataFrame:
    """``df``, broadcast if its rows' bytes, counted first, are at most ``MAX_BROADCAST``."""
    held = df.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(64)))).first()[0]
    return F.broadcast(df) if (held or 0) <= MAX_BROADCAST else df


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = 20,
    max_literals: int = MAX_LITERALS,
) -> DataFrame:
    """Per document: ``keys``, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit counts the words inside any occurrence of a window; contaminated: n_hit > 0 and
    ``share`` * n_hit >= n_words. Eager: the item tables and the documents' hits are checkpointed.
    """
    rows, found = find_occurrences(docs, items, keys, text_col, item_id, item_text, window, max_literals)
    spans = F.transform(F.collect_set(F.struct("start", "len")), lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))
    per_row = found.groupBy("_row").agg(
        F.size(F.array_distinct(F.flatten(spans))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("ids"),
    )
    out = rows.join(per_row, "_row", "left").select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
