"""Similarity functions of record linkage.

Set measures are built-in expressions. The edit measures run in Arrow batches over a bit-parallel longest common
subsequence; a batch's repeated pairs are scored once. All lie in [0, 1]; a side that is empty gives 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.text import char_ngrams, number_tokens, recovery_normalize, text_of, token_set

# ---- on plain strings


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word-parallel step per character of ``b``."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        met = free & where.get(c, 0)
        free = ((free + met) | (free - met)) & full
    return len(a) - free.bit_count()


WORD = 64  # characters of the shorter text that one step takes at once
CHUNK = 2048  # pairs worked on together


def _code_points(texts: Sequence[str], width: int, filler: int) -> np.ndarray:
    """One row of code points per text, filled up with a value that no character has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.full((len(texts), width), filler, np.uint32)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def common_subsequences(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """``common_subsequence`` of many pairs: the same steps, for all pairs of a chunk at once."""
    out = np.zeros(len(pairs), np.int64)
    sides = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    fits = [i for i, (a, _) in enumerate(sides) if 0 < len(a) <= WORD]
    fits.sort(key=lambda i: len(sides[i][1]))  # texts of like lengths share a chunk
    for i, (a, b) in enumerate(sides):
        if len(a) > WORD:
            out[i] = common_subsequence(a, b)
    for start in range(0, len(fits), CHUNK):
        at = fits[start : start + CHUNK]
        short, long = [sides[i][0] for i in at], [sides[i][1] for i in at]
        left, right = _code_points(short, WORD, 0xFFFFFFFF), _code_points(long, len(long[-1]), 0xFFFFFFFE)
        sizes = np.fromiter(map(len, short), np.uint64, len(at))
        full = np.where(sizes < WORD, (np.uint64(1) << np.minimum(sizes, np.uint64(WORD - 1))) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
        free = full.copy()
        for c in right.T:
            met = free & np.packbits(left == c[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
            free = ((free + met) | (free - met)) & full
        out[at] = sizes.astype(np.int64) - np.bitwise_count(free)
    return out


def indel_ratios(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """``indel_ratio`` of many pairs."""
    total = np.fromiter((len(a) + len(b) if a and b else 0 for a, b in pairs), np.int64, len(pairs))
    return np.where(total > 0, 2.0 * common_subsequences(pairs) / np.maximum(total, 1), 0.0)


def indel_ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths."""
    total = len(a) + len(b)
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 2.0 * common_subsequence(a, b) / total


def set_ratio(a: str, b: str) -> float:
    """Similarity of the word sets: of the shared words with each side's, and of what each has alone."""
    return float(set_ratios([(a, b)])[0])


def set_ratios(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """``set_ratio`` of many pairs."""
    sets = [(set(a.split()), set(b.split())) for a, b in pairs]
    alone = [(" ".join(sorted(x - y)), " ".join(sorted(y - x))) for x, y in sets]
    out = np.zeros(len(pairs))
    for i, ((x, y), (only_a, only_b), same) in enumerate(zip(sets, alone, common_subsequences(alone).tolist(), strict=True)):
        if not x or not y:
            continue
        shared = x & y
        if shared and (not only_a or not only_b):
            out[i] = 1.0
            continue
        common, gap = len(" ".join(shared)), bool(shared)
        whole_a, whole_b = common + gap + len(only_a), common + gap + len(only_b)
        best = 1.0 - (len(only_a) + len(only_b) - 2 * same) / (whole_a + whole_b)
        if shared:
            best = max(best, 1.0 - (gap + len(only_a)) / (common + whole_a), 1.0 - (gap + len(only_b)) / (common + whole_b))
        out[i] = best
    return out


def sort_ratio(a: str, b: str) -> float:
    """Ratio of the texts with their words sorted."""
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text with a window of the longer, windows at its ends being shorter."""
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    n = len(a)
    best = 0.0
    for i in range(1 - n, len(b)):
        part = b[max(0, i) : i + n]
        if 2.0 * min(n, len(part)) / (n + len(part)) > best:
            best = max(best, indel_ratio(a, part))
    return best


def weighted_ratio(a: str, b: str) -> float:
    """The best of plain, word-order, word-set and partial ratios, the looser ones scaled down."""
    if not a or not b:
        return 0.0
    long, short = max(len(a), len(b)), min(len(a), len(b))
    plain = indel_ratio(a, b)
    if long < 1.5 * short:
        return max(plain, 0.95 * sort_ratio(a, b), 0.95 * set_ratio(a, b))
    scale = 0.9 if long < 8 * short else 0.6
    words_a, words_b = sorted(a.split()), sorted(b.split())
    if set(words_a) & set(words_b):
        by_words = 1.0
    else:
        by_words = partial_ratio(" ".join(words_a), " ".join(words_b))
    return max(plain, scale * partial_ratio(a, b), 0.95 * scale * by_words)


# ---- as columns


def distinct_pairs(a: pd.Series, b: pd.Series) -> tuple[list[tuple[str, str]], np.ndarray]:
    """The distinct pairs of two columns, nulls being empty, and each row's place among them."""
    number: dict[tuple[str, str], int] = {}
    at = [number.setdefault((x or "", y or ""), len(number)) for x, y in zip(a, b, strict=True)]
    return list(number), np.array(at, np.int64)


def _udf(score: Callable[[Sequence[tuple[str, str]]], np.ndarray]):
    @F.pandas_udf("double")  # no iterator: each of those has Python workers of its own, these share
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs, at = distinct_pairs(a, b)
        return pd.Series(np.asarray(score(pairs), "float64")[at] if pairs else [], dtype="float64")

    return run


def _each(score: Callable[[str, str], float]):
    return lambda pairs: [score(a, b) for a, b in pairs]


def ratio(a: Column | str, b: Column | str) -> Column:
    return _udf(indel_ratios)(text_of(a), text_of(b))


def token_set_ratio(a: Column | str, b: Column | str) -> Column:
    return _udf(set_ratios)(text_of(a), text_of(b))


def token_sort_ratio(a: Column | str, b: Column | str) -> Column:
    return _udf(_each(sort_ratio))(text_of(a), text_of(b))


def w_ratio(a: Column | str, b: Column | str) -> Column:
    return _udf(_each(weighted_ratio))(text_of(a), text_of(b))


def ratio_expression(a: Column | str, b: Column | str) -> Column:
    """``ratio`` from built-in expressions alone: a row of the subsequence table per character of ``a``.

    For short texts where no Python worker is wanted; quadratic in the lengths.
    """
    left, right = F.split(text_of(a), ""), F.split(text_of(b), "")
    zero = F.transform(right, lambda _: F.lit(0))
    pos = F.sequence(F.lit(1), F.size(right))

    def step(row: Column, c: Column) -> Column:
        def cell(done: Column, j: Column) -> Column:
            above = F.element_at(row, j)
            diagonal = F.when(j > 1, F.try_element_at(row, F.greatest(j - 1, F.lit(1)))).otherwise(0)
            before = F.when(j > 1, F.try_element_at(done, F.greatest(j - 1, F.lit(1)))).otherwise(0)
            return F.concat(done, F.array(F.when(F.element_at(right, j) == c, diagonal + 1).otherwise(F.greatest(above, before))))

        return F.aggregate(pos, F.array().cast("array<int>"), cell)

    common = F.element_at(F.aggregate(left, zero, step), -1).cast("double")
    total = (F.length(text_of(a)) + F.length(text_of(b))).cast("double")
    return F.when((text_of(a) == "") | (text_of(b) == ""), F.lit(0.0)).otherwise(F.lit(2.0) * common / total)


def set_jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two arrays without repeats; 0 if either is empty."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared.cast("double") / total)


def token_jaccard(a: Column | str, b: Column | str) -> Column:
    return set_jaccard(token_set(a), token_set(b))


def length_difference(a: Column | str, b: Column | str) -> Column:
    return F.abs(F.length(text_of(a)) - F.length(text_of(b)))


def ngram_jaccard(a: Column | str, b: Column | str, n: int = 3) -> Column:
    return set_jaccard(char_ngrams(a, n), char_ngrams(b, n))


def token_containment(a: Column | str, b: Column | str) -> Column:
    """Shared words over the words of the side that has fewer."""
    left, right = token_set(a), token_set(b)
    shared = F.size(F.array_intersect(left, right)).cast("double")
    return F.when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0)).otherwise(F.greatest(shared / F.size(left), shared / F.size(right)))


def token_overlap(a: Column | str, b: Column | str) -> Column:
    return F.size(F.array_intersect(token_set(a), token_set(b)))


def number_overlap(a: Column | str, b: Column | str) -> Column:
    return set_jaccard(number_tokens(a), number_tokens(b))


def best_score(a: Column | str, b: Column | str) -> Column:
    """The best of ratio, token-set ratio, word Jaccard and containment of the recovery forms."""
    left, right = recovery_normalize(a), recovery_normalize(b)
    return F.greatest(ratio(left, right), token_set_ratio(left, right), token_jaccard(left, right), token_containment(left, right))


name_score = address_score = best_score

