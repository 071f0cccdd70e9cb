"""Token counts: whole-token shortcut over a byte-level BPE vocabulary.

Before any text is read, ``WholeTokens.prove`` runs the merges on every vocabulary string and keeps those
that encode alone as one token. Texts are then split into pre-tokens; a pre-token that is in the proven set
counts one without further work, and only the rest go through the merges (with a bounded memory of results).

Counts equal those of the ``tokenizers`` library for the same file without begin, end or added special
tokens; its special strings inside a text count one token each, as is the library's default.

Defined results: a null text counts as empty (0 bytes, 0 tokens). Whole texts are counted, however long.
Repeated rows are counted one by one; an empty table gives an empty result. The vocabulary is broadcast; its
size is that of the vocabulary file, whatever the input's size.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from itertools import pairwise

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import map_texts

#: The byte-level pre-tokenizer's pattern, with Unicode's White_Space spelt out for \s.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+"
    r"| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])"
    rf"|[{SPACE}]+"
)
REMEMBERED = 400_000


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: itself, or the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, spare = {}, 0x100
    for byte in range(256):
        table[chr(byte if byte in plain else spare)] = byte
        spare += byte not in plain
    return table


def check_definition(definition: dict) -> None:
    """Raise ValueError for settings that would change counts and that this operator does not follow."""
    model, split = definition["model"], definition.get("pre_tokenizer") or {}
    faults = [name for name in ("ignore_merges", "dropout", "continuing_subword_prefix", "end_of_word_suffix") if model.get(name)]
    faults += ["normalizer"] * bool(definition.get("normalizer"))
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        faults.append("pre_tokenizer")
    faults += [f"{flag} of {t['content']!r}" for t in definition.get("added_tokens", ()) for flag in ("lstrip", "rstrip", "single_word") if t.get(flag)]
    if faults:
        raise ValueError(f"tokenizer settings not supported: {', '.join(faults)}")


class WholeTokens:
    """Merge ranks, special strings and the set of pre-tokens proven to be one token."""

    def __init__(self, definition: dict):
        table = byte_symbols()
        raw = lambda s: bytes(table[c] for c in s)
        model = definition["model"]
        number = {bytes([i]): i for i in range(256)}  # of each token: a byte's value, or 256 and its merge's rank
        self.ranks: dict[int, int] = {}  # by the two tokens' numbers
        for rank, merge in enumerate(model["merges"]):
            left, right = map(raw, merge.split(" ") if isinstance(merge, str) else merge)
            self.ranks[number[left] << 24 | number[right]] = rank
            if number.setdefault(left + right, rank + 256) != rank + 256:
                raise ValueError("two merges give the same token")
        self.none = len(self.ranks)
        self.special = [t["content"] for t in definition.get("added_tokens", ()) if t["content"]]
        self.vocabulary = [raw(v) for v in model["vocab"] if v not in self.special]
        self.whole: frozenset[str] = frozenset()

    @classmethod
    def load(cls, path: str) -> WholeTokens:
        with open(path, encoding="utf-8") as f:
            definition = json.load(f)
        check_definition(definition)
        return cls(definition).prove()

    def prove(self) -> WholeTokens:
        """Keep the vocabulary strings that are text and that the merges bring to a single token."""
        found = []
        for token in self.vocabulary:
            try:
                text = token.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if self.merged(token) == 1:
                found.append(text)
        self.whole = frozenset(found)
        return self

    def merged(self, piece: bytes) -> int:
        """Number of tokens that the merges leave of one pre-token."""
        if len(piece) > 200:
            return self._merged_long(piece)
        rank, none = self.ranks.get, self.none
        parts = list(piece)
        costs = [rank(a << 24 | b, none) for a, b in pairwise(parts)]
        while costs and (best := min(costs)) < none:
            i = costs.index(best)
            parts[i : i + 2] = [best + 256]
            del costs[i]
            if i:
                costs[i - 1] = rank(parts[i - 1] << 24 | best + 256, none)
            if i < len(costs):
                costs[i] = rank(best + 256 << 24 | parts[i + 1], none)
        return len(parts)

    def _merged_long(self, piece: bytes) -> int:
        """The same with a heap and linked neighbours, for pre-tokens of any length."""
        n, rank = len(piece), self.ranks.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        part = list(piece)
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := rank(part[i] << 24 | part[i + 1])) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j < 0 or part[j] != b:
                continue
            part[i], part[j] = r + 256, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            left -= 1
            for x in (before[i], i):
                if x >= 0 and (y := after[x]) >= 0 and (r := rank(part[x] << 24 | part[y])) is not None:
                    heapq.heappush(heap, (r, x, part[x], part[y]))
        return left

    def counter(self):
        """A function from a text to its number of tokens."""
        find = regex.compile(PATTERN).findall
        apart = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))).split if self.special else None
        whole, known = self.whole, {}

        def merged(piece: str) -> int:
            n = known.get(piece)
            if n is None:
                n = self.merged(piece.encode("utf-8"))
                if len(piece) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = n
            return n

        def plain(text: str) -> int:
            pieces = find(text)
            rest = [p for p in pieces if p not in whole]
            return len(pieces) - len(rest) + sum(map(merged, rest))

        def count(text: str) -> int:
            if apart is None or not any(s in text for s in self.special):
                return plain(text)
            parts = apart(text)
            return len(parts) - 1 + sum(map(plain, parts))

        return count


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    keys: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    limit: int = 1024,
) -> DataFrame:
    """``keys``, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(WholeTokens.load(tokenizer_path))

    def make():
        count = shared.value.counter()

        def compute(texts):
            return {
                "n_bytes": [len(t) if t else 0 for t in texts],
                "n_tokens": [count(t.decode("utf-8", "replace")) if t else 0 for t in texts],
            }

        return compute

    counted = map_texts(docs, keys, text_col, make, "n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
