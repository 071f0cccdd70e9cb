"""Plain restatements of the contracts, for tests."""

import hashlib
from collections import Counter
from itertools import combinations

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split(text, separators=SPACE):
    out, word = [], ""
    for c in (text or "") + separators[0]:
        if c in separators:
            out += [word] * bool(word)
            word = ""
        else:
            word += c
    return out


def item_words(text):
    out, word = [], ""
    for c in lower(text or "") + " ":
        if c.isascii() and not ("0" <= c <= "9" or "a" <= c <= "z"):
            out += [word] * bool(word)
            word = ""
        else:
            word += c
    return out


def contamination(docs, items, window=13):
    """docs: (id, text); items: (id, text)."""
    windows = {}
    for item, text in items:
        w = item_words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = item_words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (key := tuple(w[i : i + k])) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[key]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def repeated_words(words, n):
    """Places covered by n-word windows that occur twice or more."""
    count = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return {j for i in range(len(words) - n + 1) if count[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}


def quality(text, limits, min_words=50, symbols=0.2, lines=0.15):
    text = text or ""
    w = split(text)
    seen, dup, dup_chars, chars = set(), 0, 0, 0
    for line in text.split("\n"):
        if split(line):
            size = len(line.encode())
            chars += size
            dup += line in seen
            dup_chars += size * (line in seen)
            seen.add(line)
    n, word_chars, n_symbols, repeat = len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(repeated_words(w, 3))
    base = n < min_words or 100 * repeat > 50 * n
    cover = {k: sum(len(w[i]) for i in repeated_words(w, k)) for k in limits}
    bad = n_symbols > symbols * n or dup_chars > lines * chars or any(cover[k] > x * word_chars for k, x in limits.items())
    return n, word_chars, n_symbols, dup, repeat, base, not (base or bad), cover


def shingle_set(text, k=5):
    words = split(lower(text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard_components(texts, ids):
    """id: smallest id reachable over pairs whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more."""
    sets, parent = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a == b or 5 * len(a & b) >= 4 * len(a | b):
            parent[find(j)] = find(i)
    groups = {}
    for i in range(len(texts)):
        groups.setdefault(find(i), []).append(ids[i])
    return {ids[i]: min(groups[find(i)]) for i in range(len(texts))}
