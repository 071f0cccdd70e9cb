"""HTML extraction with a tree-structured graphical model over the DOM.

Nodes are a page's block elements (and inline elements whose class or id says what they are); each is content
or not. A node's own evidence (tag, hints in class, id and role, text, links) and a potential for each
parent-child edge, by the kind of child, give a Markov field on the tree. Sum-product messages up and down
yield every node's content marginal exactly; text counts as content where the marginal of its node exceeds 1/2.
Messages of all pages of a batch run together, level by level.

Weights and potentials are learned by maximum likelihood (gradients from the same messages) from labelled pages
that ``html_pages`` lays out at random: ``PAGES`` pages, a documented and fixed bound. Fitting takes some 20 seconds on the
driver, once a process.

Scripts, styles, comments and other text that no page shows never become nodes. Character references are decoded;
white space becomes one space; blocks are joined by one space in page order; nothing else is dropped.

Defined results: a null or empty page has the empty text. Whole pages are used, however long. Repeated rows are
extracted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cache, lru_cache
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import html_pages
from corvane.llm.common import chunks_by_bytes, map_texts

PAGES = 1200
SEED = 6
ROUNDS = 300
CHUNK = 8 << 20

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|noscript|template|svg|iframe|object|canvas|math)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
NAMED = re.compile(r"""(?<![\w-])(class|id|role|style|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![\w-])(hidden)(?![\w=-])""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr"), "th": ("td th", "tr"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}

#: Words in class, id or role, by what they hint at. Short ones must stand alone; the rest may be parts of words.
#: Weak ones stand on articles' own blocks as well (top-story, bottom-line, more-info), so they never make an edge's kind.
HINTS = {
    "menu": "nav menu breadcrumb toolbar tabs pagination pager sitemap skip navigation topbar",
    "head": "header masthead banner logo branding",
    "foot": "footer copyright colophon legal imprint contentinfo",
    "side": "sidebar aside widget related recommend rail complementary outbrain taboola teaser",
    "ad": "ad ads adv advert advertisement sponsor sponsored promo promoted promotion adsense adsby adslot adunit commercial dfp partner affiliate",
    "notice": "notice cookie cookies consent gdpr alertdialog popup modal overlay toast newsletter subscribe paywall disclaimer notification",
    "talk": "comment comments reply replies discussion disqus respond",
    "form": "form search login signup signin register contact poll survey captcha button btn",
    "share": "share sharing social follow byline author",
    "weak": "top bottom hero popular trending more alert warning message reviews feedback thread meta tags tag tools print rating caption credit",
    "good": "article content post entry story main body text prose page news blog paragraph",
}
SHORT = frozenset("nav top more ad ads adv dfp form btn meta tag tags body text page main post talk tools print tabs pager logo skip hero side rail".split())
LONG = {h: re.compile("|".join(w for w in words.split() if w not in SHORT)) for h, words in HINTS.items()}
ALONE = {h: frozenset(words.split()) for h, words in HINTS.items()}
TAGS = "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th blockquote pre figure figcaption nav header footer aside form fieldset button select textarea address details summary dialog menu hr inline head other".split()
BAD_TAGS = frozenset("nav header footer aside form fieldset button select textarea address dialog menu head".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tr td th figure figcaption".split())
NAMES = [f"tag {t}" for t in TAGS] + [f"hint {h}" for h in HINTS] + ["hidden"]
NAMES += [f"own {k}" for k in range(6)] + [f"links {k}" for k in range(4)] + [f"all {k}" for k in range(6)] + [f"all links {k}" for k in range(4)]
NAMES += [f"sentences {k}" for k in range(3)] + [f"paragraphs {k}" for k in range(4)] + ["copyright", "bias", "alone", "plain", "under bad", "under good", "clean good", "own bad"]
AT = {name: i for i, name in enumerate(NAMES)}
KINDS = 16  # of edges: 4 kinds of parent (bad hint or tag, good hint or tag, text element, other) by 4 kinds of child


@lru_cache(maxsize=1 << 15)
def _hints(attributes: str) -> tuple[tuple[str, ...], bool]:
    """(hints, hidden) of a tag's attributes."""
    found, hidden, words = [], False, ""
    for name, a, b, c, bare in NAMED.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if bare or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            hidden = True
        elif name in ("class", "id", "role"):
            words += " " + value
    if words:
        alone, joined = frozenset(re.split(r"[^a-z]+", words)), re.sub("[-_]", "", words)
        found = [h for h in HINTS if alone & ALONE[h] or LONG[h].search(joined)]
    return tuple(found), hidden


class Page:
    """Nodes of one page in page order, and its text pieces (node, or -1 for a block's edge; text)."""

    __slots__ = ("parent", "depth", "tag", "attributes", "pieces", "linked", "own")

    def __init__(self, html: str):
        self.parent, self.depth, self.tag, self.attributes = [-1], [0], ["html"], [""]
        self.pieces: list[tuple[int, str]] = []
        self.own, self.linked = [0], [0]
        stack: list[tuple[str, int, bool]] = [("html", 0, True)]  # tag, nearest node, whether a block
        links, at = 0, 0
        for m in TOKEN.finditer(html):
            if m.start() > at:
                self._text(html[at : m.start()], stack[-1][1], links)
            at = m.end()
            name = m[3] or m[6]
            if not name:
                continue
            name = name.lower()
            if m[2] or m[5]:  # an end tag
                links -= self._close(name, stack)
                links = max(links, 0)
                if name == "p":  # even without a start tag it stands for a paragraph
                    self.pieces.append((-1, ""))
                continue
            if name in VOID:
                if name in ("br", "hr"):
                    self.pieces.append((-1, ""))
                continue
            attributes = m[4] if m[3] else m[7]
            inline = name in INLINE
            if not inline:
                if name in CLOSES_P:
                    links -= self._imply(("p",), None, stack)
                elif name in CLOSES:
                    links -= self._imply(*CLOSES[name], stack)
                links = max(links, 0)
            node = stack[-1][1]
            if not inline or (attributes and any(h not in ("good", "share", "weak") for h in _hints(attributes)[0])):
                if name == "html" and node == 0:
                    self.attributes[0] = attributes
                else:
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                    self.tag.append("inline" if inline else name)
                    self.attributes.append(attributes)
                    self.own.append(0)
                    self.linked.append(0)
                    node = len(self.parent) - 1
            links += name == "a"
            if not inline:
                self.pieces.append((-1, ""))
            stack.append((name, node, not inline))
        if at < len(html):
            self._text(html[at:], stack[-1][1], links)

    def _text(self, text: str, node: int, links: int) -> None:
        if "&" in text:
            text = unescape(text)
        self.pieces.append((node, text))
        if n := len(text.strip()):
            self.own[node] += n
            self.linked[node] += n if links else 0

    def _close(self, name: str, stack: list) -> int:
        """Close the nearest open element of this name; an inline end tag does not reach out of its block."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == name:
                return self._pop(i, stack)
            if stack[i][2] and (name in INLINE or (name == "p" and stack[i][0] not in CLOSES_P)):
                break
        return 0

    def _imply(self, names, within, stack: list) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return self._pop(i, stack)
            if within is None and stack[i][2] or within is not None and stack[i][0] in within:
                break
        return 0

    def _pop(self, i: int, stack: list) -> int:
        """Leave elements from i on; returns how many links that closes."""
        gone = stack[i:]
        del stack[i:]
        if any(block for _, _, block in gone):
            self.pieces.append((-1, ""))
        return sum(name == "a" for name, _, _ in gone)

    def text(self, content: np.ndarray) -> str:
        """The text of the content nodes."""
        return " ".join("".join(" " if n < 0 else t for n, t in self.pieces if n < 0 or content[n]).split())


class Forest:
    """All nodes of several pages: parents, levels, features and kinds of edges."""

    def __init__(self, pages: Sequence[Page]):
        sizes = [len(p.parent) for p in pages]
        self.first = np.cumsum([0, *sizes])
        base = np.repeat(self.first[:-1], sizes)
        flat = lambda name: np.fromiter((x for p in pages for x in getattr(p, name)), np.int64, int(self.first[-1]))
        parent = flat("parent")
        self.parent = np.where(parent < 0, -1, parent + base)
        self.depth, own, linked = flat("depth"), flat("own"), flat("linked")
        n = len(parent)
        by_level = np.argsort(self.depth, kind="stable")
        ends = np.cumsum(np.bincount(self.depth)) if n else []
        self.levels = [by_level[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        tags = [t for p in pages for t in p.tag]
        attributes = [a for p in pages for a in p.attributes]
        every, all_links, paragraphs = own.copy(), linked.copy(), np.fromiter((t == "p" for t in tags), np.int64, n)
        for level in self.levels[:0:-1]:
            for x in (every, all_links, paragraphs):
                np.add.at(x, self.parent[level], x[level])
        share = lambda a, b: np.where(b > 0, np.minimum(3, (4 * a) // np.maximum(b, 1)), 0)
        bins = lambda x: np.searchsorted([1, 20, 60, 160, 500], x, "right")
        marks, copied = np.zeros(n, np.int64), np.zeros(n, bool)
        for p, start in zip(pages, self.first.tolist(), strict=False):
            for node, text in p.pieces:
                if node >= 0:
                    marks[start + node] += text.count(". ") + text.count(", ") + text.rstrip().endswith(".")
                    if "\xa9" in text:
                        copied[start + node] = True
        node, feature = [], []
        kind = np.full(n, 3, np.int64)
        for i, (tag, attribute) in enumerate(zip(tags, attributes, strict=True)):
            hints, hidden = _hints(attribute) if attribute else ((), False)
            feature.append(AT.get(f"tag {tag}", AT["tag other"]))
            node.append(i)
            for h in hints:
                feature.append(AT[f"hint {h}"])
                node.append(i)
            if hidden:
                feature.append(AT["hidden"])
                node.append(i)
            good = "good" in hints or tag in ("article", "main")
            bad = hidden or tag in BAD_TAGS or any(h not in ("good", "weak") for h in hints)
            kind[i] = 0 if bad else 1 if good else 2 if tag in TEXT_TAGS else 3
        self.kind = np.where(self.parent >= 0, 4 * kind[self.parent] + kind, kind)
        bad, good = kind == 0, kind == 1
        under_bad, under_good = np.zeros(n, bool), np.zeros(n, bool)
        for level in self.levels[1:]:
            up = self.parent[level]
            under_bad[level] = under_bad[up] | bad[up]
            under_good[level] = (under_good[up] | good[up]) & ~bad[up]
        alone = np.repeat(np.array(sizes) == 1, sizes)
        marked = (good | bad) & np.fromiter((t != "head" for t in tags), bool, n)
        plain = np.repeat(np.add.reduceat(marked, self.first[:-1]) == 0, sizes) if n else marked  # a page that says nothing of its parts
        everywhere = np.arange(n)
        some = np.flatnonzero(copied)
        parts = [
            (everywhere, AT["own 0"] + bins(own)), (everywhere, AT["links 0"] + share(linked, own)), (everywhere, AT["all 0"] + bins(every)),
            (everywhere, AT["all links 0"] + share(all_links, every)), (everywhere, AT["sentences 0"] + np.minimum(marks, 2)),
            (everywhere, AT["paragraphs 0"] + np.minimum(paragraphs, 3)), (some, np.full(len(some), AT["copyright"])), (everywhere, np.full(n, AT["bias"])),
        ]
        for name, flag in (("alone", alone), ("plain", plain), ("under bad", under_bad), ("under good", under_good & ~under_bad), ("clean good", good & ~under_bad), ("own bad", bad)):
            at = np.flatnonzero(flag)
            parts.append((at, np.full(len(at), AT[name])))
        self.node = np.concatenate([np.array(node, np.int64), *[a for a, _ in parts]])
        self.feature = np.concatenate([np.array(feature, np.int64), *[b for _, b in parts]])
        self.n = n

    def messages(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product up and down: (content marginal of each node, joint of parent and child for each node)."""
        belief = np.zeros((self.n, 2))
        belief[:, 1] = np.bincount(self.node, weights=weights[self.feature], minlength=self.n)
        up, pair = np.zeros((self.n, 2)), edges[self.kind]  # pair[node, parent's state, own state]
        for level in self.levels[:0:-1]:
            up[level] = np.logaddexp.reduce(pair[level] + belief[level][:, None, :], axis=2)
            np.add.at(belief, self.parent[level], up[level])
        joint = np.zeros((self.n, 2, 2))
        full = belief.copy()
        for level in self.levels[1:]:
            rest = full[self.parent[level]] - up[level]  # the parent without this child
            both = rest[:, :, None] + pair[level] + belief[level][:, None, :]
            total = np.logaddexp.reduce(both.reshape(-1, 4), axis=1)
            joint[level] = np.exp(both - total[:, None, None])
            full[level] = np.logaddexp.reduce(both, axis=1)
        return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -500, 500))), joint


def fit(forest: Forest, labels: np.ndarray, rounds: int = ROUNDS, decay: float = 0.002) -> tuple[np.ndarray, np.ndarray]:
    """Weights and edge potentials of the greatest penalised likelihood, by Adam on exact gradients."""
    size, n = len(NAMES), forest.n
    x = np.zeros(size + KINDS * 4)
    m, v = np.zeros_like(x), np.zeros_like(x)
    child = np.flatnonzero(forest.parent >= 0)
    place = forest.kind[child] * 4 + labels[forest.parent[child]] * 2 + labels[child]
    seen = np.bincount(place, minlength=KINDS * 4)
    for t in range(1, rounds + 1):
        p, joint = forest.messages(x[:size], x[size:].reshape(KINDS, 2, 2))
        own = np.bincount(forest.feature, weights=(labels - p)[forest.node], minlength=size)
        expected = np.stack([joint[child[forest.kind[child] == k]].sum(axis=0).ravel() for k in range(KINDS)]).ravel()
        gradient = np.concatenate([own, seen - expected]) / n * 20 - decay * x
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        x += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x[:size], x[size:].reshape(KINDS, 2, 2)


LABEL = re.compile(r'\s*data-content="([01])"')


def labelled(pages: Sequence[str]) -> tuple[list[Page], np.ndarray]:
    """Parsed pages and the labels that their data-content attributes give, which are then gone from the pages."""
    out, labels = [], []
    for html in pages:
        page = Page(html)
        for i, a in enumerate(page.attributes):
            mark = LABEL.search(a)
            labels.append(int(mark[1]) if mark else 0)
            page.attributes[i] = LABEL.sub("", a)
        out.append(page)
    return out, np.array(labels, np.int64)


@cache
def trained(pages: int = PAGES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The model learned from ``pages`` generated pages."""
    parsed, labels = labelled(html_pages.labelled_pages(pages, seed))
    return fit(Forest(parsed), labels)


def extract(pages: Sequence[str], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The main text of each page."""
    parsed = [Page(h) for h in pages]
    if not parsed:
        return []
    forest = Forest(parsed)
    marginal, _ = forest.messages(*model)
    return [p.text(marginal[a:b] > 0.5) for p, a, b in zip(parsed, forest.first[:-1].tolist(), forest.first[1:].tolist(), strict=True)]


def extract_pages(pages: DataFrame, keys: Sequence[str] = ("page_id", "url"), html_col: str = "html", training_pages: int = PAGES, seed: int = SEED) -> DataFrame:
    """``keys``, text and n_chars (its code points) per row. The model, a few hundred numbers, goes with the tasks."""
    model = trained(training_pages, seed)

    def make():
        def compute(texts):
            out = []
            for a, b in chunks_by_bytes(texts, CHUNK):
                out += extract([t.decode("utf-8", "replace") if t else "" for t in texts[a:b]], model)
            return {"text": out}

        return compute

    return map_texts(pages, keys, html_col, make, "text string").withColumn("n_chars", F.length("text").cast("long"))
