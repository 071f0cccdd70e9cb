"""Labelled pages for the HTML model: random layouts of an article among everything else a page carries.

Each element bears data-content="1" if its own text belongs to the article, else "0". Texts are random words; what
tells content from the rest is structure, hints and habits of text, as on the web.
"""

from __future__ import annotations

import random

SYLLABLES = "an er th in on at en re ed es ou ti or st ha le is it ar te se hi ve me al ri ro ne ta ch de ur".split()


class Writer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> list[str]:
        r = self.rng
        return ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high))]

    def prose(self, low: int, high: int) -> str:
        """Sentences, now and then with a link or emphasis."""
        r, out = self.rng, []
        for i, w in enumerate(self.words(low, high)):
            w = w.capitalize() if i == 0 or out[-1].endswith(".") else w
            out.append(w + r.choices(["", ",", "."], [10, 1, 1])[0])
        if out:
            out[-1] = out[-1].rstrip(",.") + r.choice([".", ".", ".", ""])
        if len(out) > 4 and r.random() < 0.25:
            i = r.randrange(len(out) - 2)
            tag = r.choice(['<a href="/x">{}</a>', "<b>{}</b>", "<em>{}</em>", "<strong>{}</strong>", "<span>{}</span>", '<span class="text">{}</span>'])
            out[i : i + 2] = [tag.format(" ".join(out[i : i + 2]))]
        if r.random() < 0.1:
            out.append("&amp; &quot;x&quot;")
        return " ".join(out)

    def element(self, tag: str, body: str, content: int, hint: str = "") -> str:
        r = self.rng
        named = f' {r.choice(["class", "class", "id"])}="{hint}"' if hint else ""
        end = "" if tag in ("p", "li") and r.random() < 0.08 else f"</{tag}>"
        return f'<{tag}{named} data-content="{content}">{body}{end}'

    def one(self, *choices: str) -> str:
        return self.rng.choice(choices)

    def links(self, low: int, high: int) -> str:
        r = self.rng
        items = [f'<a href="/{w}">{w}</a>' for w in self.words(low, high)]
        if r.random() < 0.7:
            return self.element(self.one("ul", "ul", "ol"), "".join(self.element("li", i, 0) for i in items), 0)
        return self.one(" | ", " ", "").join(items)

    # what surrounds an article

    def menu(self) -> str:
        hint = self.one("nav", "menu", "main-menu", "navbar", "breadcrumbs", "site-navigation", "topbar")
        return self.element("nav", self.links(3, 12), 0, self.one("", hint)) if self.rng.random() < 0.7 else self.element("div", self.links(3, 12), 0, hint)

    def header(self) -> str:
        inner = self.element(self.one("h1", "h2", "div", "p"), " ".join(self.words(1, 5)), 0) + (self.prose(2, 12) if self.rng.random() < 0.4 else "")
        inner += self.menu() if self.rng.random() < 0.5 else ""
        hint = self.one("header", "site-header", "masthead", "page-header", "banner")
        return self.element("header", inner, 0, self.one("", hint)) if self.rng.random() < 0.6 else self.element("div", inner, 0, hint)

    def footer(self) -> str:
        inner = self.one("&copy; ", "", "Copyright ", "&copy; 2024 ") + self.one("example.com &middot; ", "") + self.prose(1, 25)
        inner = self.one(inner, self.element("p", inner, 0)) + (self.links(2, 8) if self.rng.random() < 0.4 else "")
        hint = self.one("footer", "site-footer", "copyright", "bottom-bar", "page-footer", "legal")
        return self.element("footer", inner, 0, self.one("", hint)) if self.rng.random() < 0.7 else self.element("div", inner, 0, hint)

    def advert(self) -> str:
        inner = self.prose(2, 40)
        inner = self.one(inner, self.element("p", inner, 0), f'<a href="/buy">{inner}</a>', self.element("div", inner, 0))
        hint = self.one("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "ad-banner", "sponsor-box", "adsbygoogle")
        return self.element(self.one("div", "div", "div", "section", "aside", "p", "ins"), inner, 0, hint)

    def sidebar(self) -> str:
        inner = self.element(self.one("h2", "h3", "h4"), " ".join(self.words(1, 4)), 0)
        inner += self.one(self.links(3, 10), "".join(self.element("p", self.prose(3, 40), 0) for _ in range(self.rng.randint(1, 3))))
        hint = self.one("sidebar", "side-bar", "widget", "related", "related-posts", "popular-stories", "recommended", "right-rail")
        return self.element("aside", inner, 0, self.one("", hint)) if self.rng.random() < 0.6 else self.element(self.one("div", "section"), inner, 0, hint)

    def notice(self) -> str:
        inner = self.prose(4, 45)
        inner = self.one(inner, self.element("p", inner, 0)) + self.one("", self.element("button", self.one("OK", "Accept", "Close"), 0))
        hint = self.one("cookie", "cookie-notice", "cookie-banner", "consent", "gdpr", "notice", "alert", "popup", "newsletter", "subscribe-box", "modal", "paywall")
        return self.element(self.one("div", "div", "section", "dialog", "p"), inner, 0, hint)

    def form(self) -> str:
        inner = "".join(f"<label>{' '.join(self.words(1, 3))}</label> <input type='text'>" for _ in range(self.rng.randint(1, 4)))
        inner += self.one("", self.element("p", self.prose(3, 25), 0)) + self.element("button", " ".join(self.words(1, 2)), 0)
        inner += self.one("", self.element("select", "<option>" + "<option>".join(self.words(2, 5)), 0), self.element("textarea", "", 0))
        return self.element("form", inner, 0, self.one("", "", "search-form", "contact-form", "login", "signup"))

    def comments(self) -> str:
        one = lambda: self.element(
            self.one("div", "li", "article", "p", "section"),
            self.one("", self.element(self.one("h4", "div", "span", "b"), " ".join(self.words(1, 2)), 0)) + self.one(self.prose(5, 80), self.element("p", self.prose(5, 80), 0)),
            0, self.one("comment", "comment", "comment-body", "reply", ""),
        )
        inner = self.one("", self.element(self.one("h2", "h3"), "Comments", 0)) + "".join(one() for _ in range(self.rng.randint(1, 6)))
        return self.element(self.one("div", "section", "section", "ul", "ol", "aside"), inner, 0, self.one("comments", "comment-list", "comments-area", "discussion", "disqus_thread", "replies", "user-comments", "reader-comments"))

    def sharing(self) -> str:
        return self.element(self.one("div", "ul", "p"), self.links(2, 5), 0, self.one("share", "social", "share-buttons", "social-links", "post-tags", "follow-us"))

    def unseen(self) -> str:
        return self.one('<script>if (a < b) s = "<div>";</script>', "<style>.x > p { color: red }</style>", "<!-- x -->", "<noscript>no</noscript>")

    # the article

    def named(self) -> str:
        """A class for one of the article's own blocks: mostly none, or a name that says nothing, or one that misleads."""
        r = self.rng
        if r.random() < 0.8:
            return ""
        plain = "".join(self.words(1, 1))
        loose = self.one("top", "bottom", "more", "popular", "alert", "warning", "message", "reviews", "tag", "print", "rating", "caption", "credit", "trending", "meta", "hero")
        other = self.one("line", "info", "level", "item", "block", "row", plain)
        return self.one(plain, f"{plain}-{other}", f"{loose}-{other}", f"{other}-{loose}", loose)

    def block(self) -> str:
        r = self.rng
        kind = r.choices(["p", "h", "list", "quote", "pre", "table", "figure", "div", "section"], [26, 5, 3, 2, 1, 1, 1, 2, 1])[0]
        if kind == "p":
            return self.element("p", self.prose(*r.choice([(1, 12), (10, 60), (30, 150), (60, 300)])), 1, self.named())
        if kind == "h":
            return self.element(self.one("h2", "h3", "h4"), " ".join(self.words(1, 8)), 1, self.named())
        if kind == "list":
            return self.element(self.one("ul", "ol"), "".join(self.element("li", self.prose(2, 25), 1) for _ in range(r.randint(2, 6))), 1, self.named())
        if kind == "quote":
            return self.element("blockquote", self.one(self.prose(5, 50), self.element("p", self.prose(5, 50), 1)), 1)
        if kind == "pre":
            return self.element("pre", self.prose(3, 30), 1)
        if kind == "table":
            return self.element("table", "".join(self.element("tr", "".join(self.element("td", self.prose(1, 4), 1) for _ in range(3)), 1) for _ in range(3)), 1)
        if kind == "figure":
            return self.element("figure", '<img src="x">' + self.element("figcaption", self.prose(2, 15), 1), 1)
        if kind == "section":
            return self.element("section", "".join(self.block() for _ in range(r.randint(1, 3))), 1)
        return self.element("div", self.prose(8, 100), 1, self.one("", "", "paragraph", "text", "content", self.named()))

    def article(self) -> str:
        r = self.rng
        inner = [self.element(self.one("h1", "h1", "h2"), " ".join(self.words(2, 12)), 1)] if r.random() < 0.8 else []
        inner += [self.block() for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12]))]
        for extra in [e for e in (self.advert, self.advert, self.sidebar, self.sharing, self.notice, self.unseen, self.form, self.comments) if r.random() < 0.12]:
            inner.insert(r.randint(1, len(inner)), extra())
        if r.random() < 0.12:
            inner.append(self.comments())
        if r.random() < 0.12:
            inner.insert(0, self.element("header", self.element(self.one("h1", "h2", "p"), " ".join(self.words(1, 6)), 0) + self.one("", self.element("p", self.prose(2, 10), 0, self.one("", "byline", "meta"))), 0))
        if r.random() < 0.12:
            inner.append(self.element("footer", self.one(self.prose(1, 15), self.element("p", self.prose(1, 15), 0)), 0))
        body = self.one("", "\n").join(inner)
        if r.random() < 0.55:
            body = self.element("article", body, 1, self.one("", "", "", "post", "entry", "story"))
        elif r.random() < 0.85:
            body = self.element(self.one("div", "section"), body, 1, self.one("content", "article", "post", "entry-content", "article-body", "story", "main-content", "post-body", "main", "text"))
        elif r.random() < 0.5:
            body = self.element("div", body, 1, self.one("", "wrap", "c1", "col"))
        if r.random() < 0.3:
            body = self.element("main", body, 1, self.one("", "", "main", "content"))
        return body

    def page(self) -> str:
        r = self.rng
        if r.random() < 0.08:  # hardly a page: bare text, a few blocks, or both
            bare = lambda: self.one(self.prose(1, 80), " ".join(self.words(1, 8)), " &lt; ".join(self.words(2, 4)))
            few = [self.block() if r.random() < 0.5 else self.element(self.one("p", "div"), " ".join(self.words(1, 4)), 1) for _ in range(r.randint(1, 4))]
            return self.one(f'<html data-content="1">{bare()}</html>', "".join(few), f'<html data-content="1">{self.one("", bare())}{"".join(few)}{bare()}')
        above = [f() for f in (self.notice, self.header, self.menu, self.advert, self.form) if r.random() < 0.4]
        below = [f() for f in (self.comments, self.sidebar, self.sharing, self.advert, self.form, self.notice) if r.random() < 0.3]
        r.shuffle(above)
        r.shuffle(below)
        side = [self.sidebar()] if r.random() < 0.2 else []
        middle = side + [self.article()]
        r.shuffle(middle)
        parts = [*above, *middle, *below] + ([self.footer()] if r.random() < 0.8 else [])
        if r.random() < 0.35:
            a = r.randint(0, len(above))
            parts[a:-1] = [self.element("div", "".join(parts[a:-1]), 0, self.one("", "wrapper", "container", "page", "site", "layout"))]
        if r.random() < 0.5:
            parts.insert(r.randint(0, len(parts)), self.unseen())
        head = f"<head><meta charset='utf-8'><title>{' '.join(self.words(2, 8))}</title>{self.unseen()}</head>"
        return f'<!DOCTYPE html><html lang="en">{head}<body>{self.one("", chr(10)).join(parts)}' + self.one("</body></html>", "</body></html>", "")


def labelled_pages(n: int, seed: int) -> list[str]:
    """``n`` pages laid out from a seed."""
    writer = Writer(seed)
    return [writer.page() for _ in range(n)]
