"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

Every block has features of its ancestors' tags and names, of its own tag and its text, and of the page's layout: which
element holds most of the prose and where the block stands to it, how long, how linked and how alike the blocks of its
element are. The chain has two labels, main text and the rest. The weights are fitted by stochastic gradients of the
likelihood on labelled pages and decoded by Viterbi. ``labelled_pages`` makes such pages from a rule: layouts of the usual
parts, named in English, in words of no known language, by codes, or not at all, with texts of invented words, so that a
model needs no files; pages labelled by hand can be given instead.

Defined results: a null or empty page, or one without main blocks, has an empty text. Repeated rows are decoded alike; other
columns are untouched. A page's blocks are held by one task; pages are not.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .html_blocks import Block, blocks

#: Pages that the default model is fitted on, passes over them, and the seed of both.
PAGES, EPOCHS, SEED = 600, 6, 11
#: The share of pages that are nothing but a text.
LONE = 0.08

# Words of class, id and role attributes by the kind of part they name.
KINDS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs topbar toolbar tabs pagination pager skip toc",
    "header": "header masthead branding logo topnav hero",
    "footer": "footer colophon copyright legal imprint bottom contentinfo",
    "side": "sidebar aside side rail widget widgets related recommended popular trending complementary more teaser",
    "notice": "notice cookie cookies consent gdpr alert banner popup modal overlay announcement message warning toast",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion affiliate adsense dfp",
    "form": "form login signin signup search newsletter subscribe subscription register contact",
    "social": "share sharing social follow like tweet buttons",
    "comment": "comment comments reply replies discussion disqus respond responses commentlist reader feedback",
    "main": "article content main post entry story body text copy prose page",
}
KIND_OF = {word: kind for kind, words in KINDS.items() for word in words.split()}
PHRASES = {
    "menu": ("Home", "About us", "Contact", "Products", "Sitemap", "Next page", "Skip to content", "Archive"),
    "header": ("Daily Post", "Your trusted source", "My site", "Latest news", "Welcome"),
    "footer": ("© 2024 All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "Powered by our press"),
    "side": ("Related articles", "Most read", "You may also like", "Popular posts", "Tags", "Recent posts"),
    "notice": ("We use cookies to improve your visit.", "Accept all", "This site uses cookies.", "Please enable scripts."),
    "advert": ("Advertisement", "Sponsored", "Buy now and save 20%!", "Limited offer", "Shop the sale"),
    "form": ("Email address", "Sign up for our newsletter", "Search", "Log in", "Password", "Submit", "Subscribe"),
    "social": ("Share", "Tweet", "Follow us", "Share on social media", "Print", "Like"),
    "comment": ("3 comments", "Leave a reply", "Reply", "Anonymous says:", "Posted 2 hours ago", "Great article, thanks!"),
}
WORDS_OF_REST = frozenset(w.strip(".,:!").lower() for texts in PHRASES.values() for t in texts for w in t.split())


def bucket(value: float, edges: Sequence[float]) -> int:
    return sum(value > e for e in edges)


def layout(page: Sequence[Block]) -> list[list[str]]:
    """Features of where each block stands: none of them reads a name or a word."""
    words = [b.text.count(" ") + 1 for b in page]
    linked = [b.linked / max(1, len(b.text)) for b in page]
    prose = [w >= 8 and x < 0.3 for w, x in zip(words, linked)]
    mass: dict[int, float] = {}
    held: dict[int, list[int]] = {}  # blocks right under an element
    inner: dict[int, set[int]] = {}  # elements right under it that hold blocks
    for i, b in enumerate(page):
        for depth, number in enumerate(b.near):
            if prose[i]:
                mass[number] = mass.get(number, 0.0) + len(b.text) / 2**depth
        if b.near:
            held.setdefault(b.near[0], []).append(i)
            if len(b.near) > 1:
                inner.setdefault(b.near[1], set()).add(b.near[0])
    total = sum(len(b.text) for b, p in zip(page, prose) if p)
    best = max(mass, key=mass.get, default=-1)  # the first of equal ones
    within = [b.near.index(best) if best in b.near else -1 for b in page]
    inside = [i for i, k in enumerate(within) if k == 0] or [-1]
    stats = {}
    for number, members in held.items():
        n = len(members)
        stats[number] = (
            bucket(n, (1, 2, 4, 9)), bucket(sum(words[i] for i in members) / n, (2, 4, 8, 20)),
            bucket(sum(linked[i] for i in members) / n, (0.05, 0.3, 0.7)), bucket(sum(prose[i] for i in members), (0, 1, 3)),
        )
    rows = []
    for i, b in enumerate(page):
        side = "before" if i < inside[0] else "after" if i > inside[-1] else "amid"
        own, outer = b.near[0] if b.near else -1, b.near[1] if len(b.near) > 1 else -1
        n, length, links, full = stats.get(own, (0, 0, 0, 0))
        groups = bucket(len(inner.get(outer, ())), (1, 2, 4))
        size, link = bucket(words[i], (3, 8, 20)), bucket(linked[i], (0.0, 0.5))
        share = bucket(mass.get(own, 0.0) / max(1, total), (0.0, 0.1, 0.4))
        digits = bucket(sum(map(str.isdigit, b.text)) / len(b.text), (0.0, 0.15))
        near = "in" if within[i] == 0 else "below" if within[i] > 0 else "out"
        rows.append([
            f"best {within[i]}", f"side {side}", f"{near} {side}", f"{near} size {size} links {link}", f"parent {b.parent if b.parent in TAGS else 'other'} {near}",
            f"group length {length} links {links}", f"group prose {full} {near}", f"groups {groups} of {n} {near}", f"groups {groups} {side} size {size}",
            f"share {share} {near}", f"digits {digits} size {size}", f"own {b.tag if b.tag in TAGS else 'other'} {near}",
            "no prose" if total == 0 else "some prose", f"blocks {bucket(len(page), (1, 3))} {near} size {size} links {link}",
        ])
    return rows


def block_features(page: Sequence[Block]) -> list[list[str]]:
    rows, n = layout(page), len(page)
    seen_title = False
    for i, b in enumerate(page):
        words = b.text.split()
        linked = b.linked / max(1, len(b.text))
        marks = sum(b.text.count(c) for c in ",;:")
        known = sum(w.strip(".,:!").lower() in WORDS_OF_REST for w in words) / max(1, len(words))
        size = bucket(len(words), (2, 5, 10, 20, 40))
        kinds = {KIND_OF[w] for w in b.names if w in KIND_OF}
        rest = kinds - {"main"}
        row = rows[i]
        row += [f"own {b.tag}", f"words {size}", f"links {bucket(linked, (0.0, 0.3, 0.7))}", f"marks {bucket(marks, (0, 2))}"]
        row += [f"in {t}" for t in b.tags if t in TAGS] + [f"kind {k}" for k in kinds]
        row += [f"known {bucket(known, (0.0, 0.3, 0.6))}", f"place {bucket(i / n, (0.1, 0.3, 0.7, 0.9))}"]
        row += ["kind rest" if rest else "kind none", "stop" if b.text[-1] in ".!?…" else "no stop"]
        row += [f"size {size} links {bucket(linked, (0.0, 0.7))}"]
        row += ["after title" if seen_title else "before title"]
        row += ["copyright"] if "©" in b.text else []
        row += ["hidden"] if b.hidden else []
        if n <= 2 + seen_title:  # hardly a block competes
            row += [f"alone {'named' if rest or b.tags & REST_TAGS else 'linked' if linked > 0.7 else 'plain'}"]
        if "article" in b.tags or "main" in b.tags:
            row += ["main and rest" if rest or b.tags & REST_TAGS else "main alone"]
        elif not rest and not b.tags & REST_TAGS:
            row += [f"free size {size}"]
        seen_title = seen_title or b.tag == "h1"
    return rows


TAGS = frozenset(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header label li main nav ol p pre section select table td th tr ul".split()
)
REST_TAGS = frozenset("address aside button dialog fieldset footer form header label nav select".split())


@dataclass(frozen=True)
class Crf:
    """Weights of the features for the label main (the rest has none), and of pairs of labels; index 2 is the start."""

    weights: dict[str, float]
    pairs: tuple[tuple[float, float], ...]

    def scores(self, rows: Iterable[Sequence[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in row) for row in rows]

    def decode(self, page: Sequence[Block]) -> list[bool]:
        """Viterbi: the labels of the best path; on a tie the rest."""
        if not page:
            return []
        back: list[tuple[int, int]] = []
        emitted = self.scores(block_features(page))
        best = [self.pairs[2][0], self.pairs[2][1] + emitted[0]]
        for e in emitted[1:]:
            came = tuple(int(best[1] + self.pairs[1][y] > best[0] + self.pairs[0][y]) for y in (0, 1))
            back.append(came)
            best = [best[came[0]] + self.pairs[came[0]][0], best[came[1]] + self.pairs[came[1]][1] + e]
        label = int(best[1] > best[0])
        labels = [label]
        for came in reversed(back):
            label = came[label]
            labels.append(label)
        return [bool(x) for x in reversed(labels)]


def likelihood(emitted: np.ndarray, pairs: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The negative log-likelihood of ``labels``, and its slopes in each block's score and in the pairs' weights."""
    (p00, p01), (p10, p11), (s0, s1) = pairs.tolist()
    scores = emitted.tolist()
    exp, log1p = math.exp, math.log1p

    def both(x: float, y: float) -> float:
        return x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y))

    # two labels: plain numbers are faster here than arrays of two
    f0, f1, b0, b1 = [s0], [s1 + scores[0]], [0.0], [0.0]
    for e in scores[1:]:
        x, y = f0[-1], f1[-1]
        f0.append(both(x + p00, y + p10))
        f1.append(both(x + p01, y + p11) + e)
    for e in reversed(scores[1:]):
        x, y = b0[-1], b1[-1] + e
        b0.append(both(x + p00, y + p01))
        b1.append(both(x + p10, y + p11))
    forward, backward = np.array([f0, f1]).T, np.array([b0[::-1], b1[::-1]]).T
    total = np.logaddexp(*(forward[-1]))
    p = np.exp(forward + backward - total)
    # slopes: what is expected less what is there
    change = np.zeros((3, 2))
    change[2] = p[0]
    change[2, labels[0]] -= 1
    score = pairs[2, labels[0]] + emitted[labels == 1].sum() + pairs[labels[:-1], labels[1:]].sum()
    into = backward[1:] + np.stack([np.zeros(len(emitted) - 1), emitted[1:]], axis=1)
    change[:2] += np.exp(forward[:-1, :, None] + pairs[:2] + into[:, None, :] - total).sum(axis=0)
    np.subtract.at(change, (labels[:-1], labels[1:]), 1)
    return float(total - score), p[:, 1] - labels, change


def train(pages: Iterable[tuple[str, Sequence[bool]]], epochs: int = EPOCHS, seed: int = SEED, ridge: float = 1e-4) -> Crf:
    """Fits a model to (html, a label for each of its blocks) by Adagrad on the negative log-likelihood."""
    data, index = [], {}
    for html, labels in pages:
        rows = block_features(blocks(html))
        if len(rows) != len(labels):
            raise ValueError("a page needs a label for each of its blocks")
        if rows:
            data.append(([np.array([index.setdefault(f, len(index)) for f in row]) for row in rows], np.array(labels, int)))
    w, pairs = np.zeros(len(index)), np.zeros((3, 2))
    sum_w, sum_pairs = np.full(len(index), 1e-2), np.full((3, 2), 1e-2)
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(data)
        for rows, labels in data:
            emitted = np.array([w[row].sum() for row in rows])
            _, by_block, change = likelihood(emitted, pairs, labels)
            touched = np.concatenate(rows)
            g = np.zeros(len(index))
            np.add.at(g, touched, np.repeat(by_block, [len(r) for r in rows]))
            where = np.unique(touched)
            g[where] += ridge * w[where]
            sum_w[where] += g[where] ** 2
            w[where] -= 0.3 * g[where] / np.sqrt(sum_w[where])
            sum_pairs += change**2
            pairs -= 0.3 * change / np.sqrt(sum_pairs)
    return Crf({f: float(w[i]) for f, i in index.items()}, tuple(tuple(map(float, row)) for row in pairs))


class Pages:
    """A maker of labelled pages: see the module's text. ``names`` and ``phrases`` can be others than those of the features."""

    def __init__(self, seed: int, names: dict[str, str] | None = None, phrases: dict[str, Sequence[str]] | None = None):
        self.r = random.Random(seed)
        self.names, self.phrases = names or KINDS, PHRASES if phrases is None else phrases
        self.sounds = "a e i o u ba de ki lo mu ra se ti vo na the and ing er on st".split()

    def word(self) -> str:
        return "".join(self.r.choice(self.sounds) for _ in range(self.r.randint(1, 4)))

    def sentence(self, k: int) -> str:
        text = " ".join(self.word() + ("," if self.r.random() < 0.1 else "") for _ in range(k)).capitalize()
        return text + self.r.choice(["."] * 8 + ["!", "?", ""])

    def prose(self, most: int = 20) -> str:
        return " ".join(self.sentence(self.r.randint(4, 14)) for _ in range(min(most, self.r.choice((1, 1, 2, 3, 5, 8, 20)))))

    def title(self, k: int = 4) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(1, k))).capitalize()

    def phrase(self, kind: str) -> str:
        known = self.phrases.get(kind)
        return self.r.choice(known) if known and self.r.random() < 0.5 else self.title()

    def attribute(self, kind: str, style: str) -> str:
        r = self.r
        if style == "none" or r.random() < 0.1:
            return ""
        word = r.choice(self.names[kind].split()) if style == "known" else self.word() if style == "foreign" else f"x{r.randrange(10**6):x}"
        return f' {r.choice(("class", "class", "id"))}="{r.choice(("", "", "site-", "page-", "my_"))}{word}{r.choice(("", "-box", "-inner", " clear"))}"'

    def part(self, kind: str, style: str, tags: bool) -> tuple[str, list[bool]]:
        """A part of the rest; a tag says what it is (only if ``tags``), a name, or the layout alone."""
        r = self.r
        tag = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form", "notice": "dialog"}.get(kind)
        outer = tag if tag and tags and r.random() < 0.7 else r.choice(("div", "div", "div", "section", "td"))
        link = lambda t: f'<a href="/{self.word()}">{t}</a>'
        if kind in ("header", "footer", "notice", "advert") and r.random() < 0.35:
            # one text right in the element
            text = self.prose(2) if r.random() < 0.6 else self.phrase(kind)
            text = r.choice(("", "", "© ", f"{self.word()}.example · ")) + text if kind == "footer" else text
            outer = "div" if outer == "td" else outer
            return f"<{outer}{self.attribute(kind, style)}>{link(text) if r.random() < 0.2 else text}</{outer}>", [False]
        items: list[str] = []  # each is one block
        wrap = "{}"
        if kind == "menu":
            items = [link(self.phrase(kind)) for _ in range(r.randint(3, 9))]
            inner, wrap = r.choice((("li", "<ul>{}</ul>"), ("li", "<ul>{}</ul>"), ("div", "{}"), ("td", "<table><tr>{}</tr></table>")))
            if r.random() < 0.15:
                items, inner = [" | ".join(items)], "p"
        elif kind in ("side", "footer"):
            items = [link(self.phrase(kind)) if r.random() < 0.75 else self.phrase(kind) for _ in range(r.randint(2, 7))]
            if kind == "footer" or r.random() < 0.3:
                items.append(self.prose(1) if r.random() < 0.5 else self.phrase(kind))
            if kind == "side" and r.random() < 0.4:  # teasers
                items = [x for _ in range(r.randint(2, 5)) for x in (link(self.title(6)), self.sentence(r.randint(4, 12)))]
            inner, wrap = r.choice((("li", "<ul>{}</ul>"), ("p", "{}"), ("div", "{}")))
        elif kind == "header":
            items = [link(self.title(3)), self.sentence(r.randint(1, 6))][: r.randint(1, 2)]
            inner = r.choice(("div", "p", "h2", "span"))
        elif kind == "notice":
            items = [self.prose(2) if r.random() < 0.7 else self.phrase(kind)]
            buttons = [self.phrase(kind) for _ in range(r.randint(0, 3))]
            items += buttons
            inner = r.choice(("p", "div"))
        elif kind == "form":
            items, inner = [self.phrase(kind) for _ in range(r.randint(1, 4))], r.choice(("label", "div", "p", "button"))
            if inner in ("label",):
                inner = "div"
        elif kind == "comment":
            items = [self.phrase(kind)] if r.random() < 0.6 else []
            groups = []
            for _ in range(r.randint(1, 6)):
                bits = [self.title(2), f"{r.randint(1, 30)}.{r.randint(1, 12)}.20{r.randint(10, 29)} {r.randint(0, 23)}:{r.randint(10, 59)}"][: r.randint(1, 2)]
                bits = [*bits, *(self.prose(3) for _ in range(r.randint(1, 2))), *([link(self.title(1))] if r.random() < 0.4 else [])]
                groups.append(bits)
            if style == "none" and len(groups) < 2:
                groups.append(groups[0])
            inner, each = r.choice(("div", "p")), r.choice(("li", "li", "div", "section"))
            body = "".join(f"<{each}>" + "".join(f"<{inner}>{x}</{inner}>" for x in g) + f"</{each}>" for g in groups)
            body = f"<{r.choice(('ol', 'ul'))}>{body}</ol>" if each == "li" else body
            body = body.replace("</ol>", "</ul>") if body.startswith("<ul>") else body
            head = "".join(f"<h3>{x}</h3>" for x in items)
            outer = "div" if outer == "td" else outer
            return f"<{outer}{self.attribute(kind, style)}>{head}{body}</{outer}>", [False] * (len(items) + sum(map(len, groups)))
        else:
            items = [link(self.phrase(kind)) if r.random() < 0.5 else self.phrase(kind) for _ in range(r.randint(1, 4))]
            inner = r.choice(("p", "div", "li"))
            wrap = "<ul>{}</ul>" if inner == "li" else "{}"
        if kind in ("side", "form", "footer") and r.random() < 0.4:
            wrap = f"<h3>{self.title()}</h3>" + wrap
            count = len(items) + 1
        else:
            count = len(items)
        body = "".join(f"<{inner}>{x}</{inner}>" for x in items) if inner != "span" else " ".join(items)
        count = count if inner != "span" else 1
        html = f"<{outer}{self.attribute(kind, style)}>{wrap.format(body)}</{outer}>"
        return f"<table><tr>{html}</tr></table>" if outer == "td" else html, [False] * count

    def lone(self, style: str) -> tuple[str, list[bool]]:
        """A page with nothing beside its main text of one or two blocks: no other block competes with it. Or a part alone."""
        r = self.r
        if r.random() < 0.2:
            html, labels = self.part(r.choice(("menu", "footer", "form", "notice", "side")), "known", True)
            return f"<html><body>{html}</body></html>", labels
        text = self.sentence(r.randint(1, 30)) if r.random() < 0.6 else self.prose()
        if r.random() < 0.3:
            text += f' <a href="/{self.word()}">{self.title(3)}</a>' + r.choice(("", ".", f" {self.sentence(5)}"))
        tag = r.choice(("", "p", "p", "div", "pre", "article", "td"))
        kept = r.random() < 0.5
        named = self.attribute("main", style) if kept else ""
        body = {"": text, "td": f"<table><tr><td>{text}</td></tr></table>"}.get(tag, f"<{tag}{named}>{text}</{tag}>")
        title = f"<h1>{self.title(6)}</h1>" if r.random() < 0.3 else ""
        page = title + body if r.random() < 0.3 else f"<html><body>{title}{body}</body></html>"
        return page, [True] * (1 + bool(title))

    def page(self) -> tuple[str, list[bool]]:
        r = self.r
        html: list[str] = []
        labels: list[bool] = []
        style = r.choice(("known", "known", "foreign", "code", "none"))
        tags = r.random() < (0.6 if style == "known" else 0.4)
        if r.random() < LONE:
            return self.lone(style)

        def put(kind: str) -> None:
            made = self.part(kind, style, tags)
            html.append(made[0])
            labels.extend(made[1])

        for kind in ("notice", "header", "menu", "advert"):
            if r.random() < 0.6:
                put(kind)
        if r.random() < 0.3:
            put("side")
        wrapper = r.choice(("article", "article", "main", "div", "div", "section", "plain") if tags else ("div", "div", "section", "td", "plain", "article"))
        outside = r.randint(0, 2) if wrapper != "plain" else 0
        html.append("<div>" * outside + {"plain": "", "td": "<table><tr><td>"}.get(wrapper, f"<{wrapper}{self.attribute('main', style)}>"))
        body = [("h1", self.title(9))] if r.random() < 0.8 else []
        if r.random() < 0.2:
            body.append(("p", self.title(3)))
        tiny = r.random() < 0.12  # little more than a title
        body.append(("p", self.sentence(r.randint(2, 9)) if tiny else self.prose()))
        for _ in range(0 if tiny else r.randint(1, 12)):
            kind = r.choice(("p",) * 8 + ("h2", "h3", "blockquote", "li", "pre", "div", "td", "figcaption"))
            body.append((kind, self.title(6) if kind[0] == "h" else self.sentence(r.randint(2, 9)) if kind in ("figcaption", "li") and r.random() < 0.5 else self.prose()))
        between = r.randint(1, len(body)) if r.random() < 0.5 else -1
        for k, (tag, text) in enumerate(body):
            if k == between:
                put(r.choice(("advert", "side", "social", "form", "notice")))
            if r.random() < 0.2 and " " in text:
                first, rest = text.split(" ", 1)
                text = f"<b>{first}</b> {rest}" if r.random() < 0.5 else f'<a href="/y">{first}</a> {rest}'
            close = "" if tag == "p" and r.random() < 0.1 else f"</{tag}>"
            html.append({"li": f"<ul><li>{text}</li></ul>", "td": f"<table><tr><td>{text}</td></tr></table>"}.get(tag, f"<{tag}>{text}{close}"))
            labels.append(True)
        inside = r.random() < 0.3
        for kind in ("social", "comment"):
            if r.random() < 0.5 and inside:
                put(kind)
        html.append({"plain": "", "td": "</td></tr></table>"}.get(wrapper, f"</{wrapper}>") + "</div>" * outside)
        if not inside and r.random() < 0.6:
            put("comment")
        for kind in ("side", "form", "advert", "notice", "menu", "footer"):
            if r.random() < {"footer": 0.8, "notice": 0.15, "menu": 0.15}.get(kind, 0.4):
                put(kind)
        return "<html><head><title>" + self.sentence(4) + "</title><style>p{}</style></head><body>" + "".join(html) + "</body></html>", labels


def labelled_pages(n: int = PAGES, seed: int = SEED, **made) -> list[tuple[str, list[bool]]]:
    """``n`` pages made by a rule, with the label of each block; those whose markup merges blocks are left out."""
    maker = Pages(seed, **made)
    pages = (maker.page() for _ in range(n))
    return [(html, labels) for html, labels in pages if len(blocks(html)) == len(labels)]


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return train(labelled_pages())


def main_text(html: str | None, model: Crf) -> str:
    page = blocks(html or "")
    return "\n".join(b.text for b, keep in zip(page, model.decode(page)) if keep)


def extract(html: Column, model: Crf | None = None) -> Column:
    """The main text of each page: its main blocks, joined by newlines."""
    model = model or default_model()

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: main_text(page, model))

    return texts(html)
