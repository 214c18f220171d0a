"""Main text of web pages by a conditional random field over DOM leaf blocks.

A page is read into leaf blocks: stretches of text between block-level tags,
each with its chain of open block elements. Scripts, styles, titles, comments
of the markup and the like hold no blocks. A block's features are the tags,
classes, ids and roles above it and shallow properties of its text (length,
share of link text, sentence end, wording of notices). The field is trained on
labelled pages, which ``labelled_pages`` writes from templates with a fixed
seed, and Viterbi decoding marks the blocks of the article.

Character references are decoded once; white space in a block becomes one
space; blocks are joined by an empty line. A null or empty page, and a page
without article blocks, gives an empty text. Repeated pages are treated row by
row; other columns are ignored. Malformed markup never fails: unclosed elements
end with their parents, stray end tags are skipped.
"""

from __future__ import annotations

import html
import random
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, map_batches
from .crf import LinearChain

#: Comments, declarations and tags. Quotes count directly behind an equals sign only,
#: and one that is never closed is a plain character.
TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*+)?+)*+)(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s]*)))?""")
NAMED = frozenset(("class", "id", "role", "itemprop"))
NAME = re.compile(r"[a-z]+")
#: Elements whose content is no text of the page.
SILENT = frozenset("script style title noscript template textarea svg math object iframe select".split())
#: Of these, the ones whose content is no markup: it goes up to the literal end tag.
RAW = {x: re.compile(rf"</{x}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for x in "script style title noscript textarea iframe".split()}
VOID = frozenset("area base col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: A start tag ends these open elements, as far as no boundary is between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDARY = frozenset("table ul ol dl article section main aside nav header footer div body form blockquote".split())

SPACE = 1 << 14
#: Feature names that a worker remembers the weights of.
MEMO_NAMES = 50_000
#: Wording of blocks that tell readers about the site rather than the subject.
NOTICES = re.compile(r"cookie|subscri|sign in|log ?in|newsletter|advert|sponsor|privacy|copyright|©|all rights|share this|related|comment", re.I)


def attributes(text: str) -> list[str]:
    out = []
    for m in ATTRIBUTE.finditer(text):
        if (name := m[1].lower()) in NAMED:
            out += [f"{name}:{w}" for w in NAME.findall((m[2] or m[3] or m[4] or "").lower())]
    return out


class Frame:
    """An open element: its tag, what it adds to the features of the elements above
    it, and the weight of all of these together."""

    __slots__ = ("above", "new", "tag", "weight")

    def __init__(self, above: Frame | None, tag: str, new: tuple[str, ...], weight):
        self.above, self.tag, self.new, self.weight = above, tag, new, weight

    def features(self) -> list[str]:
        """From the outermost element in."""
        chain, at = [], self
        while at is not None:
            chain.append(at.new)
            at = at.above
        return [x for new in reversed(chain) for x in new]


class Stack:
    """The open elements. Pushing and popping cost what an element has itself, so a
    page costs the same for each tag however deep it is."""

    def __init__(self, weigh):
        self.weigh, self.frames = weigh, [Frame(None, "", (), (0.0, 0.0))]
        self.names: set[str] = set()
        self.open: dict[str, int] = {}

    @property
    def top(self) -> Frame:
        return self.frames[-1]

    def push(self, tag: str, names: list[str]) -> None:
        new = tuple(x for x in dict.fromkeys((f"tag:{tag}", *names)) if x not in self.names)
        self.names.update(new)
        self.open[tag] = self.open.get(tag, 0) + 1
        weight = self.top.weight
        if self.weigh:
            a, b = self.weigh(new)
            weight = weight[0] + a, weight[1] + b
        self.frames.append(Frame(self.top, tag, new, weight))

    def cut(self, at: int) -> None:
        """Close frames[at] and all inside it."""
        while len(self.frames) > at:
            gone = self.frames.pop()
            self.names.difference_update(gone.new)
            self.open[gone.tag] -= 1

    def close(self, tag: str) -> None:
        if self.open.get(tag):
            at = len(self.frames) - 1
            while self.frames[at].tag != tag:
                at -= 1
            self.cut(at)

    def make_room(self, tag: str) -> None:
        """Close what a start tag ends: a paragraph, and the likes of itself, as far
        as no boundary is between."""
        ends = ENDS.get(tag, frozenset()) | {"p"}
        if any(self.open.get(x) for x in ends):
            for at in range(len(self.frames) - 1, 0, -1):
                if self.frames[at].tag in ends:
                    self.cut(at)
                elif self.frames[at].tag in BOUNDARY:
                    break


def blocks(page: str, weigh=None) -> list[tuple[str, Frame, str, float]]:
    """(tag of the innermost open element, its frame, decoded text, share of link
    text). weigh: a feature tuple to its two weights, summed up along the frames."""
    out: list[tuple[str, Frame, str, float]] = []
    stack = Stack(weigh)
    parts: list[str] = []
    linked, link, silent, past = 0, False, "", 0
    endless: set[str] = set()

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((stack.top.tag, stack.top, text, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    while m := TAG.search(page, past):
        if m.start() > past and not silent:
            parts.append(page[past : m.start()])
            if link:
                linked += m.start() - past
        past = m.end()
        name = (m[2] or "").lower()
        if name in RAW and not m[1] and not m[3].endswith("/"):
            end = RAW[name].search(page, past)
            past = end.end() if end else len(page)
            continue
        if silent:
            if m[1] and name == silent:
                silent = ""
            continue
        if not name:
            continue
        if name in SILENT:
            if not m[1] and not m[3].endswith("/") and name not in endless:
                if re.compile(f"</{name}", re.I).search(page, past):
                    silent = name
                else:
                    endless.add(name)  # never closed: its content is read as text
            continue
        if name in INLINE:
            if name == "a":
                link = not m[1]
            continue
        if name == "br":
            parts.append(" ")
            continue
        flush()
        link = False
        if name in VOID:
            continue
        if m[1]:
            stack.close(name)
            continue
        stack.make_room(name)
        if not m[3].endswith("/"):
            stack.push(name, attributes(m[3]) if m[3] else [])
    if not silent:
        parts.append(page[past:])
    flush()
    return out


def number(name: str) -> int:
    return 1 + zlib.crc32(name.encode()) % (SPACE - 1)


def text_features(text: str, share: float) -> list[str]:
    n = text.count(" ") + 1
    size = "1" if n == 1 else "4" if n <= 4 else "12" if n <= 12 else "40" if n <= 40 else "more"
    out = ["bias", f"words:{size}", f"links:{'no' if share < 0.05 else 'some' if share < 0.5 else 'most'}", f"end:{text[-1] in '.!?…»”\"'}"]
    if n <= 40 and NOTICES.search(text):
        out.append("notice")
    return out


class Model:
    def __init__(self, chain: LinearChain):
        self.chain = chain
        self.rows = chain.weights.tolist()
        self.known: dict[str, list[float]] = {}

    def weigh(self, features) -> tuple[float, float]:
        """Sums of the features' log-potentials."""
        a = b = 0.0
        for x in features:
            got = self.known.get(x)
            if got is None:
                if len(self.known) > MEMO_NAMES:
                    self.known.clear()
                got = self.known[x] = self.rows[number(x)]
            a += got[0]
            b += got[1]
        return a, b

    def emissions(self, page: str) -> tuple[list[str], np.ndarray]:
        """The blocks' texts and log-potentials."""
        texts, emit = [], []
        for tag, frame, text, share in blocks(page, self.weigh):
            a, b = self.weigh((f"leaf:{tag}", *text_features(text, share)))
            texts.append(text)
            emit.append((frame.weight[0] + a, frame.weight[1] + b))
        return texts, np.array(emit)

    def article(self, page: str | None) -> list[str]:
        texts, emit = self.emissions(page or "")
        if not texts:
            return []
        return [x for x, y in zip(texts, self.chain.viterbi(emit), strict=True) if y]


#: Names that say nothing of what an element holds.
NEUTRAL = "wrapper container row col grid inner outer page site layout block clearfix wp default theme box holder flex column group no js group-a span width full-width left right center x1 x2 y1 z1 q".split()


def labelled_pages(count: int, seed: int = 11) -> list[tuple[str, list[int]]]:
    """(page, a label for each of its leaf blocks: 1 in the article)."""
    rng = random.Random(seed)
    syllables = [a + b for a in ("b", "d", "k", "l", "m", "n", "r", "s", "t", "v", "ch", "é", "ö") for b in ("a", "e", "i", "o", "u", "an", "er", "in")]

    def word():
        return "".join(rng.choices(syllables, k=rng.randint(1, 4)))

    def phrase(low, high):
        return " ".join(word() for _ in range(rng.randint(low, high))).capitalize()

    def prose():
        said = " ".join(phrase(2, 14) + "." for _ in range(rng.choice((1, 1, 2, 4, 8))))
        if rng.random() < 0.15:
            said += f' <a href="/{word()}">{phrase(1, 3)}</a> {phrase(1, 5)}.'
        if rng.random() < 0.2:
            said = f"<b>{said}" + rng.choice(("</b>", "<br>"))
        return said

    def one(names, what, text, label, made):
        cls = rng.choice(names) if names else ""
        made.append((f'<{what}{f" class={chr(34)}{cls}{chr(34)}" if cls else ""}>{text}</{what}>', [label]))

    def listed(low, high, link=True):
        items = [f'<li><a href="/{word()}">{word()}</a></li>' if link else f"<li>{phrase(2, 12)}.</li>" for _ in range(rng.randint(low, high))]
        return f"<ul>{''.join(items)}</ul>", [0 if link else 1] * len(items)

    def wrap(open_, inner, close):
        return open_ + "".join(h for h, _ in inner) + close, [y for _, ys in inner for y in ys]

    def advert():
        made: list = []
        one(("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner ad"), rng.choice(("div", "aside", "section")), prose() if rng.random() < 0.7 else phrase(1, 6), 0, made)
        return made[0]

    def comments():
        rows = [(f'<{t} class="comment"><p>{prose()}</p></{t}>', [0]) for t in [rng.choice(("div", "article", "li"))] for _ in range(rng.randint(1, 4))]
        head = [("<h3>Comments</h3>", [0])] if rng.random() < 0.6 else []
        name = rng.choice(("comments", "discussion", "responses", "reader-comments"))
        return wrap(f'<section id="{name}">' if rng.random() < 0.5 else f'<div class="{name}">', head + rows, "</section>" if rng.random() < 0.5 else "</div>")

    def form():
        name = rng.choice(("newsletter", "subscribe", "search", "login", "contact"))
        return f'<form class="{name}"><p>{phrase(2, 8)}</p><input type="text"><button>{word()}</button></form>', [0, 0]

    def notice():
        made: list = []
        one(("notice", "cookie-notice", "cookie-banner", "alert", "gdpr consent", "banner"), "div", f"<p>{prose()}</p>" if rng.random() < 0.6 else phrase(4, 16) + ".", 0, made)
        return made[0]

    def sidebar():
        inner = [listed(2, 6)] + ([(f"<h3>{phrase(1, 3)}</h3>", [0])] if rng.random() < 0.6 else []) + ([(f"<p>{prose()}</p>", [0])] if rng.random() < 0.5 else [])
        return wrap("<aside>" if (a := rng.random() < 0.5) else f'<div class="{rng.choice(("sidebar", "widget", "related", "side menu"))}">', inner, "</aside>" if a else "</div>")

    def wrapped(made):
        """Inside neutral elements, as site builders write them."""
        for _ in range(rng.choice((0, 0, 0, 1, 2, 3, 8))):
            names = " ".join(rng.sample(NEUTRAL, rng.randint(0, 5)))
            made = wrap(f"<{(t := rng.choice(('div', 'div', 'div', 'section')))}{f' class={chr(34)}{names}{chr(34)}' if names else ''}>", [made], f"</{t}>")
        return made

    def share():
        made: list = []
        one(("share", "social", "share-buttons", "tags", "post-meta", "byline-links", "pagination"), "div", " ".join(f'<a href="/{word()}">{word()}</a>' for _ in range(rng.randint(2, 5))), 0, made)
        return made[0]

    def related():
        rows = [(f'<{t}><a href="/{word()}">{phrase(2, 9)}</a></{t}>', [0]) for t in [rng.choice(("li", "div", "h4", "p"))] for _ in range(rng.randint(2, 6))]
        head = [(f"<h{(k := rng.randint(2, 4))}>{rng.choice(('Related', 'More stories', phrase(1, 3)))}</h{k}>", [0])]
        return wrap(f'<div class="{rng.choice(("related", "related-posts", "recommended", "more", "read-next"))}">', head + rows, "</div>")

    def body():
        inner = [(f"<h1>{phrase(2, 10)}</h1>", [1])]
        if rng.random() < 0.15:
            inner = [wrap("<header>", inner, "</header>")]
        for _ in range(rng.choice((0, 1, 2, 4, 8, 16))):
            kind = rng.random()
            if kind < 0.7:
                inner.append((f"<p>{prose()}" + ("</p>" if rng.random() < 0.8 else ""), [1]))
            elif kind < 0.78:
                inner.append((f"<h{(k := rng.randint(2, 4))}>{phrase(1, 6)}</h{k}>", [1]))
            elif kind < 0.84:
                inner.append(listed(1, 6, False))
            elif kind < 0.89:
                inner.append((f"<blockquote><p>{prose()}</p></blockquote>", [1]))
            elif kind < 0.92:
                inner.append((f"<table><tr><td>{phrase(1, 3)}</td><td>{phrase(1, 3)}</td></tr></table>", [1, 1]))
            elif kind < 0.94:
                inner.append((f"<pre>{phrase(2, 9)}</pre>", [1]))
            elif kind < 0.96:
                inner.append(share())
            else:
                inner.append(rng.choice((advert, form, notice, sidebar))())
            if rng.random() < 0.1:
                inner[-1] = wrapped(inner[-1])
        if rng.random() < 0.12:
            inner.append(comments())
        name = rng.random()
        if name < 0.6:
            return wrap("<article>" if name < 0.45 else f'<article class="{rng.choice(("post hentry", "story", "type-post status-publish", "article"))}">', inner, "</article>")
        if name < 0.75:
            return wrap("<main>" if name < 0.7 else '<div role="main">', inner, "</main>" if name < 0.7 else "</div>")
        return wrap(f'<div class="{rng.choice(("content", "post", "entry", "article body", "main", "story", "text", "post-body", "entry-content", "article__body", "prose"))}">', inner, "</div>")

    def navigation():
        menu, labels = listed(2, 8)
        if rng.random() < 0.7:
            return f"<nav>{menu}</nav>", labels
        return f'<div {rng.choice(("class", "class", "id"))}="{rng.choice(("menu", "nav", "navbar", "breadcrumb", "breadcrumbs", "main-navigation", "site-nav", "topbar"))}">{menu}</div>', labels

    def header():
        return f"<header><div class=\"logo\">{word()}</div><p>{phrase(1, 6)}</p></header>", [0, 0]

    def footer():
        said = rng.choice(("&copy; ", "", "Copyright ")) + phrase(1, 5) + rng.choice((" &middot; " + phrase(2, 10) + ".", ". " + prose(), ""))
        return (f"<footer>{said}</footer>" if rng.random() < 0.5 else f"<footer><p>{said}</p></footer>" if rng.random() < 0.6 else f'<div {rng.choice(("class", "id"))}="{rng.choice(("footer", "site-footer", "colophon", "page-footer"))}">{said}</div>'), [0]

    out = []
    for _ in range(count):
        top = [f() for f, p in ((header, 0.4), (navigation, 0.85), (notice, 0.25), (advert, 0.6)) if rng.random() < p]
        end = [f() for f, p in ((comments, 0.3), (sidebar, 0.4), (advert, 0.2), (form, 0.25), (notice, 0.15), (footer, 0.85)) if rng.random() < p]
        if rng.random() < 0.15:
            top, end = top + [x for x in end if rng.random() < 0.5], end
        if rng.random() < 0.2:
            end.insert(0, related())
        if rng.random() < 0.15:
            end.insert(0, share())
        content = wrapped(body())
        if rng.random() < 0.3:
            content = wrapped(wrap("", [content, *end], ""))
            end = []
        names = " ".join(rng.sample(NEUTRAL, rng.choice((0, 0, 3, 12))))
        page, labels = wrap(f'<body class="{names}">' if names else "<body>", [*map(wrapped, top), content, *map(wrapped, end)], "</body></html>" if rng.random() < 0.9 else "")
        out.append((f"<!DOCTYPE html><html><head><title>{phrase(2, 6)}</title><script>var t='</p>';</script></head>{page}", labels))
    return out


PAGES, LENGTH, EPOCHS = 900, 64, 25
_model: list[Model] = []


def model() -> Model:
    """Trained once per process from the labelled pages; the seeds are fixed, so
    every worker has the same one."""
    if not _model:
        features, labels, mask = [], [], []
        for page, marks in labelled_pages(PAGES):
            found = [[number(x) for x in [*text_features(text, share), f"leaf:{tag}", *frame.features()]] for tag, frame, text, share in blocks(page)]
            if len(found) != len(marks):
                raise AssertionError("a labelled page and its blocks disagree")
            for i in range(0, len(found), LENGTH):
                features.append(found[i : i + LENGTH])
                some = marks[i : i + LENGTH]
                labels.append(np.pad(np.array(some), (0, LENGTH - len(some))))
                mask.append(np.arange(LENGTH) < len(some))
        padded = np.zeros((len(features), LENGTH, max(len(b) for x in features for b in x)), np.int64)
        for rows, x in zip(padded, features, strict=True):
            for row, numbers in zip(rows, x, strict=False):
                row[: len(numbers)] = numbers
        chain = LinearChain(SPACE, 2).fit(padded, np.array(labels), np.array(mask), EPOCHS, batch=128)
        _model.append(Model(chain))
    return _model[0]


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every page."""
    chain = model().chain
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(chain)

    def work(rows):
        model = held("html", "model", lambda: Model(shared.value))
        found = [model.article(x) for x in rows["html"]]
        texts = ["\n\n".join(x) for x in found]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": list(map(len, texts)), "n_blocks": list(map(len, found))}

    picked = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = picked.schema["page_id"].dataType.simpleString()
    return map_batches(picked, work, f"page_id {kind}, url string, text string, n_chars bigint, n_blocks bigint")
