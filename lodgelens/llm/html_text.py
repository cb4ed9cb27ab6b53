"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks at block-level tags.  A block's features are
its word count and link density, those of the blocks before and after it, and
marks of its place: inside an article, inside a part that its tag, role, class
or id marks as page furniture, inside one whose class or id merely hints at
it, a heading, a paragraph, on a page that has an article.  A decision tree,
trained on the small table of ``labelled_pages``, picks the blocks to keep.
Text that is not shown (scripts, styles, hidden tags) and advertising inside a
line are no blocks.

Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by one space.  A null or empty page has
an empty text; one without tags is its text.  Pages are read whole, in time
linear in their length, tags without an end or a start included.  Rows that
repeat a page_id are each extracted; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import trees

# fixed values: tags that hold no text to show, tags that set their text apart,
# tags and roles of page furniture, words of class and id names that mark it
SILENT = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "head", "title"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s",
          "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FURNITURE_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "select", "textarea", "label", "fieldset"}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
FURNITURE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "aside",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "toolbar", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
    "login", "comment", "comments", "disqus", "replies", "respond", "share", "sharing", "related", "recommended",
    "pagination", "pager", "widget", "copyright"}
HINT_WORDS = {"header", "side", "foot", "search", "legal", "disclaimer", "alert", "social", "discussion", "reply", "responses", "meta", "byline", "tags"}
ADVERT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsored"}
ARTICLE_TAGS = {"article", "main"}
ARTICLE_WORDS = {"article", "post", "entry", "story", "content", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PARAGRAPHS = {"p", "blockquote", "pre", "li", "dd", "td"}
HEAD_TAGS = {"title", "meta", "link", "script", "style", "base", "noscript", "template", "html"}


def marks(attrs: dict[str, str]) -> tuple[bool, bool, bool]:
    """(hidden, marked as furniture, hinted at) by a tag's attributes.

    A class or id marks if a furniture word is its first or last part
    (``cookie-notice``, ``comment-list``), and hints if one stands elsewhere in
    it or a hint word does (``content-sidebar-wrap``, ``entry-header``); one
    that begins with no, has or with says nothing.
    """
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "").lower()))
    marked = hinted = False
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        parts = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
        if not parts or parts[0] in ("no", "has", "with", "without"):
            continue
        if parts[0] in FURNITURE_WORDS or parts[-1] in FURNITURE_WORDS:
            marked = True
        elif (FURNITURE_WORDS | HINT_WORDS) & set(parts):
            hinted = True
    return hidden, marked, hinted


@dataclass(frozen=True)
class Place:
    article: bool = False
    furniture: bool = False
    hinted: bool = False
    paragraph: bool = False


@dataclass(frozen=True)
class Block:
    text: str
    words: int
    linked: int
    place: Place
    heading: bool


class _Blocks(HTMLParser):
    """Collects the blocks; text inside ``silent`` tags or a ``muted`` one is left out."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, Place]] = []  # with what is around
        self.count: Counter[str] = Counter()  # open tags by name
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.silent: list[str] = []  # counted as well
        self.muted, self.depth = "", 0  # the tag inside a line or block that is not shown, and how deep in tags of its name
        self.link, self.heading = 0, ""

    def place(self) -> Place:
        return self.open[-1][1] if self.open else Place()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, len(text.split()), len("".join(self.linked).split()), self.place(), bool(self.heading)))
        self.parts, self.linked = [], []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        while self.silent and (self.silent[-1] in ("head", "title") and tag not in HEAD_TAGS or self.silent[-1] == "iframe" and tag not in INLINE):
            self.count[self.silent.pop()] -= 1  # tags that their writer left open
        if tag in SILENT:
            self.silent.append(tag)
            self.count[tag] += 1
            return
        if self.muted:
            if tag in INLINE or self.muted not in INLINE and self.muted != "p":
                self.depth += tag == self.muted and tag not in VOID
                return
            self.muted = ""  # a line ends with its block, a paragraph with the next one
        a = {k: v or "" for k, v in attrs}
        hidden, marked, hinted = marks(a)
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag not in INLINE:
                self.flush()
            return
        if tag in INLINE:
            names = {w for name in a.get("class", "").lower().split() for w in re.findall("[a-z]+", name)}
            if hidden or names & ADVERT_WORDS:
                self.muted, self.depth = tag, 1
                self.parts.append(" ")
            else:
                self.link += tag == "a"
            return
        self.flush()
        self.link = 0  # a link left open ends with its block
        left_open = {"p"} | (HEADINGS if tag == "p" or tag in HEADINGS else {"li"} if tag == "li" else set())
        if self.open and self.open[-1][0] in left_open:
            self.shut(len(self.open) - 1)
        if hidden and tag not in ("html", "body"):
            self.muted, self.depth = tag, 1
            return
        around = self.place()
        role = a.get("role", "").lower()
        named = tag not in ("html", "body")
        here = tag in FURNITURE_TAGS or role in FURNITURE_ROLES or tag == "header" and not around.article or marked and named
        words = set(re.findall("[a-z]+", f"{a.get('class', '')} {a.get('id', '')}".lower()))
        opens = tag in ARTICLE_TAGS or role in ("main", "article") or bool(words & ARTICLE_WORDS) and tag in ("div", "section", "td")
        self.heading = tag if tag in HEADINGS else ""
        self.count[tag] += 1
        self.open.append((tag, Place(around.article or opens and not here, around.furniture or here,
                                     (around.hinted and tag not in ARTICLE_TAGS) or hinted and named, tag in PARAGRAPHS)))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        elif tag not in SILENT:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def shut(self, i: int) -> None:
        for tag, _ in self.open[i:]:
            self.count[tag] -= 1
        del self.open[i:]

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            while self.count[tag]:
                last = self.silent.pop()
                self.count[last] -= 1
                if last == tag:
                    break
            return
        if self.muted:
            if tag == self.muted:
                self.depth -= 1
                self.muted = self.muted if self.depth else ""
                return
            if self.muted not in INLINE or tag in INLINE:
                return
            self.muted = ""
        if tag == "a":
            self.link = max(0, self.link - 1)
        if tag in INLINE:
            return
        self.flush()
        self.heading = ""
        if self.count[tag]:  # otherwise it was never opened, and nothing ends
            i = len(self.open) - 1
            while self.open[i][0] != tag:
                i -= 1
            self.shut(i)

    def handle_data(self, data: str) -> None:
        if not self.silent and not self.muted:
            self.parts.append(data)
            if self.link:
                self.linked.append(data + " ")


def blocks(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


#: The columns of ``features``.
FEATURES = ("words", "links", "words before", "links before", "words after", "links after",
            "article", "furniture", "hinted", "heading", "paragraph", "has article")


def features(found: list[Block]) -> np.ndarray:
    """words and link density of the block, the one before and the one after; where it stands."""
    n = len(found)
    words = np.array([0] + [b.words for b in found] + [0], float)
    density = np.array([1] + [b.linked / b.words for b in found] + [1], float)
    flag = lambda get: np.array([get(b) for b in found], float)
    has = np.full(n, float(any(b.place.article and not b.place.furniture for b in found)))
    return np.stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], flag(lambda b: b.place.article),
                     flag(lambda b: b.place.furniture), flag(lambda b: b.place.hinted), flag(lambda b: b.heading), flag(lambda b: b.place.paragraph), has], 1)


def labelled_pages(n: int = 480, seed: int = 5) -> list[str]:
    """The labelled table, made by rule: small pages whose blocks to keep begin with "+".

    Half of the pages have an article, with blocks of any length and parts
    whose class hints at furniture, which their length and links tell apart;
    the others have none, and what to keep is told by length, links and
    neighbours; some are a text without tags.
    """
    rng = np.random.default_rng(seed)

    def text(low: int, high: int) -> str:
        return " ".join(["word"] * int(rng.integers(low, high)))

    def link(low: int = 1, high: int = 4) -> str:
        return f"<a>{text(low, high)}</a>"

    def links() -> str:
        return "<div>" + " ".join(link() for _ in range(rng.integers(2, 7))) + "</div>"

    def hinted(article: bool) -> str:
        name = rng.choice(["article-header", "search", "legal", "entry-meta", "story-side"])
        body = f"<h1>+{text(1, 9)}</h1>" if article and rng.random() < 0.4 else "".join(f"<p>+{text(12, 60)}</p>" for _ in range(rng.integers(1, 5)))
        return f"<div class={name}>" + (body if rng.random() < 0.7 else links() if rng.random() < 0.5 else text(1, 8)) + "</div>"

    pages = []
    for k in range(n):
        marked = [f"<nav>{link()}<p>{text(1, 30)}</p></nav>", f"<aside><p>{text(1, 60)}</p></aside>", f"<div class=ad>{text(1, 30)}</div>",
                  f"<form><p>{text(1, 12)}</p></form>", f"<div id=comments><p>{text(1, 60)}</p><p>{text(1, 9)}</p></div>", f"<div class=notice>{text(1, 40)}</div>"]
        rng.shuffle(marked)
        if k % 2:
            inner = [f"<p>+{text(1, 60)}</p>" for _ in range(rng.integers(1, 8))] + [f"<p>+{link()} {text(1, 20)}</p>"] * (k % 4 == 1) + [f"<p>+<a>{text(1, 9)}</a></p>"] * (k % 10 == 1)
            inner += [f"<div>+{text(1, 60)}</div>"] * (k % 6 == 1) + marked[:1] + [hinted(True)] * (k % 4 == 3)
            rng.shuffle(inner)
            loose = [[f"<p>{text(1, 60)}</p>" for _ in range(rng.integers(0, 4))] + [links()] * (k % 4 == 1) + [f"<h2>{text(1, 6)}</h2>"] * (k % 6 == 1) for _ in range(2)]
            pages.append("".join(marked[1:3] + loose[0] + [f"<article><h1>+{text(1, 9)}</h1>", *inner, "</article>"] + loose[1] + marked[3:5] + [f"<footer><p>{text(1, 60)}</p></footer>"]))
        elif k % 8 == 0:
            pages.append("+" + text(1, 80))
        elif k % 8 == 4:  # short paragraphs only, or parts whose class hints
            body = [f"<p>+{text(1, 15)}</p>" for _ in range(rng.integers(1, 9))] if k % 16 == 4 else [hinted(False) for _ in range(rng.integers(1, 4))]
            pages.append("".join([*marked[:1], *body, *marked[1:2]]))
        else:
            unit = "div" if k % 16 == 2 else "p"
            body = [f"<{unit}>+{text(12, 60)}</{unit}>" for _ in range(rng.integers(3, 8))]
            body.insert(int(rng.integers(1, len(body))), f"<p>+{text(2, 9)}</p>")
            top = [links() + f"<div>{link()}</div>" * int(rng.integers(0, 2)), *marked[:int(rng.integers(0, 3))]]
            pages.append("".join([*(top if k % 8 == 2 else top[::-1]), f"<h1>+{text(2, 9)}</h1>", *body, *[links(), f"<p>{text(1, 5)}</p>", links()][:int(rng.integers(0, 4))], f"<div>{text(1, 6)}</div>", *marked[2:4]]))
    return pages


def train(depth: int = 9) -> tuple:
    x, y = [], []
    for page in labelled_pages():
        found = blocks(page)
        x.append(features(found))
        y += [b.text.startswith("+") for b in found]
    x, y = np.concatenate(x), np.array(y, float)
    return trees.grow(x, y, np.ones(len(y)), depth, 3)


def main_text(html: str | None, tree: tuple) -> str:
    found = blocks(html) if html else []
    if not found:
        return ""
    keep = trees.predict(tree, features(found)) >= 0.5
    return " ".join(b.text for b, k in zip(found, keep) if k)


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text for ``pages(page_id, url, html)``."""
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 2):
            text = [main_text(h.as_py(), tree) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], ["page_id", "url", "text"])

    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return p.mapInArrow(run, "page_id long, url string, text string")


def op1_block_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    return extract(spark, C.table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
