"""Main text of web pages by wrappers: union-free regular expressions over the tags of a host's pages.

A page is a tree of its block elements. A wrapper is such a tree too, and stands for a regular expression without
unions: elements in order, each perhaps optional, perhaps repeated, with text slots. It grows by aligning one page after
the other: like elements that follow each other fold into a repeated group, elements that only one side has become
optional, and texts that differ become slots; texts that never differ are part of the template.

Tasks build a wrapper of each host from the pages they hold, and wrappers are merged by the same alignment, first in
groups and then by host, so that a host with a third of all pages is spread like any other.

The main text is all text inside the article of a page, but for menus, notices and the like, which tags, class names
and ids give away. Of a page that has no article with text it is what fills slots of the wrapper that are not mostly
links. A text is part of the template if many different pages agree on it; pages with the same texts count as one.

Null html is empty: no text. Pages without a host share a wrapper. Repeated rows are extracted alike; an empty table
gives no rows. Whole pages of any length are read; broken markup is closed where HTML would close it.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tomewise.llm.common import append_columns, store
from tomewise.plans.storage import BROADCAST_BYTES

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
# Elements by how HTML treats them.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "object", "select", "xmp", "math", "canvas", "audio", "video")
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption header footer nav aside form fieldset address details summary menu dialog center "
    "hgroup search label button legend".split()
)
VOID_BREAKS = ("br", "hr")
# What an opening tag closes, if it is open and nothing that holds it in stands between.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}
INLINE_IN_P = frozenset(("label", "button"))
# What is not main text, by tag and by words of class names and ids.
OTHER_TAGS = frozenset("nav footer aside form menu dialog button label search fieldset legend header".split())
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice alert popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended comment comments reply replies discussion "
    "disqus toolbar pagination pager copyright legal disclaimer widget skip hidden teaser tags byline".split()
)
ARTICLE_WORDS = frozenset("article content post entry story main maincontent articlebody".split())
WORDS = re.compile(r"[a-z]+|[0-9]+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
# Elements nested deeper stand beside each other at this depth, in page order, as parts of what they lie in.
MAX_DEPTH = 100
MIN_PAGES = 5  # a text that so many different pages share, outside of an article, is part of the template


class Element:
    """A block element: its label (tag, class, id), and what it holds in order: texts and elements."""

    __slots__ = ("tag", "label", "parts", "linked")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.parts, self.linked = tag, label, [], 0


def _label(tag: str, attributes: str) -> str:
    names = {}
    for m in ATTRIBUTE.finditer(attributes):
        names.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    words = WORDS.findall(f"{names.get('class', '')} {names.get('id', '')} {names.get('role', '')}".lower())
    style = names.get("style", "").replace(" ", "").lower()
    if "hidden" in names or names.get("aria-hidden") == "true" or "display:none" in style:
        words.append("hidden")
    return ".".join([tag, *(w for w in words if not w.isdigit())])


def parse(page: str) -> Element:
    """The tree of block elements; inline elements leave their text, and breaks leave white space."""
    root = Element("html", "html")
    stack, at, links = [root], 0, 0
    opened: Counter = Counter()
    # No tag ends behind the last bracket, so nothing is searched there again and again.
    last = page.rfind(">") + 1

    def put(made: Element) -> None:
        """Into what is open, or beside it where that is as deep as can be."""
        stack[min(len(stack), MAX_DEPTH) - 1].parts.append(made)

    def add(text: str) -> None:
        if text:
            top = stack[-1]
            if len(stack) > MAX_DEPTH and stack[MAX_DEPTH - 1].parts[-1] is not top:
                # Text behind an inner element goes on in a further part of its own.
                top = stack[-1] = Element(top.tag, top.label)
                put(top)
            if top.parts and isinstance(top.parts[-1], str):
                top.parts[-1] += text
            else:
                top.parts.append(text)
            if links:
                top.linked += len(text)

    def leave(k: int) -> None:
        opened.subtract(x.tag for x in stack[k:])
        del stack[k:]

    def close(tags: tuple, holders: tuple) -> None:
        if not any(opened[tag] for tag in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in holders:
                return
            if stack[k].tag in tags:
                leave(k)
                return

    while m := TAG.search(page, at, last):
        add(page[at : m.start()])
        at = m.end()
        if at == last and m[0].startswith("<!--") and not m[0].endswith("-->"):
            return root  # a comment without an end takes the rest
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS and tag not in ("html", "body"):
                close((tag,), ())
                links = 0
            continue
        if tag in RAW:
            if not (m[3] or m[6] or "").endswith("/"):
                end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            add(" ")
        elif tag == "a":
            links = 1
        elif tag in VOID_BREAKS:
            add("\n")
        elif tag == "head":
            end = re.compile(r"</head\s*>|<body\b", re.I).search(page, at)
            if end:
                at = end.start() if end[0][1] != "/" else end.end()
        elif tag in BLOCKS and tag not in ("html", "body"):
            links = 0
            if tag not in INLINE_IN_P:
                close(("p",), ())
            if tag in CLOSES:
                close(CLOSES[tag], HOLDS[tag])
            label = _label(tag, m[3] or m[6] or "")
            if len(stack) >= MAX_DEPTH and is_other(stack[-1].label, True):
                label += ".hidden"
            made = Element(tag, label)
            put(made)
            stack.append(made)
            opened[tag] += 1
    add(page[at:].partition("<!--")[0])
    return root


def clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


# A wrapper is a dict: l label, d hashes of different pages that have it (no more than MIN_PAGES), t its texts if they
# never differ (else null), c characters of text, a of them in links, r whether it repeats, o whether it is optional,
# k the elements inside.


def _of(page: Element, name: int | None = None) -> dict:
    if name is None:
        name = _name(page)
    texts = clean(" ".join(x for x in page.parts if isinstance(x, str)))
    node = {"l": page.label, "d": [name], "t": texts, "c": len(texts), "a": min(page.linked, len(texts)), "r": 0, "o": 0, "k": []}
    for x in page.parts:
        if isinstance(x, Element):
            node["k"].append(_of(x, name))
    return _fold(node)


def _name(page: Element) -> int:
    """A hash of the page's texts in order: the same for its copies."""
    made = hashlib.blake2b(digest_size=6)

    def walk(element: Element) -> None:
        for x in element.parts:
            if isinstance(x, str):
                made.update(clean(x).encode("utf-8", "surrogatepass") + b"\0")
            else:
                walk(x)

    walk(page)
    return int.from_bytes(made.digest())


def _fold(node: dict) -> dict:
    """Like neighbours become one repeated element."""
    kept: list[dict] = []
    for x in node["k"]:
        if kept and kept[-1]["l"] == x["l"]:
            kept[-1] = merge(kept[-1], x)
            kept[-1]["r"] = 1
        else:
            kept.append(x)
    node["k"] = kept
    return node


def merge(a: dict, b: dict) -> dict:
    """The wrapper of two wrappers with the same label: mismatches become options, groups and slots."""
    kids: list[dict] = []
    left, right = a["k"], b["k"]
    match = SequenceMatcher(None, [x["l"] for x in left], [x["l"] for x in right], autojunk=False)
    for kind, i, j, p, q in match.get_opcodes():
        if kind == "equal":
            kids += [merge(x, y) for x, y in zip(left[i:j], right[p:q])]
        else:
            kids += [{**x, "o": 1} for x in [*left[i:j], *right[p:q]]]
    pages = a["d"]
    if len(pages) < MIN_PAGES and pages != b["d"]:
        pages = sorted({*pages, *b["d"]})[:MIN_PAGES]
    node = {
        "l": a["l"], "d": pages, "t": a["t"] if a["t"] == b["t"] else None, "c": a["c"] + b["c"],
        "a": a["a"] + b["a"], "r": a["r"] | b["r"], "o": a["o"] | b["o"], "k": kids,
    }
    return _fold(node)


def is_other(label: str, in_article: bool) -> bool:
    tag, *words = label.split(".")
    return tag in OTHER_TAGS and not (in_article and tag == "header") or any(w in OTHER_WORDS for w in words)


def is_article(label: str) -> bool:
    tag, *words = label.split(".")
    return tag in ("article", "main") or any(w in ARTICLE_WORDS for w in words)


def _has_article(page: Element) -> bool:
    """Whether an article with text is in the page, outside of menus and the like."""
    if is_other(page.label, False):
        return False
    if is_article(page.label) and _has_text(page):
        return True
    return any(_has_article(x) for x in page.parts if isinstance(x, Element))


def _has_text(page: Element) -> bool:
    return any(bool(clean(x)) if isinstance(x, str) else not is_other(x.label, True) and _has_text(x) for x in page.parts)


def extract(wrapper: dict, page: Element) -> str:
    """Texts of the page's article, or that fill content slots of the wrapper, in order, joined by single blanks."""
    needs_article = _has_article(page)
    found: list[str] = []

    def walk(element: Element, node: dict | None, inside: bool) -> None:
        if is_other(element.label, inside):
            return
        inside = inside or is_article(element.label)
        # Elements that the wrapper lacks are judged by their labels alone.
        slots = _slots([x.label for x in element.parts if isinstance(x, Element)], node)
        fixed = node is not None and node["t"] is not None and len(node["d"]) >= MIN_PAGES
        links = node is not None and node["c"] and node["a"] * 2 > node["c"]
        own = inside if needs_article else not fixed and not links
        at = 0
        for x in element.parts:
            if isinstance(x, str):
                if own and (text := clean(x)):
                    found.append(text)
            else:
                walk(x, slots[at], inside)
                at += 1

    walk(page, wrapper, False)
    return " ".join(found)


def _slots(labels: list[str], node: dict | None) -> list[dict | None]:
    """The wrapper's element for each of the page's, aligned in order; repeats share one."""
    if node is None or not labels:
        return [None] * len(labels)
    runs = [i for i, x in enumerate(labels) if not i or labels[i - 1] != x]
    kids = node["k"]
    match = SequenceMatcher(None, [x["l"] for x in kids], [labels[i] for i in runs], autojunk=False)
    to: list[dict | None] = [None] * len(runs)
    for block in match.get_matching_blocks():
        for k in range(block.size):
            to[block.b + k] = kids[block.a + k]
    slots, run = [], -1
    for i, x in enumerate(labels):
        run += not i or labels[i - 1] != x
        slots.append(to[run])
    return slots


def learn_wrappers(df: DataFrame, url: str = "url", page: str = "html", groups: int = 64, flush: int = 2000) -> DataFrame:
    """(host, wrapper as JSON) over all pages, stored. Tasks hold at most ``flush`` hosts at a time."""
    schema = StructType(
        [StructField("host", StringType()), StructField("part", LongType()), StructField("wrapper", StringType())]
    )

    def start(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() % groups
        held: dict[str, dict] = {}

        def rows():
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(held.keys(), pa.string()),
                    pa.array([part] * len(held), pa.int64()),
                    pa.array([json.dumps(x) for x in held.values()], pa.string()),
                ],
                names=["host", "part", "wrapper"],
            )
            held.clear()
            return batch

        for batch in batches:
            for host, text in zip(batch.column(0), batch.column(1), strict=True):
                host, node = host.as_py(), _of(parse(text.as_py() or ""))
                held[host] = merge(held[host], node) if host in held else node
                if len(held) >= flush:
                    yield rows()
        yield rows()

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        node = None
        for text in sorted(rows["wrapper"]):
            node = json.loads(text) if node is None else merge(node, json.loads(text))
        return pd.DataFrame({"host": [key[0]], "part": [0], "wrapper": [json.dumps(node)]})

    pages = df.select(_host(url).alias("host"), F.col(page).alias("html"))
    parts = pages.mapInArrow(start, schema)
    parts = parts.groupBy("host", "part").applyInPandas(join, schema)
    return store(parts.groupBy("host").applyInPandas(join, schema).select("host", "wrapper"), "wrappers")


def _host(url: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), HOST, 1), F.lit("")))


def main_text(
    df: DataFrame, wrappers: DataFrame, url: str = "url", page: str = "html", text: str = "text"
) -> DataFrame:
    """``df`` with the main text of each page."""
    size = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 64).alias("n")).head()["n"] or 0
    known = wrappers.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))
    if size <= BROADCAST_BYTES:
        known = F.broadcast(known)
    columns = df.columns
    joined = df.withColumn("_host", _host(url)).join(known, "_host", "left")

    def start():
        kept: dict[str, dict] = {}

        def one(value: str | None, wrapper: str | None) -> str:
            if not value:
                return ""
            tree = parse(value)
            if wrapper is None:
                return extract(_of(tree), tree)
            if wrapper not in kept:
                if len(kept) > 1000:
                    kept.clear()
                kept[wrapper] = json.loads(wrapper)
            return extract(kept[wrapper], tree)

        return lambda pages, found: ([one(p, w) for p, w in zip(pages, found, strict=True)],)

    out = append_columns(joined, [page, "_wrapper"], [StructField(text, StringType(), False)], start)
    return out.select(*(c for c in columns if c != text), text)
