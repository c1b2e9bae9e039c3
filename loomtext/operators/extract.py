"""Pages to text: the general reader, and extractors that follow a specification of a site's layout."""

from __future__ import annotations

import html as _html
import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..functions import text as T
from . import dom

# Elements without prose, elements that make a paragraph, and the lengths that count as content.
DROP_TAGS = (
    "script", "style", "noscript", "template", "svg", "iframe", "form", "nav", "header", "footer", "aside", "button", "input", "select", "option", "datalist", "dialog",
    "canvas", "video", "audio", "source", "picture-map", "figure", "figcaption", "menu", "ad", "ins",
)
BLOCK_TAGS = frozenset(("p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "br", "blockquote", "tr", "td", "th", "ul", "ol",))
MAIN_SELECTORS = ("article", "main", "div[role=main]")
MIN_MAIN, MIN_PARAGRAPH = 40, 24

_BAD = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_SPACES = re.compile(r"[ \t   ]+")


def clean(text: str | None) -> str:
    """clean_text for one string, for use inside the Python operators."""
    t = _BAD.sub("", _html.unescape(text or "")).replace("\r\n", "\n").replace("\r", "\n")
    return "\n".join(x for x in (_SPACES.sub(" ", line).strip() for line in t.split("\n")) if x)


def read_page(html: str | None, prefer_main: bool = True, min_paragraph: int = MIN_PARAGRAPH) -> str:
    """Text of a page's main element (the body if it has none), a line for each block of min_paragraph characters or more.

    A block inside a block is read by itself too, as its own line. If no block is long enough, all paragraphs count. '' for null.
    """
    if not html:
        return ""
    root = dom.parse(html)
    for e in list(root.walk()):
        if e.name in DROP_TAGS:
            e.drop()
    main = None
    if prefer_main:
        for s in MAIN_SELECTORS:
            e = root.first(s)
            if e is not None and len(e.text()) >= MIN_MAIN:
                main = e
                break
        if main is not None:
            main = main.first("article") or main
    main = main or root.first("body") or root
    parts = [t for e in main.walk() if e.name in BLOCK_TAGS and len(t := e.text()) >= min_paragraph]
    if not parts:
        parts = [t for e in root.walk() if e.name == "p" and (t := e.text())]
    return clean("\n\n".join(parts))


@dataclass(frozen=True)
class ExtractSpec:
    """How a site's pages are laid out."""

    #: Tried in order; a page without any has an empty body.
    main: tuple[str, ...]
    drop_tags: tuple[str, ...] = ("script", "style", "noscript")
    drop: tuple[str, ...] = ()
    #: Boxes of this selector whose first line is one of these heads.
    noise_box: str | None = None
    noise_heads: frozenset[str] = frozenset()
    separator: str = "\n"
    #: Taken out where they match; ^ is the text's start.
    trim: tuple[str, ...] = ()
    title: str = "h1"
    title_separator: str = ""
    #: The title ends before this.
    title_until: str | None = None
    min_chars: int = 300
    #: Metadata from (url, title).
    metadata: Callable[[str, str | None], dict] = field(default=lambda url, title: {})


def extract_page(html: str | None, url: str, spec: ExtractSpec) -> tuple[str | None, str, dict]:
    """(title, body, metadata) of a page; (None, '', {...}) where there is nothing."""
    root = dom.parse(html or "")
    e = root.first(spec.title)
    title = clean(e.text(spec.title_separator)) if e is not None else None
    if title and spec.title_until:
        title = title.split(spec.title_until)[0].strip()
    title = title or None
    main = root.first(*spec.main)
    body = ""
    if main is not None:
        gone = [x for x in main.walk() if x.name in spec.drop_tags or any(x.matches(s) for s in spec.drop)]
        for x in gone:
            x.drop()
        if spec.noise_box:
            for x in main.select(spec.noise_box):
                if x.text("\n").split("\n", 1)[0].strip() in spec.noise_heads:
                    x.drop()
        body = main.text(spec.separator)
        for pattern in spec.trim:
            body = re.sub(pattern, "", body)
        body = clean(body)
    return title, body, spec.metadata(url, title)


def html_to_text(html: Column, prefer_main: bool = True, min_paragraph: int = MIN_PARAGRAPH) -> Column:
    @arrow_udf("string")
    def run(x: pa.Array) -> pa.Array:
        return pa.array([read_page(s, prefer_main, min_paragraph) for s in x.to_pylist()], pa.string())

    return run(html)


def extract(df: DataFrame, specs: dict[str, ExtractSpec]) -> DataFrame:
    """df's (source, source_url, html, ...) with title, raw and doc_metadata (JSON) by the source's specification.

    Rows whose body is shorter than the source's least length, and rows of a source without specification, are left out. A column
    called title, raw or doc_metadata is replaced.
    """

    @arrow_udf("struct<title:string,raw:string,meta:string>")
    def run(source: pa.Array, url: pa.Array, html: pa.Array) -> pa.Array:
        out = []
        for s, u, h in zip(source.to_pylist(), url.to_pylist(), html.to_pylist()):
            if s not in specs:
                out.append(None)
                continue
            title, body, meta = extract_page(h, u or "", specs[s])
            out.append({"title": title, "raw": body, "meta": json.dumps(meta, ensure_ascii=False)})
        return pa.array(out, pa.struct([("title", pa.string()), ("raw", pa.string()), ("meta", pa.string())]))

    least = F.create_map(*[x for k, s in specs.items() for x in (F.lit(k), F.lit(s.min_chars))])
    got = df.withColumn("_x", run("source", "source_url", "html")).where(F.col("_x").isNotNull() & (F.length("_x.raw") >= F.try_element_at(least, F.col("source"))))
    return got.withColumns({"title": F.col("_x.title"), "raw": F.col("_x.raw"), "doc_metadata": F.col("_x.meta")}).drop("_x", "html")


def clean_raw(raw: Column, content_kind: Column) -> Column:
    """Fetched content to text: pages are read, plain text is cleaned, both deduplicated line by line and cleaned once more."""
    first = F.when(content_kind == "html", html_to_text(raw)).otherwise(T.clean_text(raw))
    return T.clean_text(T.dedupe_lines(first))


def merge_pages(pages: DataFrame, min_part: int = 120) -> DataFrame:
    """(source, doc_key, raw, sub_pages) of df's (source, doc_key, part, source_url, text): part 0, then the further parts longer than min_part, in order.

    One document's parts meet in one row, which is bounded by what one document has.
    """
    kept = pages.where((F.col("part") == 0) | (F.length("text") > min_part))
    parts = F.array_sort(F.collect_list(F.struct("part", "text", "source_url")))
    g = kept.groupBy("source", "doc_key").agg(parts.alias("p"))
    return g.select(
        "source",
        "doc_key",
        F.array_join(F.filter(F.transform("p", lambda x: x["text"]), lambda t: t != ""), "\n\n").alias("raw"),
        F.transform(F.filter("p", lambda x: x["part"] > 0), lambda x: x["source_url"]).alias("sub_pages"),
    )
