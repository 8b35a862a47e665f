"""HTML pages as columns: title, headings, text, links, blocks with tag paths, resources.

Parsing needs a tree, which Spark has no builtin for: one Arrow UDF on the standard parser, run
once per page, gives a struct that the rest works on with column expressions.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DROPPED = frozenset(["script", "style", "noscript", "svg", "template"])
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("address article aside blockquote body dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
RESOURCES = {"img": ("src", "srcset"), "source": ("src", "srcset"), "script": ("src",), "link": ("href",), "iframe": ("src",), "video": ("src", "poster"), "audio": ("src",), "object": ("data",)}
CSS_URL = re.compile(r"url\(\s*['\"]?([^'\")]+)['\"]?\s*\)")

_S = T.StringType
LINK = T.StructType([T.StructField("text", _S()), T.StructField("href", _S())])
NODE = T.StructType([T.StructField("path", _S()), T.StructField("text", _S()), T.StructField("link_chars", T.IntegerType())])
RESOURCE = T.StructType([T.StructField("tag", _S()), T.StructField("attr", _S()), T.StructField("value", _S())])
PAGE = T.StructType(
    [
        T.StructField("title", _S()),
        T.StructField("lang", _S()),
        T.StructField("published", _S()),
        T.StructField("headings", T.ArrayType(_S())),
        T.StructField("text", _S()),
        T.StructField("links", T.ArrayType(LINK)),
        T.StructField("blocks", T.ArrayType(NODE)),
        T.StructField("resources", T.ArrayType(RESOURCE)),
        T.StructField("tables", T.IntegerType()),
        T.StructField("images", T.IntegerType()),
        T.StructField("paragraphs", T.IntegerType()),
        T.StructField("list_items", T.IntegerType()),
    ]
)


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.dropped = 0
        self.title, self.lang, self.published = "", None, None
        self.headings: list[str] = []
        self.links: list[dict] = []
        self.blocks: list[dict] = []
        self.resources: list[dict] = []
        self.counts = dict.fromkeys(("table", "img", "p", "li"), 0)
        self.pieces: list[str] = []
        self.link_chars = 0
        self.link: dict | None = None

    def _close(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            tags = [t for t in self.stack if t not in ("html", "body", "a", "span", "b", "i", "em", "strong")]
            path = "/".join(tags[-6:])
            self.blocks.append({"path": path, "text": text, "link_chars": self.link_chars})
            if tags and tags[-1] in ("h1", "h2", "h3"):
                self.headings.append(text)
        self.pieces, self.link_chars = [], 0

    def handle_starttag(self, tag, attrs):
        values = {k: v or "" for k, v in attrs}
        for attr in RESOURCES.get(tag, ()):
            for part in values.get(attr, "").split(",") if attr == "srcset" else [values.get(attr, "")]:
                value = part.strip().split(" ")[0]
                if value:
                    self.resources.append({"tag": tag, "attr": attr, "value": value})
        for value in CSS_URL.findall(values.get("style", "")):
            self.resources.append({"tag": tag, "attr": "style", "value": value})
        if tag == "html" and values.get("lang"):
            self.lang = values["lang"]
        if tag == "meta" and values.get("property", values.get("name", "")).lower() in ("article:published_time", "date", "pubdate", "publishdate"):
            self.published = self.published or values.get("content")
        if tag == "time" and values.get("datetime"):
            self.published = self.published or values["datetime"]
        if tag in self.counts:
            self.counts[tag] += 1
        if tag in BLOCK:
            self._close()
        if tag == "br":
            self._close()
        if tag in DROPPED:
            self.dropped += 1
        if tag == "a":
            self.link = {"text": "", "href": values.get("href", "")}
        if tag not in VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag in DROPPED and self.dropped:
            self.dropped -= 1
        if tag in BLOCK:
            self._close()
        if tag == "a" and self.link:
            self.link["text"] = " ".join(self.link["text"].split())
            self.links.append(self.link)
            self.link = None
        if tag in self.stack:
            while self.stack and self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        if self.dropped:
            if self.stack and self.stack[-1] == "style":
                self.resources.extend({"tag": "style", "attr": "css", "value": v} for v in CSS_URL.findall(data))
            return
        if self.stack and self.stack[-1] == "title":
            self.title += data
            return
        self.pieces.append(data)
        if self.link is not None:
            self.link["text"] += data
            self.link_chars += len(data.strip())


def read_page(html: str | None) -> dict | None:
    """A page as a dictionary of PAGE; malformed markup is read as far as it goes. None stays None."""
    if html is None:
        return None
    reader = _Reader()
    try:
        reader.feed(html)
        reader.close()
    except (AssertionError, ValueError):
        pass
    reader._close()
    return {
        "title": " ".join(reader.title.split()),
        "lang": reader.lang,
        "published": reader.published,
        "headings": reader.headings,
        "text": "\n".join(b["text"] for b in reader.blocks),
        "links": reader.links,
        "blocks": reader.blocks,
        "resources": reader.resources,
        "tables": reader.counts["table"],
        "images": reader.counts["img"],
        "paragraphs": reader.counts["p"],
        "list_items": reader.counts["li"],
    }


@F.pandas_udf(PAGE)
def parse_html(pages: pd.Series) -> pd.DataFrame:
    rows = [read_page(h) or dict.fromkeys(PAGE.fieldNames()) for h in pages]
    return pd.DataFrame(rows, columns=PAGE.fieldNames()).astype({c: "Int32" for c in ("tables", "images", "paragraphs", "list_items")})


def link_text_ratio(page: Column) -> Column:
    """Characters within links over all characters of the blocks; 0 for an empty page."""
    chars = F.aggregate(page["blocks"], F.lit(0), lambda a, b: a + F.length(b["text"]))
    linked = F.aggregate(page["blocks"], F.lit(0), lambda a, b: a + b["link_chars"])
    return F.when(chars > 0, linked / chars).otherwise(F.lit(0.0))


def resource_status(value: Column) -> Column:
    """Where a resource lies: inline, remote, anchor or local."""
    v = F.lower(F.trim(value))
    return F.when(v.startswith("data:"), "inline").when(v.rlike("^(https?:)?//"), "remote").when(v.startswith("#"), "anchor").otherwise("local")


@F.pandas_udf(T.StructType([T.StructField("text", _S()), T.StructField("encoding", _S()), T.StructField("decode_errors", T.IntegerType()), T.StructField("fallback_used", T.BooleanType())]))
def decode_bytes(contents: pd.Series) -> pd.DataFrame:
    """Bytes as text by the first table that fits: UTF-8 with or without mark, GB18030, Latin-1."""
    out = []
    for raw in contents:
        if raw is None:
            out.append((None, None, None, None))
            continue
        for n, table in enumerate(("utf-8-sig", "gb18030", "latin-1")):
            try:
                out.append((bytes(raw).decode(table), "utf-8" if n == 0 else table, n, n > 0))
                break
            except UnicodeDecodeError:
                continue
    return pd.DataFrame(out, columns=["text", "encoding", "decode_errors", "fallback_used"]).astype({"decode_errors": "Int32"})


def page_metrics(page: Column) -> dict[str, Column]:
    """Measures of a parsed page by name: lengths, counts and the share of link text. A page that was null has 0 throughout."""
    zero = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    paragraphs = F.filter(page["blocks"], lambda b: b["path"].rlike("(^|/)p$"))
    return {
        "text_length": zero(F.length(page["text"])),
        "paragraphs": zero(F.size(F.coalesce(paragraphs, F.array().cast(paragraph_type())))),
        "long_paragraphs": zero(F.size(F.filter(F.coalesce(paragraphs, F.array().cast(paragraph_type())), lambda b: F.length(b["text"]) >= 120))),
        "headings": zero(F.when(page["headings"].isNotNull(), F.size(page["headings"]))),
        "links": zero(F.when(page["links"].isNotNull(), F.size(page["links"]))),
        "list_items": zero(page["list_items"]),
        "images": zero(page["images"]),
        "tables": zero(page["tables"]),
        "link_ratio": F.coalesce(link_text_ratio(page), F.lit(0.0)),
    }


def paragraph_type() -> T.ArrayType:
    return T.ArrayType(NODE)


@F.pandas_udf(_S())
def absolute_css(css: pd.Series, base: pd.Series) -> pd.Series:
    """Style text with its url() references made absolute against the base address of each row; data URIs and null stay."""
    from urllib.parse import urljoin

    def one(text: str | None, address: str | None) -> str | None:
        if text is None:
            return None
        return CSS_URL.sub(lambda m: m.group(0) if m.group(1).startswith("data:") else f'url("{urljoin(address or "", m.group(1).strip())}")', text)

    return pd.Series([one(t, a) for t, a in zip(css, base, strict=True)], dtype=object)
