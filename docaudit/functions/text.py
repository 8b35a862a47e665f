"""Columns over text: normal forms, tokens, sentences, terms, cuts and headings.

All are built from Spark expressions and stay in the JVM (those over arrays are interpreted, not
generated); only Unicode compatibility forms and places of matches need an Arrow UDF. Null text
counts as empty unless stated otherwise.
"""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docaudit import dictionaries as D

SPACES = r"[\t-\r\x{85}\p{Z}]+"  # Unicode white space, spelt so that Java and RE2 read it alike
CJK_RUN = r"[\x{4e00}-\x{9fff}]{2,}"


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def first(items: Column, most: int | None) -> Column:
    """The first ``most`` items of an array, all of them with None."""
    return items if most is None else F.slice(items, 1, most)


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility composition, which Spark has no builtin for; null stays null."""
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def collapse_spaces(text: Column | str) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text_or_empty(text), SPACES, " "))


def normalize_text(text: Column | str, compatibility: bool = True) -> Column:
    """Lower case with single spaces, after NFKC if ``compatibility``."""
    base = text_or_empty(text)
    return collapse_spaces(F.lower(nfkc(base) if compatibility else base))


def token_set(normal: Column, stopwords: list[str] = D.STOPWORDS, pattern: str = rf"{CJK_RUN}|[a-z0-9][a-z0-9_\-./%]*") -> Column:
    """Distinct tokens of normalised text: runs of two or more ideographs, or words of two or more characters."""
    found = F.regexp_extract_all(normal, F.lit(f"({pattern})"), 1)
    return F.array_except(F.filter(found, lambda t: F.length(t) > 1), F.array(*map(F.lit, stopwords)))


def chart_tokens(normal: Column, stopwords: list[str] = D.CHART_STOPWORDS) -> Column:
    """Distinct tokens that charts are matched by: runs of two or more ideographs, or of three or more letters and digits."""
    return token_set(normal, stopwords, D.CHART_TOKEN)


def overlap_ratio(expected: Column, observed: Column) -> Column:
    """Share of the expected tokens that were observed; 0 without expected ones."""
    n = F.size(expected)
    return F.when(n > 0, F.size(F.array_intersect(expected, observed)) / n).otherwise(F.lit(0.0))


def contains_fuzzy(needle: Column, haystack: Column, threshold: float = 0.42) -> Column:
    """Whether a normalised text contains another, or enough of its tokens."""
    within = F.contains(haystack, needle) | (overlap_ratio(token_set(needle), token_set(haystack)) >= threshold)
    return (needle != "") & within


def split_sentences(text: Column | str, shortest: int = 25, longest: int | None = None, most: int | None = None) -> Column:
    """Sentences behind sentence ends or line breaks, of at least ``shortest`` characters.

    All of them and whole, or the first ``most``, each cut to ``longest`` (1,200 and 1,000 in the published SQL).
    """
    raw = F.split(text_or_empty(text), r"(?<=[。！？.!?])[\t-\r\x{85}\p{Z}]+|\n+")
    trimmed = F.transform(raw, lambda s: F.regexp_replace(s, r"^[\t-\r\x{85}\p{Z}]+|[\t-\r\x{85}\p{Z}]+$", ""))
    kept = F.filter(trimmed, lambda s: F.length(s) >= shortest)
    return first(kept if longest is None else F.transform(kept, lambda s: F.substring(s, 1, longest)), most)


def fingerprint(text: Column) -> Column:
    """Letters and digits only: equal for texts that differ in punctuation or spacing."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")


def matching(sentences: Column, terms: list[str]) -> Column:
    """The sentences that contain any of the terms, case folded."""
    listed = F.array(*map(F.lit, terms))
    return F.filter(sentences, lambda s: F.exists(listed, lambda t: F.contains(F.lower(s), t)))


def term_hits(normal: Column, terms: list[str]) -> Column:
    """The terms that occur anywhere in a normalised text, also within words."""
    return F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(normal, t))


def distinct_hits(normal: Column, terms: list[str]) -> Column:
    """How many of the terms occur."""
    return F.size(term_hits(normal, terms))


def occurrences(normal: Column, terms: list[str]) -> Column:
    """How often the terms occur together, overlaps of one term with itself not counted."""
    counts = [((F.length(normal) - F.length(F.replace(normal, F.lit(t), F.lit("")))) / len(t)).cast("int") for t in terms]
    return sum(counts[1:], counts[0])


def group_coverage(normal: Column, groups: dict[str, list[str]] = D.SECTION_GROUPS) -> Column:
    """Share of the groups of which some term occurs."""
    hits = [F.greatest(*(F.contains(normal, F.lit(t)).cast("int") for t in terms), F.lit(0)) for terms in groups.values()]
    return sum(hits[1:], hits[0]) / len(groups)


def compact(text: Column | str, most: int, head: float = 0.72, tail: float = 0.18, note: str = "\n\n[... middle omitted for token control ...]\n\n") -> Column:
    """A text within ``most`` characters, or its head and tail with a note between."""
    t = text_or_empty(text)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.substring(t, 1, int(most * head)), F.lit(note), F.right(t, F.lit(int(most * tail)))))


def shorten(text: Column | str, most: int) -> Column:
    """A text within ``most`` characters, or its start with a note of how much is missing."""
    t = text_or_empty(text)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.substring(t, 1, most), F.lit("...[truncated "), (F.length(t) - most).cast("string"), F.lit(" chars]")))


def slug(text: Column | str, longest: int = 80, default: str = "item") -> Column:
    """Lower case letters, digits and ideographs with single hyphens between; ``default`` if nothing is left."""
    s = F.btrim(F.regexp_replace(F.lower(text_or_empty(text)), r"[^a-z0-9\x{4e00}-\x{9fff}]+", "-"), F.lit("-"))
    s = F.btrim(F.substring(s, 1, longest), F.lit("-"))
    return F.when(s == "", F.lit(default)).otherwise(s)


def lines(text: Column | str) -> Column:
    """The lines of a text without white space around them, blank ones left out."""
    trimmed = F.transform(F.split(text_or_empty(text), "\n"), lambda s: F.regexp_replace(s, r"^[\t-\r\x{85}\p{Z}]+|[\t-\r\x{85}\p{Z}]+$", ""))
    return F.filter(trimmed, lambda s: s != "")


def headings(text: Column | str, most: int | None = None, longest: int = 110, words: int = 12, topics: list[str] | None = None) -> Column:
    """Lines that look like headings: short, without a sentence end, in title or upper case, numbered or with a topic word.

    All of them, or the first ``most``.
    """
    topics = topics or ["outlook", "summary", "risk", "scenario", "strategy", "展望", "风险", "观点", "小结", "情景"]
    marked = F.array(*map(F.lit, topics))

    def is_heading(s: Column) -> Column:
        cased = (F.initcap(F.lower(s)) == s) | ((F.upper(s) == s) & s.rlike("[A-Z]")) | s.rlike(r"^\d+[.、)]")
        topical = F.exists(marked, lambda t: F.contains(F.lower(s), t))
        return (F.length(s) <= longest) & (F.size(F.split(s, " ")) <= words) & ~s.rlike(r"[.。!?！？;；,，]$") & (cased | topical)

    return first(F.filter(lines(text), is_heading), most)


def infer_title(text: Column | str, fallback: Column | None = None, shortest: int = 4, longest: int = 160) -> Column:
    """The first line of a fitting length, else ``fallback``."""
    first = F.try_element_at(F.filter(lines(text), lambda s: (F.length(s) >= shortest) & (F.length(s) <= longest)), F.lit(1))
    return F.coalesce(first, fallback if fallback is not None else F.lit(None).cast("string"))


def source_note(text: Column | str, longest: int = 220) -> Column:
    """The first statement of a source, empty without one."""
    return F.substring(F.regexp_extract(text_or_empty(text), r"(?i)((?:sources?|data source|资料来源|数据来源|来源)[ \t]*[:：-][^\n]+)", 1), 1, longest)


def source_statements(text: Column | str, longest: int | None = None) -> Column:
    """All statements of a source in the order they come, each to the end of its line or of ``longest`` characters (220 in the reference)."""
    rest = ".+" if longest is None else f".{{1,{longest}}}"
    return F.regexp_extract_all(text_or_empty(text), F.lit(f"(?iUd)({D.SOURCE_STATEMENT.replace('{rest}', rest)})"), 1)


def unit_hints(text: Column | str) -> Column:
    """Distinct unit words of a text in the order they come."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(r"(%|bps|bp|usd|eur|cny|rmb|billion|million|亿元|万元|倍|个百分点|个基点)"), 1))


def trim_at_markers(text: Column | str, markers: list[str], least: int = 1800, share: float = 0.2) -> Column:
    """A text cut at the first marker that stands behind the first ``least`` characters or ``share`` of it, whichever is more."""
    t = text_or_empty(text)
    start = F.greatest(F.lit(least), F.floor(F.length(t) * share).cast("int"))
    low = F.lower(t)
    found = [F.nullif(F.locate(m, F.substring(low, start + 1, F.length(low))), F.lit(0)) for m in markers]
    first = F.least(*found) if len(found) > 1 else found[0]
    return F.when(first.isNotNull() & (F.length(t) > start), F.rtrim(F.substring(t, F.lit(1), start + first - 1))).otherwise(t)


def match_starts(text: Column, pattern: str) -> Column:
    """Where the matches of a pattern begin, from 0."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def starts(texts: pd.Series) -> pd.Series:
        wanted = re.compile(pattern)
        return texts.map(lambda t: [m.start() for m in wanted.finditer(t)], na_action="ignore")

    return starts(text)


def trim_boilerplate(text: Column | str, markers: list[str] = D.BOUNDARY_MARKERS, cards: str = D.RELATED_CARD, least: int = 1800, share: float = 0.2, least_cards: int = 2) -> Column:
    """A text in single spaces, cut where its tail begins: at the first marker or, if there are ``least_cards`` of them, the first card.

    Only what stands behind the first ``least`` characters or ``share`` of the text, whichever is more, counts; case matters.
    """
    t = collapse_spaces(text)
    start = F.greatest(F.lit(least), F.floor(F.length(t) * share).cast("int"))
    tail = F.substring(t, start + 1, F.length(t))
    marked = [F.nullif(F.locate(m, tail), F.lit(0)) + start - 1 for m in markers]
    found = F.filter(match_starts(t, cards), lambda p: p >= start)
    carded = F.when(F.size(found) >= least_cards, F.get(found, F.lit(0)))
    cut = F.least(*marked, carded, F.lit(None).cast("int"))
    return F.when(cut.isNotNull(), F.trim(F.substring(t, F.lit(1), cut))).otherwise(t)


def mojibake_ratio(text: Column | str, markers: list[str] = D.MOJIBAKE_MARKERS) -> Column:
    """Marks of wrong decoding per character; 0 for empty text."""
    t = text_or_empty(text)
    return F.when(F.length(t) > 0, occurrences(t, markers) / F.length(t)).otherwise(F.lit(0.0))


def _repaired(t: str) -> str:
    for table in ("cp1252", "latin-1"):
        try:
            fixed = t.encode(table).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if fixed != t:
            return fixed
    return t


@F.pandas_udf(T.StringType())
def repair_mojibake(texts: pd.Series) -> pd.Series:
    """UTF-8 read as Windows-1252 or Latin-1 put right where that is possible without loss; else unchanged."""
    return texts.map(_repaired, na_action="ignore")


def repair_nested(df: DataFrame) -> DataFrame:
    """``df`` with all its strings repaired, also those within arrays, structs and values of maps.

    A column that holds strings deeper down goes through JSON and back, which keeps its type; names of fields and keys
    of maps stay as they are. Columns without strings are not touched.
    """

    def holds_text(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return any(holds_text(f.dataType) for f in kind.fields)
        inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType if isinstance(kind, T.MapType) else kind
        return isinstance(kind, T.StringType) or inner is not kind and holds_text(inner)

    def nested(kind: T.DataType):
        @F.pandas_udf(T.StringType())
        def run(values: pd.Series) -> pd.Series:
            def walk(v):
                if isinstance(v, dict):
                    return {k: walk(x) for k, x in v.items()}
                if isinstance(v, list):
                    return [walk(x) for x in v]
                return _repaired(v) if isinstance(v, str) else v

            return values.map(lambda t: json.dumps(walk(json.loads(t)), ensure_ascii=False), na_action="ignore")

        return run

    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = repair_mojibake(c)
        elif holds_text(f.dataType):
            c = F.from_json(nested(f.dataType)(F.to_json(c, {"ignoreNullFields": "false"})), f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def estimate_tokens(text: Column | str) -> Column:
    """A quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), (F.length(text_or_empty(text)) / 4).cast("int"))


def blob(*parts: Column | str) -> Column:
    """Non-null parts with single spaces between."""
    return collapse_spaces(F.concat_ws(" ", *parts))


def chunk_paragraphs(text: Column | str, size: int = 900, most: int | None = None) -> Column:
    """Paragraphs packed in order into chunks of up to ``size`` characters; a longer paragraph is a chunk of its own.

    All of them, or the first ``most`` (80 in the reference). Null, empty and blank texts have none.
    """
    t = text_or_empty(text)
    paragraphs = F.filter(F.transform(F.split(t, r"\n[\t-\r\x{85}\p{Z}]*\n+"), lambda p: F.trim(p)), lambda p: p != "")
    empty = F.array().cast("array<string>")

    def add(done: Column, p: Column) -> Column:
        last = F.element_at(done, -1)
        fits = (F.size(done) > 0) & (F.length(last) + F.length(p) <= size)
        head = F.slice(done, F.lit(1), F.size(done) - 1)
        more = F.when(fits, F.concat(head, F.array(F.concat(last, F.lit("\n"), p)))).otherwise(F.concat(done, F.array(p)))
        return more if most is None else F.when(F.size(done) > most, done).otherwise(more)  # what comes later is not asked for

    return first(F.aggregate(paragraphs, empty, add), most)
