"""Queries that cannot be SQL, against the same rules as plain loops over whole tables."""

import hashlib
import re
import unicodedata

import duckdb
import pytest

from docaudit import dictionaries as D
from docaudit.plans import catalog

SPACE = re.compile(r"[\t-\r\x85\x20\xa0  -     　]+")


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def distinct(values):
    return list(dict.fromkeys(values))


@pytest.fixture(scope="module")
def tables(data):
    return lambda name, *columns: duckdb.sql(f"select {', '.join(columns)} from '{data}/{name}.parquet'").fetchall()


def text_normalized(tables):
    for i, t in tables("documents", "doc_id", "text"):
        n = SPACE.sub(" ", unicodedata.normalize("NFKC", t or "").lower()).strip(" ")
        yield i, len(n), md5(n)


def numbers_extracted(tables):
    pattern = re.compile(D.NUMBER_PATTERN, re.I)
    for i, t in tables("article_quality", "article_id", "text_preview"):
        found = distinct(re.sub(r"\s+", "", m.group()) for m in pattern.finditer(t or ""))
        yield i, len(found), "|".join(found)


def dates_extracted(tables):
    for i, t in tables("documents", "doc_id", "text"):
        found = [m.group() for m in re.finditer(D.DATE_PATTERN, t or "", re.I)]
        yield i, len(found), "|".join(found)


def quantities_parsed(tables):
    spelt = "|".join(map(re.escape, sorted(D.QUANTITY_UNITS, key=len, reverse=True)))
    pattern = re.compile(rf"(?<![\w.])((?:(?<!%)-|\+)?[0-9]+(?:,[0-9]{{3}})*(?:\.[0-9]+)?)(?:\s*({spelt}))?", re.I)
    for i, t in tables("chart_candidates", "chart_row_id", "nearby_text"):
        for pos, (raw, number, unit) in enumerate(distinct((m.group(), m.group(1), m.group(2) or "") for m in pattern.finditer(t or "")), 1):
            kind, size = D.QUANTITY_UNITS.get(unit.lower(), ("plain", 1.0))
            yield i, pos, raw, kind, round(float(number.replace(",", "")) * size, 6)


def redline_spans(tables):
    patterns = [r"\bguarante\w+\b", r"\brisk[- ]free\b", r"\bmust buy\b", r"\badd on weakness\b", r"无风险", r"保证收益", r"分批增加", r"garantiz\w+", r"garanti\w*"]
    for i, t in tables("documents", "doc_id", "text"):
        for m in re.finditer("|".join(patterns), t or "", re.I):
            around = SPACE.sub(" ", t[max(0, m.start() - 140) : m.end() + 140]).lower()
            negated = any(x in around for x in ("not guarantee", "no guarantee", "不保证", "keine garantie"))
            hard = any(x in m.group().lower() for x in ("must buy", "guaranteed return", "保证收益"))
            yield i, m.group(), m.start(), m.end(), "blocker" if hard and not negated else "needs_review"


def paragraph_chunks(tables):
    for i, t in tables("extracted_documents", "extract_id", "text_excerpt"):
        chunks: list[str] = []
        for p in (x.strip(" ") for x in re.split(r"\n[\t-\r\x85\x20\xa0 - 　]*\n+", t or "")):
            if p and chunks and len(chunks[-1]) + len(p) <= 900:
                chunks[-1] += "\n" + p
            elif p:
                chunks.append(p)
        yield from ((i, n, len(c), md5(c)) for n, c in enumerate(chunks, 1))


def quota_selection(tables):
    rows = tables("golden_manifest", "manifest_id", "coalesce(nullif(trim(institution_name),''),'unknown')", "coalesce(nullif(trim(strategy_subtype),''),'unknown')", "source_sha256", "coalesce(key_fact_count,0)")
    used, seen, taken = {}, set(), 0
    for i, inst, sub, sha, _ in sorted(rows, key=lambda r: (-r[4], r[0])):
        if taken < 60 and sha not in seen and used.get(inst, 0) < 2 and used.get(("s", sub), 0) < 12:
            used[inst], used["s", sub], taken = used.get(inst, 0) + 1, used.get(("s", sub), 0) + 1, taken + 1
            seen |= {sha} - {None}
            yield i, inst, sub


@pytest.mark.parametrize("plain", [text_normalized, numbers_extracted, dates_extracted, quantities_parsed, redline_spans, paragraph_chunks, quota_selection])
def test_query_like_plain_loop(spark, data, tables, plain):
    got = sorted((tuple(r) for r in catalog.queries()[plain.__name__](spark, data).collect()), key=repr)
    want = sorted(plain(tables), key=repr)
    assert len(got) == len(want) > 0 and got == want
