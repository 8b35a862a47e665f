"""Assessment of web pages, pages of reports, visuals and facts: evidence as named conditions with points.

An assessment is built from ``Evidence``: conditions that exclude each other within a group, each with its points and a
code. What comes out is a struct of the score and the codes that held, so that a decision can be traced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import numbers as N
from docaudit.functions import text as X
from docaudit.operators.filters import generic_title
from docaudit.operators.rules import first_rule, reasons, true

Evidence = list[list[tuple[Column, float, str]]]


def weighed(groups: Evidence) -> tuple[Column, Column]:
    """The points of the first condition that holds in each group, added up, and the codes of those conditions."""
    points, codes = [], []
    for group in groups:
        point, code = F.lit(0.0), F.lit(None).cast("string")
        for condition, value, name in reversed(group):
            point = F.when(condition, F.lit(float(value))).otherwise(point)
            code = F.when(condition, F.lit(name)).otherwise(code)
        points.append(point)
        codes.append(code)
    return reduce(lambda a, b: a + b, points), F.array_compact(F.array(*codes))


def _any(text: Column, terms: list[str]) -> Column:
    """Whether any of the terms occurs: one pattern, so that what makes the text is evaluated once, not for each term."""
    return text.rlike("|".join(rf"\Q{t}\E" for t in terms))


def article_reasons(language: Column, title: Column, url: Column, length: Column, ideographs: Column, long_paragraphs: Column, links: Column, link_ratio: Column, reports: Column, landings: Column, limits: dict = D.ARTICLE_LIMITS) -> Column:
    """Why a page is no article, as codes; null counts count as 0. The limits depend on whether the page is Chinese."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    n, long, ratio, linked, zh = zero(length), zero(long_paragraphs), zero(link_ratio), zero(links), true(language == "zh")
    limit = lambda name: F.when(zh, limits["zh"][name]).otherwise(limits["en"][name])
    named = F.lower(F.concat_ws(" ", url, title))
    return reasons(
        [
            (length.isNull(), "article_container_missing"),
            (n < limit("text"), "text_too_short"),
            (zh & (zero(ideographs) < limits["zh"]["ideographs"]), "zh_text_too_short"),
            (long < limit("long_paragraphs"), "paragraph_count_too_low"),
            (ratio > 0.28, "link_density_too_high"),
            ((linked > F.greatest(F.lit(80), long * 8)) & (ratio > 0.18), "navigation_heavy_page"),
            (true(generic_title(title, D.GENERIC_TITLES)) & (n < 6500), "generic_landing_title"),
            ((zero(landings) >= 4) & (long < 10), "landing_or_index_page"),
            (zero(reports) < 3, "weak_strategy_report_signals"),
            (_any(named, D.REJECTED_PAGE_TERMS), "non_report_page_type"),
            (n > 350_000, "page_text_implausibly_large"),
        ]
    )


def article_score(length: Column, long_paragraphs: Column, link_ratio: Column, reports: Column, landings: Column, visuals: Column) -> Column:
    """Points for length, long paragraphs, report words and visuals, less those for links and landing words: 0 to 100."""
    upto = lambda c, each, most: F.least(F.lit(float(most)), F.coalesce(c, F.lit(0)) * each)
    total = upto(length, 1 / 180, 35) + upto(long_paragraphs, 2.2, 25) + upto(reports, 3.0, 20) + upto(visuals, 1.5, 10) - upto(link_ratio, 70.0, 25) - upto(landings, 3.0, 20)
    return N.half_up(N.clamp(total, 0.0, 100.0), 2)


def report_likeness(text: Column, headings: Column, link_chars: Column, whole_length: Column) -> Column:
    """How much a page reads like a report: ``score``, ``reasons``, ``parse_quality`` and ``parse_status``."""
    t = X.text_or_empty(text)
    n, low = F.length(t), F.lower(t)
    density = link_chars / F.greatest(F.lit(1), F.coalesce(F.nullif(whole_length, F.lit(0)), n))
    words, furniture = X.distinct_hits(low, D.STRATEGY_TERMS), X.distinct_hits(low, D.NAVIGATION_TERMS)
    score, codes = weighed(
        [
            [(n >= 6000, 0.28, "long_enough_report_body"), (n >= 2500, 0.18, "moderate_report_body"), (n >= 1000, 0.08, "short_but_readable_body"), (F.lit(True), 0.0, "body_too_short")],
            [(headings >= 6, 0.18, "multiple_report_headings"), (headings >= 3, 0.10, "some_report_headings")],
            [(words >= 8, 0.28, "strong_strategy_term_coverage"), (words >= 4, 0.18, "moderate_strategy_term_coverage"), (words >= 2, 0.08, "weak_strategy_term_coverage")],
            [(t.rlike(D.LIKENESS_NUMBERS), 0.12, "numeric_or_time_signals")],
            [(density <= 0.18, 0.10, "low_navigation_link_density"), (density >= 0.45, -0.18, "high_navigation_link_density")],
            [((furniture >= 6) & (n < 5000), -0.20, "navigation_or_landing_page_signals")],
        ]
    )
    likeness = N.half_up(N.clamp(score), 3)
    quality = first_rule([((n >= 2500) & (likeness >= 0.5), "good"), ((n >= 1000) & (likeness >= 0.3), "fair")], "poor")
    status = first_rule([(F.trim(t) == "", "empty_text"), (quality == "poor", "low_confidence")], "ok")
    return F.struct(likeness.alias("score"), codes.alias("reasons"), quality.alias("parse_quality"), status.alias("parse_status"))


def inventory(title: Column, url: Column, text: Column, length: Column, headings: Column, visuals: Column, tables: Column, remote: Column, missing: Column, wanted: Column, prefix: int | None = None) -> Column:
    """Whether a page is worth keeping: ``status``, ``reasons``, ``score``. The whole text is searched, or its first ``prefix`` characters."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    t = X.text_or_empty(text)
    words = F.lower(F.concat_ws(" ", title, url, t if prefix is None else F.substring(t, 1, prefix)))
    n, hits, listed = zero(length), X.distinct_hits(words, D.INVENTORY_TERMS), X.distinct_hits(words, D.LISTING_TERMS)
    against = reasons([(n < 1200, "too_short"), ((listed >= 2) & (n < 8000), "listing_page"), (hits < 2, "few_strategy_signals")])
    score = F.least(F.floor(n / 500), F.lit(30)) + F.least(hits * 4, F.lit(24)) + F.least(zero(headings), F.lit(10)) + F.least(zero(visuals) * 2, F.lit(16)) + F.least(zero(tables) * 2, F.lit(8))
    score = score - F.least(zero(remote), F.lit(20)) - F.least(zero(missing) * 2, F.lit(24)) + F.when(true(wanted), 30).otherwise(0) - F.when(F.size(against) > 0, 25).otherwise(0)
    out = F.exists(against, lambda r: r.isin("too_short", "listing_page"))
    status = first_rule([(out, "exclude_preliminary"), (true(wanted) | ((n >= 2500) & (hits >= 3)), "localize_priority")], "manual_review")
    return F.struct(status.alias("status"), against.alias("reasons"), score.cast("int").alias("score"))


def page_kind(text: Column, numbers: Column, visuals: Column, largest: Column, expected: Column, page: Column) -> Column:
    """What a page of a report is for: ``page_type``, ``action``, ``signals``, from its words, how many numbers and visuals it
    has, the share of its largest visual, and how many words it shares with expected charts. ``page`` counts from 1."""
    t = X.text_or_empty(text)
    chart, source, unit, contents, legal = (t.rlike(p) for p in (D.CHART_SIGNAL, D.SOURCE_SIGNAL, D.UNIT_SIGNAL, D.CONTENTS_SIGNAL, D.LEGAL_SIGNAL))
    n, usable, share, known = (F.coalesce(c, F.lit(0)) for c in (numbers, visuals, largest, expected))
    dense = (usable >= 4) | (share >= 0.08)
    signals = reasons([(known >= 3, "expected_chart_overlap"), (contents, "toc_terms"), (legal, "disclaimer_or_contact_terms"), (chart, "chart_terms"), (source, "source_terms"), (unit, "unit_terms"), (n >= 8, "number_dense"), (dense, "visual_density")])
    kind = first_rule(
        [
            (known >= 3, "expected_match_page"),
            (chart & (source | unit | (n >= 4) | dense), "analytical_visual_page"),
            (contents & (usable == 0) & (n <= 18) & (known == 0), "toc_or_figure_list"),
            (legal & ~chart & (share < 0.04) & (n < 8) & true(page > 3), "disclaimer_or_contact"),
            (dense | (n >= 10), "mixed_text_visual_page"),
        ],
        "unknown_keep_for_recall",
    )
    return F.struct(kind.alias("page_type"), F.when(kind.isin("toc_or_figure_list", "disclaimer_or_contact"), "skip").otherwise("keep").alias("action"), signals.alias("signals"))


def analytical_page(text: Column, numbers: Column) -> Column:
    """Whether a page has a chart to analyse: a source with a unit or four numbers, or a chart word with a unit and three numbers."""
    t = X.text_or_empty(text)
    source, chart, unit = (t.rlike(p) for p in (D.SOURCE_SIGNAL, D.CHART_SIGNAL, D.UNIT_SIGNAL))
    return (source & (unit | (numbers >= 4))) | (chart & unit & (numbers >= 3))


def chart_title(text: Column, longest: int = 240) -> Column:
    """Whether a short text is the title of a figure or table."""
    t = X.collapse_spaces(text)
    return (t != "") & (F.length(t) <= longest) & t.rlike(D.CHART_TITLE)


def running_footer(text: Column, longest: int = 120, pattern: str = D.RUNNING_FOOTER) -> Column:
    """Whether a line is the footer of a page: its number or a legal notice. Names of publishers go into ``pattern``."""
    t = X.collapse_spaces(text)
    return (F.length(t) <= longest) & t.rlike(pattern)


def visual_statistics(rows: DataFrame, by: list[str], box: Column, page: Column, smallest: float = 0.001, largest: float = 0.75) -> DataFrame:
    """``by, boxes, usable, max_share``: how many boxes a page has, how many of a usable size, and the share of the largest of those."""
    from docaudit.functions import geometry as G

    share = G.area(box) / F.nullif(G.area(page), F.lit(0.0))
    fits = true(share.between(smallest, largest))
    return rows.select(*by, box.alias("__b"), F.when(fits, share).alias("__s")).groupBy(*by).agg(F.count("__b").alias("boxes"), F.count("__s").alias("usable"), N.half_up(F.coalesce(F.max("__s"), F.lit(0.0)), 3).alias("max_share"))


def fact_role(claim: Column, given: Column, kind: Column) -> Column:
    """What a fact is for in an evaluation: as given, or by its words, numbers and kind."""
    low = X.collapse_spaces(F.lower(X.text_or_empty(claim)))
    numeric = true(F.lower(kind).isin("numeric", "financial_metric")) | (F.size(N.extract_numbers(claim)) > 0)
    rules = [(_any(low, D.FACT_COMPLIANCE_TERMS), "compliance_context"), (_any(low, D.FACT_METADATA_TERMS), "metadata_only"), (numeric, "numeric_fact"), (_any(low, D.FACT_STRATEGY_TERMS), "strategy_fact")]
    return F.coalesce(F.nullif(F.trim(given), F.lit("")), first_rule(rules, "core_fact"))


def page_artifact(title: Column, caption: Column, nearby: Column, role: Column, kind: Column) -> Column:
    """Whether a visual is part of the page rather than a chart: contents, legal notices, footers and sidebars."""
    head = F.lower(F.trim(F.coalesce(F.nullif(title, F.lit("")), X.text_or_empty(caption))))
    around = F.substring(F.lower(F.trim(X.text_or_empty(nearby))), 1, 240)
    place = F.lower(F.concat_ws(" ", role, kind))
    return _any(head, D.CONTENTS_TITLES) | _any(around, ["table of contents", "图表目录"]) | _any(head, D.LEGAL_TITLES) | _any(place, ["footer", "sidebar", "legal"]) | head.isin("cover", "toc")


def review_priority(c: dict[str, Column]) -> Column:
    """How much a visual needs a look by a judge: what it lacks, warnings, a doubtful crop or method. ``c`` has its columns by name."""
    text = lambda name: X.text_or_empty(c[name])
    many = lambda name: F.coalesce(F.size(c[name]), F.lit(0))
    doubtful = F.exists(F.array(*(true(F.try_element_at(c["crop_quality"], F.lit(k)) != 0) for k in ("oversized_visual", "narrow_crop", "low_confidence"))), lambda x: x)
    score, _ = weighed(
        [
            [(page_artifact(c["title"], c["caption"], c["nearby_text"], c["object_role"], c["chart_kind_hint"]), -3.0, "artifact")],
            [((text("title") == "") & (text("caption") == ""), 1.2, "no_title")],
            [(text("source_note") == "", 1.0, "no_source")],
            [((text("unit_hint") == "") & (many("numbers") > 0), 0.9, "no_unit")],
            [(many("dates") <= 0, 0.45, "no_dates")],
            [(doubtful, 1.2, "doubtful_crop")],
            [(_any(F.lower(text("detection_method")), ["fallback", "page_body", "merged", "broad"]), 0.8, "doubtful_method")],
            [(_any(F.lower(text("object_role")), ["page", "body", "visual"]), 0.25, "broad_role")],
            [(F.coalesce(c["object_count_on_page"], F.lit(0)) >= 2, 0.35, "crowded_page")],
            [(F.length(text("nearby_text")) < 80, 0.45, "little_text")],
            [(true(c["page"].isin(0, 1)), -0.15, "first_page")],
        ]
    )
    warned = F.when(many("warnings") > 0, 0.7 + 0.1 * F.least(F.lit(5), many("warnings"))).otherwise(F.lit(0.0))
    return N.half_up(score + warned, 3)


def expected_charts(charts: DataFrame, expected: DataFrame, key: str, chart_id: str, chart_tokens: Column, expected_text: str, least: int = 3, share: float = 0.45) -> DataFrame:
    """``key, chart_id, expected_match, shared``: for each chart the expected one of its report that it shares most words with.

    At least ``least`` words and ``share`` of those expected. Texts expected of a report are an array beside each of its charts,
    so charts and texts are crossed within the row, not by a shuffle. Ties go to the first text in order.
    """
    wanted = expected.select(key, F.col(expected_text).alias("__e")).where(F.col("__e").isNotNull()).distinct()
    wanted = wanted.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("__e").alias("text"), X.chart_tokens(X.collapse_spaces(F.lower("__e"))).alias("tokens")))).alias("__wanted"))
    rows = charts.select(key, chart_id, chart_tokens.alias("__t")).join(wanted, key, "left")

    def fit(e: Column, i: Column) -> Column:
        shared = F.size(F.array_intersect(e["tokens"], F.col("__t")))
        good = (shared >= least) & (shared >= share * F.size(e["tokens"]))
        return F.struct(F.when(good, -shared).otherwise(0).alias("minus"), i.alias("at"), e["text"].alias("text"))

    best = F.array_min(F.transform("__wanted", fit))
    return rows.select(key, chart_id, F.when(best["minus"] < 0, best["text"]).alias("expected_match"), F.coalesce(-best["minus"], F.lit(0)).alias("shared"))


def completeness(parts: dict[str, tuple[Column, int]]) -> Column:
    """The share of the parts of a line of reasoning that are there, each of at least so many characters."""
    there = [(F.length(X.text_or_empty(c)) >= n).cast("int") for c, n in parts.values()]
    return N.half_up(reduce(lambda a, b: a + b, there) / len(there), 3)


def patch_themes(dimensions: Column, codes: Column, low: dict[str, float], of_codes: dict[str, str], most: int = 8) -> Column:
    """What to work on next: the dimensions that are low, then themes of issue codes; at most ``most``."""
    weak = [(true(F.try_element_at(dimensions, F.lit(d)) < limit), d) for d, limit in low.items()]
    return reasons([*weak, *((F.array_contains(codes, code), theme) for code, theme in of_codes.items())], most)
