"""Classifications of reports, files, charts and pages by rules given as data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import numbers as N
from docaudit.functions import text as X
from docaudit.operators.rules import first_rule, holding, keyword_vote, points, reasons, tiers, true


def cjk_count(text: Column) -> Column:
    return F.regexp_count(X.text_or_empty(text), F.lit(r"[\x{4e00}-\x{9fff}]"))


def zh_or_en(text: Column, least: int = 20, share: float = 0.08) -> Column:
    """``zh`` with enough ideographs, also against the Latin letters; else ``en``."""
    latin = F.regexp_count(X.text_or_empty(text), F.lit("[A-Za-z]"))
    return F.when((cjk_count(text) >= least) & (cjk_count(text) >= latin * share), "zh").otherwise("en")


def declared_zh_or_en(declared: Column, text: Column, least: int = 80, share: float = 0.2, prefix: int | None = None) -> Column:
    """The language a page declares; without one ``zh`` for more ideographs than ``least`` and than ``share`` of the Latin letters.

    The whole text counts, or its first ``prefix`` characters (12,000 in the reference).
    """
    t = X.text_or_empty(text) if prefix is None else F.substring(X.text_or_empty(text), 1, prefix)
    ideographs, latin = F.regexp_count(t, F.lit(r"[\x{3400}-\x{9fff}]")), F.regexp_count(t, F.lit("[A-Za-z]"))
    low = F.lower(declared)
    return first_rule([(low.startswith("zh"), "zh"), (low.startswith("en"), "en"), (ideographs > F.greatest(F.lit(least), latin * share), "zh")], "en")


def source_zh_or_en(country: Column, text: Column, chinese: tuple[str, ...] = ("cn", "china", "中国"), more_than: int = 20) -> Column:
    """``zh`` for sources of a Chinese country or with more than a few ideographs, else ``en``."""
    return first_rule([(F.lower(F.trim(country)).isin(*chinese), "zh"), (cjk_count(text) > more_than, "zh")], "en")


def parse_quality(text: Column, failed: Column | None = None, most_mojibake: float = 0.01) -> Column:
    """From the length of the extracted text; poor if it looks wrongly decoded, failed without text but with a warning."""
    n = F.length(X.text_or_empty(text))
    return first_rule([((failed if failed is not None else F.lit(False)) & (n == 0), "failed"), (X.mojibake_ratio(text) > most_mojibake, "poor"), (n > 12000, "excellent"), (n > 5000, "good"), (n > 1000, "fair")], "poor")


def subtype(title: Column, text: Column, keywords: dict[str, list[str]], default: str, prefix: int | None = None) -> Column:
    """The subtype most of whose keywords occur in the title and the text; of equals the first.

    The whole text, or its first ``prefix`` characters (3,000 in the reference).
    """
    t = X.text_or_empty(text)
    return keyword_vote(F.concat_ws(" ", title, t if prefix is None else F.substring(t, 1, prefix)), keywords, default)


def size_tier(size: Column, pages: Column, quality: Column, kind: Column, deep_kinds: list[str]) -> Column:
    """A to C by points for size, pages, kind and parse quality; Reject for what could not be parsed."""
    score = points([(size >= 500_000, 1), (pages >= 8, 1), (pages >= 20, 1), (kind.isin(deep_kinds), 1), (quality == "good", 1)])
    graded = tiers(score, [(4, "A"), (2, "B")], "C")
    return F.when(true(quality == "failed") | true(pages == 0), "Reject").when(true(quality == "poor"), "C").otherwise(graded)


def fact_importance(claim: Column, strategy_terms: list[str] | None = None) -> Column:
    """A claim with numbers is critical, one with a recommendation major, others are plain facts."""
    low = F.lower(X.text_or_empty(claim))
    words = strategy_terms or ["recommend", "建议", "关注", "配置"]
    speaks = F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))
    return first_rule([(F.size(N.extract_numbers(claim)) > 0, "critical_numeric"), (speaks, "major_strategy")], "major_fact")


def has_numeric_context(sentence: Column, signs: dict[str, str] = D.NUMERIC_CONTEXT, least: int = 2) -> Column:
    """Whether enough of the signs that give a number a context are there: a unit, a date, a direction, a name."""
    return holding([sentence.rlike(pattern) for pattern in signs.values()]) >= least


def numeric_objections(sentence: Column, unit: str = D.NUMERIC_UNIT) -> Column:
    """Why the numbers of a sentence say nothing, as codes; empty for telling numbers and for sentences without any."""
    low = F.lower(sentence)
    numbers = N.extract_numbers(sentence)
    values = F.filter(F.transform(numbers, N.numeric_scalar), lambda v: v.isNotNull())
    others = F.filter(values, lambda v: ~v.between(*D.YEARS))
    bare = ~sentence.rlike(unit) & (F.size(values) > 0)
    return reasons(
        [
            (sentence.rlike(D.DOCUMENT_CODE), "document_code"),
            (F.exists(F.array(*map(F.lit, D.IMPRINT_TERMS)), lambda t: F.contains(low, t)), "imprint"),
            (bare & (F.size(others) == 0), "only_years"),
            (bare & F.forall(values, lambda v: F.abs(v) <= D.TINY), "only_tiny"),
            (~sentence.rlike(unit) & (F.size(numbers) >= D.MANY_NUMBERS) & (F.size(others) <= D.FEW_OTHERS), "many_years"),
        ]
    )


def analytical_numeric(sentence: Column) -> Column:
    """Whether a sentence has numbers and nothing speaks against them."""
    return F.coalesce((F.size(N.extract_numbers(sentence)) > 0) & (F.size(numeric_objections(sentence)) == 0), F.lit(False))


def crop_flags(box: Column, page: Column) -> Column:
    """What is wrong with a crop: too small, nearly the whole page, touching the edge, extreme shape."""
    from docaudit.functions import geometry as G

    share = G.area(box) / F.nullif(G.area(page), F.lit(0.0))
    width, height = G.side(box, 2) - G.side(box, 0), G.side(box, 3) - G.side(box, 1)
    aspect = F.greatest(width, height) / F.nullif(F.least(width, height), F.lit(0.0))
    edge = (G.side(box, 0) <= G.side(page, 0)) | (G.side(box, 1) <= G.side(page, 1)) | (G.side(box, 2) >= G.side(page, 2)) | (G.side(box, 3) >= G.side(page, 3))
    return reasons([(box.isNull(), "no_box"), (share < 0.02, "too_small"), (share > 0.85, "whole_page"), (edge, "touches_edge"), (aspect > 8, "extreme_shape")])


def chart_kind(text: Column) -> Column:
    """A chart's kind by the words around it."""
    low = F.lower(X.text_or_empty(text))
    return first_rule([(low.rlike(r"\b(table|tabelle|tableau|tabla)\b|表"), "table"), (low.rlike(r"\b(line|path|trend|verlauf)\b|走势|路径"), "line"), (low.rlike(r"\b(bar|column|balken)\b|柱"), "bar"), (low.rlike(r"\b(pie|share|anteil)\b|占比"), "pie")], "other")


def admission_errors(checks: list[tuple[Column, str]]) -> tuple[Column, Column]:
    """The error codes of a row, and whether it is admitted: without any."""
    errors = reasons(checks)
    return errors, F.size(errors) == 0


def redline_decision(matched: Column, context: Column, hard: list[str], negations: list[str]) -> Column:
    """A blocker for a hard term without a negation around it, else for review."""
    low, m = F.lower(X.text_or_empty(context)), F.lower(X.text_or_empty(matched))
    negated = F.exists(F.array(*map(F.lit, negations)), lambda t: F.contains(low, t))
    direct = F.exists(F.array(*map(F.lit, hard)), lambda t: F.contains(m, t))
    return first_rule([(negated, "needs_review"), (direct, "blocker")], "needs_review")


def article_assessment(metrics: dict[str, Column], signals: Column, title: Column, least_length: int = 600, generic_titles: tuple[str, ...] = ("home", "insights", "research", "")) -> dict[str, Column]:
    """Whether a page is an article, with a score from 0 to 100 and the reasons against it, from ``html.page_metrics``."""
    from docaudit.operators.filters import generic_title

    m = metrics
    against = reasons(
        [
            (m["text_length"] < least_length, "too_short"),
            (m["paragraphs"] < 3, "few_paragraphs"),
            (m["long_paragraphs"] < 1, "no_long_paragraph"),
            (m["link_ratio"] > 0.55, "link_heavy"),
            (m["list_items"] > 3 * (m["paragraphs"] + 1), "list_page"),
            (signals < 1, "no_signals"),
            (generic_title(F.coalesce(title, F.lit("")), list(generic_titles)), "generic_title"),
        ]
    )
    score = 35 * N.saturation(m["text_length"], 4000) + 25 * N.saturation(m["long_paragraphs"], 5) + 20 * (1 - N.clamp(m["link_ratio"])) + 20 * N.saturation(signals, 4)
    return {"score": F.round(score, 2), "reject_reasons": against, "article_like": F.size(against) == 0}


def coverage_status(found: Column, checked: Column, failed: Column) -> Column:
    """How far the visuals of a report were checked: none found, none checked, in part, with failures, in full."""
    return first_rule([(found == 0, "none_found"), (checked == 0, "not_checked"), (failed > 0, "with_failures"), (checked < found, "in_part")], "in_full")


def page_kind(text_length: Column, visuals: Column, largest_share: Column) -> Column:
    """A page's kind by how much text and how large visuals it has."""
    return first_rule([((text_length < 80) & (visuals == 0), "blank"), (largest_share > 0.6, "full_visual"), ((visuals > 0) & (text_length > 400), "mixed"), (visuals > 0, "visual"), (text_length > 400, "text")], "sparse")


def priority(rank: Column, module_low: Column) -> Column:
    """Urgency of an issue from the rank of its severity, one step lower for modules that matter less."""
    step = rank + F.when(true(module_low), 1).otherwise(0)
    return first_rule([(step <= 0, "P0"), (step == 1, "P1"), (step == 2, "P2")], "P3")
