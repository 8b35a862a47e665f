"""Pages, visuals and facts: decisions one by one, ties, nulls and empty tables."""

import pytest
from pyspark.sql import functions as F

from docaudit.operators import pages as P


def value(spark, column, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "claim,given,kind,role",
    [
        ("Past performance is no guide", None, None, "compliance_context"), ("Part of the spring series", None, None, "metadata_only"), ("Yields rose to 4.5%", None, None, "numeric_fact"), ("Nothing to count", None, "numeric", "numeric_fact"),
        ("We recommend gold", None, None, "strategy_fact"), ("建议关注黄金", "", None, "strategy_fact"), ("Growth slows", None, None, "core_fact"), ("Growth slows", " custom ", None, "custom"), (None, None, None, "core_fact"),
    ],
)
def test_roles(spark, claim, given, kind, role):
    assert value(spark, P.fact_role(F.col("c"), F.col("g"), F.col("k")), "c string, g string, k string", (claim, given, kind)) == role


def page(spark, text, numbers=0, visuals=0, largest=0.0, expected=0, number=5):
    r = value(spark, P.page_kind(F.lit(text), F.lit(numbers), F.lit(visuals), F.lit(largest), F.lit(expected), F.lit(number)))
    return r.page_type, r.action


def test_pages(spark):
    assert page(spark, "Table of contents", numbers=18) == ("analytical_visual_page", "keep")  # 'table' with numbers
    assert page(spark, "Contents\nRisks 3\nGold 4", numbers=2) == ("toc_or_figure_list", "skip")
    assert page(spark, "Important information about this", numbers=2) == ("disclaimer_or_contact", "skip")
    assert page(spark, "Important information about this", numbers=2, number=1) == ("unknown_keep_for_recall", "keep")
    assert page(spark, "Plain words", visuals=4) == ("mixed_text_visual_page", "keep") and page(spark, "x", expected=3) == ("expected_match_page", "keep")
    assert page(spark, None) == ("unknown_keep_for_recall", "keep")
    assert [value(spark, P.chart_title(F.lit(t))) for t in ("Figure 3: yields", "图 12 利率", "Yields rose", "", "Figure 1 " + "x" * 300)] == [True, True, False, False, False]
    assert [value(spark, P.running_footer(F.lit(t))) for t in ("12", "Important information", "12 yields", "Disclosures " + "x" * 200)] == [True, True, False, False]
    assert value(spark, P.analytical_page(F.lit("Source: X. 4% of it"), F.lit(1))) and not value(spark, P.analytical_page(F.lit("A chart"), F.lit(9)))


def test_articles(spark):
    n = F.lit(None).cast("int")
    got = value(spark, P.article_reasons(F.lit("zh"), F.lit("Insights"), F.lit("https://a/podcast/1"), F.lit(1900), F.lit(100), F.lit(4), F.lit(200), F.lit(0.5), F.lit(1), F.lit(4)))
    assert got == ["zh_text_too_short", "paragraph_count_too_low", "link_density_too_high", "navigation_heavy_page", "generic_landing_title", "landing_or_index_page", "weak_strategy_report_signals", "non_report_page_type"]
    assert value(spark, P.article_reasons(F.lit(None).cast("string"), F.lit(None).cast("string"), n.cast("string"), n, n, n, n, n.cast("double"), n, n))[:2] == ["article_container_missing", "text_too_short"]
    assert value(spark, P.article_score(F.lit(10_000), F.lit(20), F.lit(0.1), F.lit(9), F.lit(1), F.lit(3))) == round(35 + 25 + 20 + 4.5 - 7 - 3, 2)
    assert value(spark, P.article_score(n, n, n.cast("double"), n, n, n)) == 0.0


def test_likeness_and_inventory(spark):
    text = "Outlook for the market: strategy, allocation, risk, growth, policy, inflation. In 2025 yields rise by 4%. " * 80
    got = value(spark, P.report_likeness(F.lit(text), F.lit(6), F.lit(10), F.lit(len(text))))
    assert (got.score, got.parse_quality, got.parse_status) == (0.96, "good", "ok") and "low_navigation_link_density" in got.reasons
    got = value(spark, P.report_likeness(F.lit(None).cast("string"), F.lit(0), F.lit(0), F.lit(None).cast("int")))
    assert (got.score, got.parse_status, got.reasons) == (0.1, "empty_text", ["body_too_short", "low_navigation_link_density"])
    far = "x" * 6000 + " outlook strategy market"
    seen = [value(spark, P.inventory(F.lit("t"), F.lit("u"), F.lit(far), F.lit(9000), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(False), p)).status for p in (None, 5000)]
    assert seen == ["localize_priority", "manual_review"]  # the whole text counts unless a caller cuts it


def test_expected_charts(spark):
    charts = spark.createDataFrame([("r", 1, "gold price over ten years"), ("r", 2, "oil"), ("s", 3, "gold"), (None, 4, "gold")], "k string, c int, x string")
    expected = spark.createDataFrame([("r", "gold price over time"), ("r", "gold price over ten long years"), ("r", None), ("r", "gold price over time"), ("s", "gold")], "k string, e string")
    from docaudit.functions import text as X

    got = {r.c: (r.expected_match, r.shared) for r in P.expected_charts(charts, expected, "k", "c", X.chart_tokens(F.lower("x")), "e").collect()}
    assert got == {1: ("gold price over ten long years", 5), 2: (None, 0), 3: (None, 0), 4: (None, 0)}
    assert P.expected_charts(charts.limit(0), expected, "k", "c", X.chart_tokens(F.lower("x")), "e").count() == 0


def test_visuals_priorities_themes(spark):
    df = spark.createDataFrame([("r", 1, [0.0, 0.0, 10.0, 10.0], [0.0, 0.0, 20.0, 20.0]), ("r", 1, [0.0, 0.0, 20.0, 20.0], [0.0, 0.0, 20.0, 20.0]), ("r", 1, None, None), (None, None, None, None)], "k string, p int, b array<double>, g array<double>")
    got = {r.k: (r.boxes, r.usable, r.max_share) for r in P.visual_statistics(df, ["k", "p"], F.col("b"), F.col("g")).collect()}
    assert got == {"r": (2, 1, 0.25), None: (0, 0, 0.0)}
    names = {"title": None, "caption": None, "nearby_text": None, "object_role": "footer", "chart_kind_hint": None, "source_note": None, "unit_hint": None, "detection_method": "page_body", "crop_quality": {"low_confidence": 1.0}, "numbers": ["1"], "dates": None, "warnings": ["a", "b"], "object_count_on_page": 2, "page": 1}
    schema = ", ".join(f"{k} {t}" for k, t in zip(names, ["string"] * 8 + ["map<string,double>", "array<string>", "array<string>", "array<string>", "int", "int"], strict=True))
    assert value(spark, P.review_priority({k: F.col(k) for k in names}), schema, tuple(names.values())) == round(-3 + 1.2 + 1 + 0.9 + 0.45 + 1.2 + 0.8 + 0.35 + 0.45 - 0.15 + 0.9, 3)
    themes = P.patch_themes(F.create_map(F.lit("structure"), F.lit(0.4), F.lit("visual_qa"), F.lit(0.9)), F.array(F.lit("missing_mechanism")), {"structure": 0.65, "visual_qa": 0.6, "absent": 0.5}, {"missing_mechanism": "chains"})
    assert value(spark, themes) == ["structure", "chains"]
    assert value(spark, P.completeness({"a": (F.lit("x"), 1), "b": (F.lit(None).cast("string"), 1)})) == 0.5
