"""Scorecards: the known facts of the evaluation, modules against plain arithmetic, odd reports."""

import math

import pytest
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import numbers as N
from docaudit.operators import redlines
from docaudit.operators import scorecards as S
from docaudit.operators import scoring
from docaudit.plans import cards


def read(spark, texts, **columns):
    names = list(columns)
    rows = [(i, t, *(columns[n][1] for n in names)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i long, text string" + "".join(f", {n} {columns[n][0]}" for n in names))
    return S.readable(df, "text")


def one(df, column):
    return [r.c for r in df.select("i", column.alias("c")).orderBy("i").collect()]


def test_a_guarantee_is_a_redline(spark):
    df = read(spark, ["This product offers guaranteed return and is risk-free.", "This is not guaranteed, and no guaranteed return is promised.", "It may fall.", None, ""])
    got = one(df, S.compliance(F.col("text"), F.col("normal"), F.lit(None).cast("int")))
    assert got[0].score < 0.7 and [i.severity for i in got[0].issues] == ["blocker"]
    assert all(g.issues == [] and g.parts.redline == 1.0 for g in got[1:]) and got[2].parts.caution == 1.0 and got[3].parts.caution == 0.55


def test_required_sections_are_found_as_headings(spark):
    text = "Executive summary\nKey thesis.\nRisk factors\nPolicy and market uncertainty."
    required = F.array(*(F.struct(F.lit(n).alias("name"), F.array().cast("array<string>").alias("points")) for n in ("Executive summary", "Risk factors")))
    got = one(read(spark, [text, "Nothing of the kind.", None]), S.section_coverage(required, F.col("normal"), F.col("tokens"), F.lower(F.when(F.col("i") == 0, "executive summary\nrisk factors").otherwise(""))))
    assert got[0].score >= 0.8 and got[0].issues == []
    assert got[1].parts.required == 0.0 and [i.code for i in got[1].issues] == ["missing_section"] and got[2].score == 0.0


def test_a_redline_rejects_the_best_report(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "k long, redline boolean").select("k", "redline", *(F.lit(1.0).alias(m) for m in D.REFERENCE_WEIGHTS))
    got = {r.k: r for r in cards._totals(df, "k", D.REFERENCE_WEIGHTS, {"overall": 80.0}).collect()}
    assert (got[1].overall, got[1].grade, got[1].failures) == (100.0, "Reject", "redline_issue_present") and (got[2].grade, got[2].failures) == ("Gold", "")


def test_numbers_and_entities(spark):
    df = read(spark, ["Alpha House sees 40 % and 1250 units."], e=("array<string>", ["40%", "1,250"]))
    got = one(df, S.numeric_entity(F.col("e"), N.extract_numbers("text"), [F.lit("Alpha House"), F.lit(None).cast("string"), F.lit("")], F.col("normal"), F.col("tokens")))[0]
    assert (got.score, got.issues) == (1.0, [])
    got = one(df, S.numeric_entity(F.array(F.lit("77%")), N.extract_numbers("text"), [F.lit("Omega")], F.col("normal"), F.col("tokens")))[0]
    assert got.score == 0.0 and [i.code for i in got.issues] == ["numerical_error", "entity_mismatch"]


def test_reasoning_counts_distinct_sentences(spark):
    sentences = ["We believe that rates fall because growth slows down.", "We believe -- that rates fall because growth slows down!", "Investors should watch the downside risk of this view.", "This is not investment advice, we believe in nothing here."]
    got = one(read(spark, ["\n".join(sentences), None]), S.reasoning(F.col("views"), F.lit("standard_strategy")))
    want = {k: 1 - math.exp(-math.log(5) * n / D.SIGNAL_TARGETS["any"][k]) for k, n in {"thesis": 1, "mechanism": 1, "implication": 1, "risk": 1}.items()}
    assert {k: round(v, 3) for k, v in want.items()} == got[0].parts.asDict()
    assert got[0].score == round(sum(D.SIGNAL_WEIGHTS["any"][k] * v for k, v in want.items()), 3) and got[1].score == 0.0 and len(got[1].issues) == 3


def test_archetypes_set_targets(spark):
    df = spark.createDataFrame([("Market weekly", 9000, 0), ("Five ideas in charts", 9000, 0), ("Outlook", 9000, 0), ("Outlook", 9000, 5), ("Outlook", 20000, 0), ("Outlook", 9000, 30), ("Brief on gold", 20000, 30), (None, 100, None)], "t string, n int, p int")
    got = [r.k for r in df.select(S.archetype(F.col("t"), F.lit(None).cast("array<string>"), F.lit(""), F.col("n"), F.col("p")).alias("k")).collect()]
    assert got == ["weekly_review", "chartbook", "standard_strategy", "brief_commentary", "deep_dive", "deep_dive", "brief_commentary", "brief_commentary"]
    for k, row in D.SIGNAL_WEIGHTS.items():
        assert abs(sum(row.values()) - 1) < 1e-9, k


def test_discipline(spark):
    text = "We expect GDP to grow by 3.5% in 2025, according to the statistics office.\nIn 2023 and 2024 there was nothing to report here.\nSee ABC1234-5 for the document with 40% of it."
    got = one(read(spark, [text, None, "word " * 60_000]), S.numeric_discipline(F.col("sentences")))
    p = got[0].parts
    assert (p.density, p.context, p.sources, p.claims) == (round(1 / 12, 3), 1.0, 1.0, 0.1) and p.units == 0.5  # 3.5% has a unit, 2025 none
    assert got[1].parts.context == 0.55 and got[2].parts.density == 0.0


@pytest.mark.parametrize(
    "text,href,keep",
    [("Report", "https://a.example/x", True), ("Home", "https://a.example/", False), ("Bloomberg", "https://a.example", True), ("", "#top", False), ("Mail", "mailto:a@b", False), ("Privacy", "https://a.example/p", False), ("x", "file:///a.pdf", False), ("IMF data", "file:///a.pdf", True), ("x", "a/b", False), (None, None, False)],
)
def test_traceable_links(spark, text, href, keep):
    df = spark.createDataFrame([([(text, href)],)], "links array<struct<text:string,href:string>>")
    assert len(df.select(S.traceable(F.col("links")).alias("k")).first().k) == int(keep)


def test_sources_delivery_structure_charts(spark):
    df = read(spark, ["We believe it. Source: Alpha House."])
    none, n = F.lit(0), F.col("normal")
    got = one(df, S.source_quality(n, F.lit("Alpha House"), F.lit(2), F.lit(1), F.lit(1), F.lit(3), F.lit(4), F.lit(2)))[0]
    assert got.parts.asDict() == {"sufficiency": 1.0, "traceability": 1.0, "authority": round(2 / 7, 3), "publisher": 1.0, "views_told_apart": 1.0} and got.issues == []
    assert [i.severity for i in one(df, S.source_quality(n, F.lit(None).cast("string"), none, none, none, none, none, none))[0].issues] == ["high"]
    got = one(df, S.delivery(F.lit("fair"), F.lit(100), F.lit(True), F.lit(None).cast("int"), none, none, none))[0]
    assert got.score == round((0.65 + 0.45 + 0.3 + 0.65) / 4, 3) and [i.severity for i in got.issues] == ["medium"]
    got = one(df, S.structure(F.lit(8), F.lit(4), F.lit("summary risk strategy"), F.lit(1), F.lit(0.2)))[0]
    total = 0.46 * 4 / 6 + 0.34 + 0.1
    assert got.score == round(min(total, 0.72 * 0.2 + 0.28 * total), 3) and [i.code for i in got.issues] == ["low_report_likeness"]
    got = one(df, S.chart_presence(none, F.array(F.lit("Gold price")), n, F.col("tokens")))[0]
    assert got.parts.asDict() == {"existence": 0.25, "labels": 0.333, "expected": 0.0} and [i.code for i in got.issues] == ["chart_mismatch"]
    assert one(df, S.strategy_rule(F.array(F.lit("it")), n))[0].parts.asDict() == {"themes": 1.0, "thesis": 0.2, "mechanism": 0.0}


def test_confirmed_redlines(spark):
    df = spark.createDataFrame([(0.4, [True, False]), (0.4, [False]), (0.4, []), (0.4, None), (0.99, [False])], "rule double, confirmed array<boolean>")
    assert [r.c for r in df.select(S.confirmed_compliance(F.col("rule"), F.col("confirmed")).alias("c")).collect()] == [0.4, 0.95, 0.4, 0.4, 0.99]


def test_places_like_a_plain_search(spark):
    text = "中文👍 RISK-FREE and risk free; must buy!\n稳赚" + " x" * 200 + " must buy"
    got = spark.createDataFrame([(text,), (None,), ("",), ("must buy",)], "t string").select(redlines.spans(F.col("t"), D.REDLINE_PATTERNS, 10).alias("s")).collect()
    assert [(s.matched, text[s.start : s.end]) for s in got[0].s] == [(w, w) for w in ("RISK-FREE", "risk free", "must buy", "稳赚", "must buy")]
    assert got[0].s[0].context == "中文👍 RISK-FREE and risk" and got[1].s == [] == got[2].s and (got[3].s[0].start, got[3].s[0].end) == (0, 8)


def test_queries_have_what_they_say(spark, data):
    rows = cards.candidate_evaluation(spark, data).toPandas()
    weights = D.CANDIDATE_WEIGHTS
    assert rows.sample_id.is_unique and all(abs(r.overall - sum(w * getattr(r, m) for m, w in weights.items())) < 0.02 for r in rows.itertuples()) and set(rows.grade) <= {"Gold", "Silver", "Bronze", "Reject"}
    ref = cards.reference_evaluation(spark, data).toPandas()
    assert ref.manifest_id.is_unique and len(ref) and ref[list(D.REFERENCE_WEIGHTS)].apply(lambda c: c.between(0, 1)).all().all()
    empty = S.readable(spark.createDataFrame([], "k long, text string, normal string"), "text")
    assert empty.count() == 0 and scoring.grade is not None
