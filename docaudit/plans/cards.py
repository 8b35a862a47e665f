"""Evaluation of reports by scorecards: candidate reports alone, and reports against the cases of the manifest.

The SQL has its terms written out, so that it checks the dictionaries too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import numbers as N
from docaudit.functions import text as X
from docaudit.operators import joins as J
from docaudit.operators import scorecards as S
from docaudit.operators import scoring
from docaudit.plans.queries import WS, query
from docaudit.session import table

LATEST = "(SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY loaded_at DESC NULLS LAST, extract_id DESC) AS rn FROM extracted_documents) WHERE rn=1)"


def _n(x: str) -> str:
    return rf"trim(regexp_replace(lower(coalesce({x},'')),'{WS}',' ','g'))"


def _hits(x: str, terms: str) -> str:
    return f"len(list_filter([{terms}], lambda t: contains({x}, t)))"


def _tokens(x: str) -> str:
    stop = "'the','and','for','with','from','that','this','into','are','not','report','section','strategy','outlook','research','market'"
    return rf"list_filter(list_distinct(regexp_extract_all({x},'[\x{{4e00}}-\x{{9fff}}]{{2,}}|[a-z0-9][a-z0-9_\-./%]*')), lambda t: length(t)>1 AND NOT list_contains([{stop}], t))"


def _near(needle: str, tokens: str, normal: str, threshold: float) -> str:
    found = _tokens(needle)
    return f"(contains({normal},{needle}) OR (CASE WHEN len({found})>0 THEN len(list_intersect({found},{tokens}))/len({found})::DOUBLE ELSE 0 END)>={threshold})"


def _half(x: str) -> str:
    return f"round(({x})::DECIMAL(38,10),3)::DOUBLE"


SCENARIO = "'base case','upside','downside','scenario','sensitivity','bear','bull','基准','上行','下行','情景','敏感性'"
RISK = "'risk','uncertainty','volatility','policy','execution','market','data limitation','风险','不确定','波动','政策','执行','市场','数据'"
THESIS = "'we believe','we expect','thesis','catalyst','implication','recommend','position','认为','预计','核心观点','催化','影响','配置','建议'"
MECHANISM = "'because','driven by','therefore','leads to','implication','由于','驱动','因此','传导','影响'"


def _latest(spark, d: str) -> DataFrame:
    columns = ["extract_id", "sample_id", "format", "page_count", "parse_quality", "title_hint", "headings", "text_excerpt", "text_length", "tables_or_figures_hint", "links", "visual_images", "loaded_at"]
    return J.pick_one(table(spark, d, "extracted_documents").select(*columns), ["sample_id"], [F.coalesce(-F.unix_micros("loaded_at"), F.lit(2**62)), -F.col("extract_id")])


def reports(spark, d: str) -> DataFrame:
    """The latest extraction of each report, readable."""
    return S.readable(_latest(spark, d), "text_excerpt", compatibility=False)


def _cases(spark, d: str) -> DataFrame:
    """Each case of the manifest with its report, so far as there is one."""
    cases = table(spark, d, "golden_manifest").select("manifest_id", "sample_id", "query", "report_title", "institution_name", "strategy_subtype", "source_pack_count")
    return cases.join(reports(spark, d).select("sample_id", "text_excerpt", "normal", "tokens", "headings", "links", "tables_or_figures_hint", "parse_quality", "text_length", "format", "page_count", "visual_images"), "sample_id")


def _size(c: str) -> Column:
    return F.size(F.coalesce(c, F.array()))


def _delivery() -> Column:
    return S.delivery(F.col("parse_quality"), F.col("text_length"), F.coalesce(F.col("format") == "pdf", F.lit(False)), F.col("page_count"), _size("visual_images"), _size("headings"), _size("visual_images") + _size("tables_or_figures_hint"))


def _flat(rows: DataFrame, key: str, card: Column) -> DataFrame:
    """``key, score``, each part and ``issues`` as codes with their places."""
    out = rows.select(key, card.alias("card"))
    issues = F.array_join(F.transform("card.issues", lambda i: F.concat_ws("@", i["code"], i["place"])), "|")
    return out.select(key, "card.score", "card.parts.*", issues.alias("issues"))


@query(
    "SELECT sample_id, " + _half("(parse+length+pages+visuals)/4") + " AS score, parse, length, pages, visuals, CASE WHEN parse=1 THEN '' ELSE 'layout_issue@parse' END AS issues FROM (SELECT sample_id, "
    "CASE WHEN parse_quality IN ('excellent','good') THEN 1.0 WHEN parse_quality='fair' THEN 0.65 ELSE 0.25 END::DOUBLE AS parse, CASE WHEN coalesce(text_length,0)>=4000 THEN 1.0 ELSE 0.45 END::DOUBLE AS length, "
    "CASE WHEN coalesce(format='pdf',false) THEN (CASE WHEN coalesce(page_count>0,false) THEN 1.0 ELSE 0.3 END) ELSE (CASE WHEN len(coalesce(headings,[]))>0 THEN 1.0 ELSE 0.6 END) END::DOUBLE AS pages, "
    "CASE WHEN coalesce(format='pdf',false) THEN (CASE WHEN len(coalesce(visual_images,[]))>0 THEN 1.0 ELSE 0.65 END) ELSE (CASE WHEN len(coalesce(visual_images,[]))+len(coalesce(tables_or_figures_hint,[]))>0 THEN 1.0 ELSE 0.75 END) END::DOUBLE AS visuals "
    f"FROM {LATEST})"
)
def delivery_cards(spark, d):
    return _flat(_latest(spark, d), "sample_id", _delivery())


@query(
    "SELECT sample_id, CASE WHEN len(list_filter(['6 张图','chartbook','in charts','图看','图表专题'], lambda t: contains(m,t)))>0 THEN 'chartbook' "
    "WHEN len(list_filter(['weekly','周报','周观点','双周报','market review','market weekly','定期报告'], lambda t: contains(m,t)))>0 THEN 'weekly_review' "
    "WHEN len(list_filter(['点评','commentary','快评','brief','首席观点'], lambda t: contains(m,t)))>0 OR length(coalesce(text_excerpt,''))<6500 OR coalesce(page_count,0) BETWEEN 1 AND 8 THEN 'brief_commentary' "
    "WHEN len(list_filter(['深度','专题','白皮书','deep dive'], lambda t: contains(m,t)))>0 OR length(coalesce(text_excerpt,''))>=18000 OR coalesce(page_count,0)>=20 OR (contains(n[:2500],'executive summary') AND coalesce(page_count,0)>=12) THEN 'deep_dive' "
    f"ELSE 'standard_strategy' END AS archetype FROM (SELECT *, {_n('text_excerpt')} AS n, {_n(chr(34) + 'mm' + chr(34))} AS m FROM (SELECT *, concat_ws(' ', title_hint, array_to_string(coalesce(headings,[])[1:6],' ')) AS mm FROM {LATEST}))"
)
def report_archetypes(spark, d):
    kind = S.archetype(F.col("title_hint"), F.col("headings"), F.col("normal"), F.length(X.text_or_empty("text_excerpt")), F.col("page_count"))
    return reports(spark, d).select("sample_id", kind.alias("archetype"))


_GROUPS = {
    "executive_summary": "'summary','executive','key takeaways','核心观点','摘要','要点'",
    "market_context": "'market','macro','industry','policy','市场','宏观','行业','政策'",
    "evidence": "'data','evidence','source','chart','analysis','forecast','estimate','数据','证据','来源','图表','分析','预测','测算'",
    "strategy": "'strategy','thesis','allocation','implication','positioning','preference','investors','策略','逻辑','配置','影响','投资者','建议'",
    "scenario_risk": "'scenario','risk','sensitivity','uncertainty','情景','风险','敏感性','不确定'",
    "disclaimer": "'disclaimer','important information','risk disclosure','免责声明','风险提示'",
}


@query(
    "SELECT sample_id, " + _half("0.46::DOUBLE*coverage+0.34::DOUBLE*h+0.20::DOUBLE*h") + " AS score, " + _half("coverage") + " AS coverage, " + _half("h") + " AS headings, " + _half("h") + " AS sections, "
    "concat_ws('|', CASE WHEN executive_summary=0 THEN 'missing_section_signal@executive_summary' END, CASE WHEN strategy=0 THEN 'missing_section_signal@strategy' END, CASE WHEN scenario_risk=0 THEN 'missing_section_signal@scenario_risk' END) AS issues "
    f"FROM (SELECT *, ({'+'.join(_GROUPS)})/6::DOUBLE AS coverage FROM (SELECT sample_id, least(1.0::DOUBLE, len(coalesce(headings,[]))/8::DOUBLE) AS h, "
    + ", ".join(f"({_hits('n', terms)}>0)::INT AS {g}" for g, terms in _GROUPS.items())
    + f" FROM (SELECT *, {_n(chr(34) + 'mm' + chr(34))} AS n FROM (SELECT *, concat_ws(chr(10), array_to_string(coalesce(headings,[]),chr(10)), text_excerpt) AS mm FROM {LATEST}))))"
)
def structure_cards(spark, d):
    combined = X.collapse_spaces(F.lower(F.concat_ws("\n", F.array_join(F.coalesce("headings", F.array().cast("array<string>")), "\n"), "text_excerpt")))
    card = S.structure(_size("headings"), _size("headings"), F.col("combined"), F.lit(0), F.lit(None).cast("double"))
    return _flat(_latest(spark, d).withColumn("combined", combined), "sample_id", card)


@query(
    "SELECT manifest_id, " + _half("0.42::DOUBLE*s+0.42::DOUBLE*r+0.16::DOUBLE*p") + " AS score, " + _half("s") + " AS scenario, " + _half("r") + " AS risk, " + _half("p") + " AS prohibited, "
    "concat_ws('|', CASE WHEN s<0.45 THEN 'missing_scenario@scenario' END, CASE WHEN r<0.45 THEN 'compliance_issue@risk' END) AS issues "
    f"FROM (SELECT manifest_id, least(1.0::DOUBLE, {_hits('n', SCENARIO)}/3::DOUBLE) AS s, least(1.0::DOUBLE, {_hits('n', RISK)}/5::DOUBLE) AS r, CASE WHEN q<>'' AND {_near('q', 'b', 'n', 0.75)} THEN 0.75 ELSE 1.0 END::DOUBLE AS p "
    f"FROM (SELECT manifest_id, {_n('query')} AS q, n, b FROM golden_manifest g JOIN (SELECT sample_id, n, {_tokens('n')} AS b FROM (SELECT sample_id, {_n('text_excerpt')} AS n FROM {LATEST})) e ON g.sample_id=e.sample_id))"
)
def scenario_cards(spark, d):
    return _flat(_cases(spark, d), "manifest_id", S.scenario_risk(F.array("query"), F.col("normal"), F.col("tokens")))


@query(
    "SELECT manifest_id, " + _half("0.40::DOUBLE*th+0.35::DOUBLE*t+0.25::DOUBLE*m") + " AS score, " + _half("th") + " AS themes, " + _half("t") + " AS thesis, " + _half("m") + " AS mechanism, "
    "CASE WHEN 0.40::DOUBLE*th+0.35::DOUBLE*t+0.25::DOUBLE*m<0.45 THEN 'weak_strategy_thesis@strategy reasoning' ELSE '' END AS issues "
    f"FROM (SELECT manifest_id, contains(n, w)::INT::DOUBLE AS th, least(1.0::DOUBLE, {_hits('n', THESIS)}/5::DOUBLE) AS t, least(1.0::DOUBLE, {_hits('n', MECHANISM)}/5::DOUBLE) AS m "
    f"FROM (SELECT manifest_id, n, {_n('report_title')} AS w FROM golden_manifest g JOIN (SELECT sample_id, {_n('text_excerpt')} AS n FROM {LATEST}) e ON g.sample_id=e.sample_id))"
)
def strategy_cards(spark, d):
    return _flat(_cases(spark, d), "manifest_id", S.strategy_rule(F.array(X.text_or_empty("report_title")), F.col("normal")))


@query(
    "SELECT manifest_id, " + _half("0.72::DOUBLE*a+0.28::DOUBLE*g") + " AS score, " + _half("a") + " AS required, " + _half("g") + " AS general, CASE WHEN a<0.45 THEN 'missing_section@sections' ELSE '' END AS issues "
    f"FROM (SELECT manifest_id, CASE WHEN w<>'' AND ({_near('w', 'hb', 'h', 0.36)} OR {_near('w', 'b', 'n', 0.5)}) THEN 1.0 ELSE 0.65::DOUBLE*(CASE WHEN q<>'' AND {_near('q', 'b', 'n', 0.5)} THEN 1 ELSE 0 END) END::DOUBLE AS a, "
    f"(({_hits('c', chr(39) + 'summary' + chr(39) + ',' + chr(39) + 'executive' + chr(39) + ',' + chr(39) + 'key takeaways' + chr(39) + ',' + chr(39) + '摘要' + chr(39) + ',' + chr(39) + '要点' + chr(39) + ',' + chr(39) + '核心观点' + chr(39))}>0)::INT "
    "+ (len(list_filter(['evidence','source','data','chart','facts','证据','数据','来源'], lambda t: contains(c,t)))>0)::INT + (len(list_filter(['strategy','thesis','implication','allocation','策略','推理','配置','影响'], lambda t: contains(c,t)))>0)::INT "
    f"+ ({_hits('c', SCENARIO)}>0)::INT + ({_hits('c', RISK)}>0)::INT + (len(list_filter(['appendix','disclaimer','important information','references','免责声明','附录'], lambda t: contains(c,t)))>0)::INT)/6::DOUBLE AS g "
    f"FROM (SELECT manifest_id, {_n('report_title')} AS w, {_n('query')} AS q, n, h, b, {_tokens('h')} AS hb, h||chr(10)||n AS c FROM golden_manifest g JOIN (SELECT sample_id, n, h, {_tokens('n')} AS b FROM "
    f"(SELECT sample_id, {_n('text_excerpt')} AS n, {_n('array_to_string(coalesce(headings,[]),chr(10))')} AS h FROM {LATEST})) e ON g.sample_id=e.sample_id))"
)
def section_cards(spark, d):
    return _flat(_cases(spark, d), "manifest_id", _sections())


def _heading_text() -> Column:
    return X.collapse_spaces(F.lower(F.array_join(F.coalesce("headings", F.array().cast("array<string>")), "\n")))


def _sections() -> Column:
    required = F.array(F.struct(X.text_or_empty("report_title").alias("name"), F.array(X.text_or_empty("query")).alias("points")))
    return S.section_coverage(required, F.col("normal"), F.col("tokens"), _heading_text())


@query()
def entity_cards(spark, d):
    expected = N.extract_numbers(F.concat_ws(" ", "query", "report_title"))
    card = S.numeric_entity(expected, N.extract_numbers("text_excerpt"), [F.col("institution_name"), F.col("report_title"), F.col("strategy_subtype")], F.col("normal"), F.col("tokens"))
    return _flat(_cases(spark, d), "manifest_id", card)


@query()
def compliance_cards(spark, d):
    return _flat(reports(spark, d), "sample_id", S.compliance(F.col("text_excerpt"), F.col("normal"), F.lit(0)))


@query()
def source_cards(spark, d):
    rows = _cases(spark, d).withColumn("kept", S.traceable(F.col("links"))).withColumn("said", X.source_statements("text_excerpt"))
    return _flat(rows, "manifest_id", _sources())


def _sources() -> Column:
    pack = F.coalesce("source_pack_count", F.lit(0))
    authority = F.size(F.filter("kept", lambda k: X.distinct_hits(F.lower(F.concat_ws(" ", k["text"], k["href"])), D.AUTHORITY_TERMS) > 0)) + F.size(F.filter("said", lambda s: X.distinct_hits(F.lower(s), D.AUTHORITY_TERMS) > 0)) + pack
    hints = X.occurrences(F.col("normal"), D.SOURCE_TERMS)
    return S.source_quality(F.col("normal"), F.col("institution_name"), F.size("kept"), pack, pack, hints, F.size("said") + F.size("kept") + pack, authority)


@query()
def discipline_cards(spark, d):
    return _flat(reports(spark, d), "sample_id", S.numeric_discipline(F.col("sentences")))


@query()
def reasoning_cards(spark, d):
    kind = S.archetype(F.col("title_hint"), F.col("headings"), F.col("normal"), F.length(X.text_or_empty("text_excerpt")), F.col("page_count"))
    return _flat(reports(spark, d).withColumn("kind", kind), "sample_id", S.reasoning(F.col("views"), F.col("kind")))


_WORDS = "'figure','chart','table','exhibit','source','图','表','资料来源','数据来源'"
_TOPICS = "'rate','yield','gdp','inflation','debt','allocation','portfolio','risk','market','利率','收益率','通胀','债','配置','风险'"
_FINANCE = "'rate','yield','gdp','inflation','earnings','valuation','allocation','portfolio','growth','risk','利率','收益率','通胀','估值','配置','增长','风险'"
_EXPLAIN = "'shows','indicates','suggests','driven','trend','increase','decline','显示','表明','趋势','上升','下降','反映'"


@query(
    "SELECT chart_row_id, " + _half("0.18::DOUBLE*s+0.28::DOUBLE*dt+0.24::DOUBLE*al+0.18::DOUBLE*cl+0.12::DOUBLE*fi") + " AS score, " + _half("s") + " AS spec_completeness, " + _half("dt") + " AS data_faithfulness, " + _half("al") + " AS chart_text_alignment, "
    + _half("cl") + " AS visual_clarity, " + _half("fi") + " AS financial_appropriateness, concat_ws('|', CASE WHEN s<0.55 THEN 'label_unit_error@chart' END, CASE WHEN dec THEN 'decorative_chart@chart' END, CASE WHEN dt<0.5 THEN 'chart_data_error@chart' END, "
    "CASE WHEN al<0.5 THEN 'chart_text_misalignment@chart' END, CASE WHEN cl<0.5 THEN 'visual_readability_issue@chart' END) AS issues FROM (SELECT chart_row_id, dec, s, cl, "
    "least(1.0::DOUBLE, CASE WHEN dec THEN 0.30 ELSE 0.45 END::DOUBLE + CASE WHEN k>=3 THEN 0.22 WHEN k>0 THEN 0.12 ELSE 0 END::DOUBLE + CASE WHEN u<>'' THEN 0.10 ELSE 0 END::DOUBLE + 0.0::DOUBLE + CASE WHEN sn<>'' THEN 0.05 ELSE 0 END::DOUBLE) AS dt, "
    f"least(CASE WHEN dec THEN 0.45 ELSE 1.0 END::DOUBLE, 0.35::DOUBLE + CASE WHEN {_hits('page', _EXPLAIN)}>0 THEN 0.30 ELSE 0 END::DOUBLE + CASE WHEN head<>'' AND contains(page, head) THEN 0.15 ELSE 0 END::DOUBLE + CASE WHEN head<>'' AND contains(coalesce(n,''), head) THEN 0.10 ELSE 0 END::DOUBLE) AS al, "
    f"least(CASE WHEN dec THEN 0.35 ELSE 1.0 END::DOUBLE, 0.55::DOUBLE + CASE WHEN {_hits('w', _FINANCE)}>0 THEN 0.25 ELSE 0 END::DOUBLE) AS fi FROM (SELECT *, "
    f"(coalesce(detection_method='image_region',false) AND sn='' AND u='' AND k<3) OR ({_hits('w', _WORDS)}=0 AND {_hits('w', _TOPICS)}=0 AND k<4) AS dec, "
    "((shown<>'')::INT::DOUBLE + CASE WHEN u<>'' THEN 1.0 WHEN k>0 THEN 0.35 ELSE 0 END::DOUBLE + (sn<>'')::INT::DOUBLE + CASE WHEN len(coalesce(dates,[]))>0 THEN 1.0 ELSE 0.55 END::DOUBLE)/4 AS s, CASE WHEN bbox IS NULL THEN 0.45 ELSE 0.65 END::DOUBLE AS cl "
    f"FROM (SELECT c.chart_row_id, c.dates, c.bbox, c.detection_method, e.n, coalesce(c.unit_hint,'') AS u, coalesce(c.source_note,'') AS sn, len(coalesce(c.numbers,[])) AS k, coalesce(nullif(c.title,''),coalesce(c.caption,'')) AS shown, "
    f"{_n('concat_ws(' + chr(39) + ' ' + chr(39) + ', c.title, c.caption, c.nearby_text, c.source_note, c.chart_kind_hint)')} AS w, {_n('coalesce(nullif(c.page_text,' + chr(39) * 2 + '), c.nearby_text)')} AS page, substring({_n('c.title')},1,40) AS head "
    f"FROM chart_candidates c LEFT JOIN (SELECT sample_id, {_n('text_excerpt')} AS n FROM {LATEST}) e ON c.report_id=e.sample_id)))"
)
def chart_cards(spark, d):
    """Reports come by a left join on their id, one row each; a report that has a third of the charts is one row of the smaller side."""
    texts = _latest(spark, d).select(F.col("sample_id").alias("report_id"), X.collapse_spaces(F.lower(X.text_or_empty("text_excerpt"))).alias("report_normal"))
    charts = table(spark, d, "chart_candidates").select("chart_row_id", "report_id", "title", "caption", "nearby_text", "page_text", "source_note", "unit_hint", "numbers", "dates", "chart_kind_hint", "detection_method", "bbox")
    c = F.col
    clarity = F.when(c("bbox").isNull(), 0.45).otherwise(0.65)
    card = S.chart_card(c("title"), c("caption"), c("nearby_text"), c("page_text"), c("source_note"), c("unit_hint"), c("numbers"), c("dates"), c("chart_kind_hint"), c("detection_method"), clarity, c("report_normal"), F.lit(None).cast("array<string>"), F.lit(False))
    return _flat(charts.join(texts, "report_id", "left"), "chart_row_id", card)


@query()
def candidate_evaluation(spark, d):
    """Reports alone: all modules of a report in one projection, charts joined as their mean and worst two, then total, grade and gates."""
    none = F.lit(0)
    combined = F.concat_ws("\n", _heading_text(), "normal")
    kind = S.archetype(F.col("title_hint"), F.col("headings"), F.col("normal"), F.length(X.text_or_empty("text_excerpt")), F.col("page_count"))
    rows = reports(spark, d).withColumn("kind", kind).withColumn("kept", S.traceable(F.col("links"))).withColumn("said", X.source_statements("text_excerpt")).withColumn("institution_name", F.lit(None).cast("string")).withColumn("source_pack_count", none)
    cards = {
        "delivery": _delivery(), "structure": S.structure(_size("headings"), _size("headings"), combined, none, F.lit(None).cast("double")), "source_traceability": _sources(), "claim_numeric_discipline": S.numeric_discipline(F.col("sentences")),
        "strategy_reasoning": S.reasoning(F.col("views"), F.col("kind")), "scenario_risk": S.scenario_risk(F.array().cast("array<string>"), F.col("normal"), F.col("tokens")), "compliance": S.compliance(F.col("text_excerpt"), F.col("normal"), none),
    }
    scored = rows.select("sample_id", (F.size(S.redline_blockers(F.col("text_excerpt"))) > 0).alias("redline"), *(c["score"].alias(name) for name, c in cards.items()))
    return _totals(scored.join(_chart_scores(spark, d), "sample_id", "left").withColumn("visual_qa", F.coalesce("visual_qa", F.lit(0.65))), "sample_id", D.CANDIDATE_WEIGHTS, {"overall": 75.0, "compliance": 0.9, "visual_qa": 0.45})


def _chart_scores(spark, d: str) -> DataFrame:
    from docaudit.operators.aggregates import worst_blend

    charts = chart_cards(spark, d).select("chart_row_id", "score").join(table(spark, d, "chart_candidates").select("chart_row_id", F.col("report_id").alias("sample_id")), "chart_row_id")
    return worst_blend(charts, ["sample_id"], "score", 2, 0.7).select("sample_id", F.col("blended").alias("visual_qa"))


def _totals(scored: DataFrame, key: str, weights: dict[str, float], thresholds: dict[str, float | None]) -> DataFrame:
    overall = N.weighted_sum({m: F.col(m) for m in weights}, weights)
    dims = F.create_map(*(x for m in weights for x in (F.lit(m), F.col(m))))
    out = scored.withColumn("overall", overall).withColumn("__dims", dims)
    failures = scoring.gate_failures(F.col("overall"), F.col("__dims"), thresholds, F.col("redline"))
    return out.select(key, *weights, "overall", scoring.grade(F.col("overall"), F.col("redline")).alias("grade"), F.array_join(failures, "|").alias("failures"))


@query()
def reference_evaluation(spark, d):
    """Reports against the cases of the manifest: modules of a case in one projection, fused into dimensions, then total, grade and gates."""
    c = F.col
    rows = _cases(spark, d).withColumn("kept", S.traceable(c("links"))).withColumn("said", X.source_statements("text_excerpt"))
    expected = N.extract_numbers(F.concat_ws(" ", "query", "report_title"))
    observed = N.extract_numbers("text_excerpt")
    overlap = X.overlap_ratio(X.token_set(X.collapse_spaces(F.lower(F.concat_ws(" ", "report_title", "query")))), c("tokens"))
    cards = {
        "delivery": _delivery()["score"], "sections": _sections()["score"], "sources": _sources()["score"], "entities": S.numeric_entity(expected, observed, [c("institution_name"), c("report_title"), c("strategy_subtype")], c("normal"), c("tokens"))["score"],
        "claims": 0.72 * N.clamp(overlap / 0.55) + 0.28 * N.preserved_share(expected, observed), "strategy_reasoning": S.strategy_rule(F.array(X.text_or_empty("report_title")), c("normal"))["score"], "scenario_risk": S.scenario_risk(F.array("query"), c("normal"), c("tokens"))["score"],
        "charts": S.chart_presence(_size("visual_images") + _size("tables_or_figures_hint"), F.array("report_title"), c("normal"), c("tokens"))["score"], "compliance": S.compliance(c("text_excerpt"), c("normal"), F.lit(0))["score"], "redline": F.size(S.redline_blockers(c("text_excerpt"))) > 0,
    }
    scored = rows.select("manifest_id", *(v.alias(k) for k, v in cards.items()))
    fused = scored.withColumn("structure", N.blend(c("sections"), c("delivery"), 0.78)).withColumn("facts", 0.52 * c("claims") + 0.48 * c("entities")).withColumn("writing_layout", c("delivery"))
    rounded = fused.select("manifest_id", "redline", *(N.half_up(c(m), 3).alias(m) for m in D.REFERENCE_WEIGHTS))
    return _totals(rounded, "manifest_id", D.REFERENCE_WEIGHTS, {"overall": 80.0, "sources": 0.7, "facts": 0.85, "compliance": 0.95, "charts": 0.55})
