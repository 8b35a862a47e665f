"""Queries that assess web pages, pages of reports, visuals and facts. The SQL has its terms written out."""

from __future__ import annotations

from pyspark.sql import functions as F

from docaudit.functions import numbers as N
from docaudit.functions import text as X
from docaudit.operators import filters as FI
from docaudit.operators import pages as P
from docaudit.plans.cards import LATEST, WS, _latest, _n
from docaudit.plans.queries import query
from docaudit.session import table

_NAVIGATION = "'home','menu','subscribe','sign in','contact us','privacy','cookie','all rights reserved','首页','导航','登录','注册','联系我们'"
_STRATEGY = "'outlook','strategy','allocation','portfolio','market','macro','risk','scenario','forecast','investment','equity','fixed income','credit','inflation','growth','policy','earnings','valuation','配置','策略','市场','宏观','风险','情景','投资','权益','债券','通胀','增长','政策'"
_INVENTORY = "'outlook','strategy','market','macro','portfolio','allocation','equity','fixed income','credit','rates','investment','economic','展望','策略','市场','宏观','配置','权益','固收','利率','信用','投资'"
_LISTING = "'contact us','latest insights','all insights','events','podcasts','investment stewardship','interactive charts','research library','联系我们','最新观点','研究报告列表','报告列表'"


def _hits(x: str, terms: str) -> str:
    return f"len(list_filter([{terms}], lambda t: contains({x}, t)))"


@query(
    "SELECT article_id, concat_ws('|', CASE WHEN text_length IS NULL THEN 'article_container_missing' END, CASE WHEN n < (CASE WHEN zh THEN 1800 ELSE 3000 END) THEN 'text_too_short' END, CASE WHEN zh AND z < 900 THEN 'zh_text_too_short' END, "
    "CASE WHEN lp < (CASE WHEN zh THEN 5 ELSE 6 END) THEN 'paragraph_count_too_low' END, CASE WHEN r > 0.28 THEN 'link_density_too_high' END, CASE WHEN l > greatest(80, lp*8) AND r > 0.18 THEN 'navigation_heavy_page' END, "
    "CASE WHEN coalesce(trim(t,' -|') IN ('insights','research','publications','markets & insights','markets and insights','investment insights','perspectives','ideas','the markets','global market outlook'),false) AND n < 6500 THEN 'generic_landing_title' END, "
    "CASE WHEN la >= 4 AND lp < 10 THEN 'landing_or_index_page' END, CASE WHEN rs < 3 THEN 'weak_strategy_report_signals' END, "
    f"CASE WHEN {_hits('named', chr(39) + (chr(39) + ',' + chr(39)).join(['podcast', 'video', 'webcast', '/people/', '/person/', '/about-us/', 'investment-professionals', 'professionals/', 'events']) + chr(39))}>0 THEN 'non_report_page_type' END, CASE WHEN n > 350000 THEN 'page_text_implausibly_large' END) AS reasons, "
    "round((least(100.0::DOUBLE, greatest(0.0::DOUBLE, least(35.0::DOUBLE, n*(1::DOUBLE/180)) + least(25.0::DOUBLE, lp*2.2::DOUBLE) + least(20.0::DOUBLE, rs*3.0::DOUBLE) + least(10.0::DOUBLE, v*1.5::DOUBLE) - least(25.0::DOUBLE, r*70.0::DOUBLE) - least(20.0::DOUBLE, la*3.0::DOUBLE))))::DECIMAL(38,10),2)::DOUBLE AS score "
    "FROM (SELECT article_id, text_length, coalesce(text_length,0) AS n, coalesce(lower(trim(language))='zh',false) AS zh, coalesce(zh_char_count,0) AS z, coalesce(long_paragraph_count,0) AS lp, coalesce(link_text_ratio,0)::DOUBLE AS r, coalesce(link_count,0) AS l, coalesce(landing_signal_count,0) AS la, "
    f"coalesce(report_signal_count,0) AS rs, coalesce(visual_count,0) AS v, CASE WHEN title IS NOT NULL THEN {_n('title')} END AS t, lower(concat_ws(' ', url, title)) AS named FROM article_quality)"
)
def article_assessed(spark, d):
    a = F.col
    found = P.article_reasons(F.lower(F.trim("language")), a("title"), a("url"), a("text_length"), a("zh_char_count"), a("long_paragraph_count"), a("link_count"), a("link_text_ratio"), a("report_signal_count"), a("landing_signal_count"))
    score = P.article_score(a("text_length"), a("long_paragraph_count"), a("link_text_ratio"), a("report_signal_count"), a("landing_signal_count"), a("visual_count"))
    return table(spark, d, "article_quality").select("article_id", F.array_join(found, "|").alias("reasons"), score.alias("score"))


@query(
    "SELECT sample_id, likeness, reasons, CASE WHEN n>=2500 AND likeness>=0.5 THEN 'good' WHEN n>=1000 AND likeness>=0.3 THEN 'fair' ELSE 'poor' END AS parse_quality, "
    "CASE WHEN trim(body,' ')='' THEN 'empty_text' WHEN NOT ((n>=2500 AND likeness>=0.5) OR (n>=1000 AND likeness>=0.3)) THEN 'low_confidence' ELSE 'ok' END AS parse_status "
    "FROM (SELECT *, round((least(1.0::DOUBLE, greatest(0.0::DOUBLE, CASE WHEN n>=6000 THEN 0.28 WHEN n>=2500 THEN 0.18 WHEN n>=1000 THEN 0.08 ELSE 0 END::DOUBLE + CASE WHEN h>=6 THEN 0.18 WHEN h>=3 THEN 0.10 ELSE 0 END::DOUBLE + CASE WHEN s>=8 THEN 0.28 WHEN s>=4 THEN 0.18 WHEN s>=2 THEN 0.08 ELSE 0 END::DOUBLE "
    "+ CASE WHEN num THEN 0.12 ELSE 0 END::DOUBLE + CASE WHEN dens<=0.18 THEN 0.10 WHEN dens>=0.45 THEN -0.18 ELSE 0 END::DOUBLE + CASE WHEN nav>=6 AND n<5000 THEN -0.20 ELSE 0 END::DOUBLE)))::DECIMAL(38,10),3)::DOUBLE AS likeness, "
    "concat_ws('|', CASE WHEN n>=6000 THEN 'long_enough_report_body' WHEN n>=2500 THEN 'moderate_report_body' WHEN n>=1000 THEN 'short_but_readable_body' ELSE 'body_too_short' END, CASE WHEN h>=6 THEN 'multiple_report_headings' WHEN h>=3 THEN 'some_report_headings' END, "
    "CASE WHEN s>=8 THEN 'strong_strategy_term_coverage' WHEN s>=4 THEN 'moderate_strategy_term_coverage' WHEN s>=2 THEN 'weak_strategy_term_coverage' END, CASE WHEN num THEN 'numeric_or_time_signals' END, CASE WHEN dens<=0.18 THEN 'low_navigation_link_density' WHEN dens>=0.45 THEN 'high_navigation_link_density' END, "
    "CASE WHEN nav>=6 AND n<5000 THEN 'navigation_or_landing_page_signals' END) AS reasons FROM (SELECT sample_id, body, length(body) AS n, len(coalesce(headings,[])) AS h, lk/greatest(1, coalesce(nullif(text_length,0), length(body)))::DOUBLE AS dens, "
    rf"{_hits('lower(body)', _STRATEGY)} AS s, {_hits('lower(body)', _NAVIGATION)} AS nav, regexp_matches(body,'(?i)\b20[0-9]{{2}}\b|[%$]|bps|bp|trillion|billion|million|万亿|亿元|基点') AS num "
    f"FROM (SELECT *, coalesce(text_excerpt,'') AS body, coalesce(list_sum([length(coalesce(x.text,'')) for x in coalesce(links,[])]),0) AS lk FROM {LATEST})))"
)
def likeness_of_reports(spark, d):
    chars = F.aggregate(F.coalesce("links", F.array().cast("array<struct<text:string,href:string>>")), F.lit(0), lambda a, x: a + F.length(X.text_or_empty(x["text"])))
    found = P.report_likeness(F.col("text_excerpt"), F.size(F.coalesce("headings", F.array().cast("array<string>"))), chars, F.col("text_length"))
    return _latest(spark, d).select("sample_id", found.alias("f")).select("sample_id", F.col("f.score").alias("likeness"), F.array_join("f.reasons", "|").alias("reasons"), "f.parse_quality", "f.parse_status")


@query(
    "SELECT article_id, reasons, score::INT AS score, CASE WHEN contains(reasons,'too_short') OR contains(reasons,'listing_page') THEN 'exclude_preliminary' WHEN w OR (n>=2500 AND hits>=3) THEN 'localize_priority' ELSE 'manual_review' END AS status "
    "FROM (SELECT *, least(n//500,30)+least(hits*4,24)+least(h,10)+least(v*2,16)-least(ck,20)+CASE WHEN w THEN 30 ELSE 0 END-CASE WHEN reasons<>'' THEN 25 ELSE 0 END AS score FROM (SELECT *, "
    "concat_ws('|', CASE WHEN n<1200 THEN 'too_short' END, CASE WHEN lst>=2 AND n<8000 THEN 'listing_page' END, CASE WHEN hits<2 THEN 'few_strategy_signals' END) AS reasons "
    f"FROM (SELECT article_id, coalesce(text_length,0) AS n, coalesce(heading_count,0) AS h, coalesce(visual_count,0) AS v, coalesce(cookie_count,0) AS ck, coalesce(article_like,false) AS w, {_hits('x', _INVENTORY)} AS hits, {_hits('x', _LISTING)} AS lst "
    "FROM (SELECT *, lower(concat_ws(' ', title, url, coalesce(text_preview,''))) AS x FROM article_quality))))"
)
def page_inventory(spark, d):
    a = F.col
    found = P.inventory(a("title"), a("url"), a("text_preview"), a("text_length"), a("heading_count"), a("visual_count"), F.lit(0), a("cookie_count"), F.lit(0), a("article_like"))
    return table(spark, d, "article_quality").select("article_id", found.alias("f")).select("article_id", F.array_join("f.reasons", "|").alias("reasons"), "f.score", "f.status")


_CHART = r"(?i)figures in focus|figure|fig\.|exhibit|chart|table|图表|圖表|图\s*[0-9]+|圖\s*[0-9]+|表\s*[0-9]+"
_SOURCE = r"(?i)\bsources?:|资料来源|資料來源|数据来源|數據來源|来源"
_UNIT = r"(?i)%|bps|bp|percent|percentage|usd|eur|rmb|cny|\$|\bbn\b|\bmn\b|\btrn\b|\btimes\b|单位|亿元|亿美元|万亿|百分点|个基点"
_CONTENTS = r"(?i)\btable of contents\b|\bcontents\b|目录|目錄|图表目录|圖表目錄|list of figures|list of tables"
_LEGAL = r"(?i)important information|disclosures?|免责声明|风险提示|法律声明|copyright|all rights reserved"


@query(
    "SELECT chart_row_id, kind AS page_type, CASE WHEN kind IN ('toc_or_figure_list','disclaimer_or_contact') THEN 'skip' ELSE 'keep' END AS action, signals, (src AND (unit OR n>=4)) OR (chart AND unit AND n>=3) AS analytical, title_like "
    "FROM (SELECT *, CASE WHEN chart AND (src OR unit OR n>=4 OR dense) THEN 'analytical_visual_page' WHEN toc AND v=0 AND n<=18 THEN 'toc_or_figure_list' WHEN legal AND NOT chart AND share<0.04 AND n<8 AND coalesce(page>3,false) THEN 'disclaimer_or_contact' WHEN dense OR n>=10 THEN 'mixed_text_visual_page' ELSE 'unknown_keep_for_recall' END AS kind, "
    "concat_ws('|', CASE WHEN toc THEN 'toc_terms' END, CASE WHEN legal THEN 'disclaimer_or_contact_terms' END, CASE WHEN chart THEN 'chart_terms' END, CASE WHEN src THEN 'source_terms' END, CASE WHEN unit THEN 'unit_terms' END, CASE WHEN n>=8 THEN 'number_dense' END, CASE WHEN dense THEN 'visual_density' END) AS signals "
    f"FROM (SELECT chart_row_id, page, len(coalesce(numbers,[])) AS n, coalesce(object_count_on_page,0) AS v, coalesce(crop_quality['area_ratio'],0) AS share, (coalesce(object_count_on_page,0)>=4 OR coalesce(crop_quality['area_ratio'],0)>=0.08) AS dense, regexp_matches(t,'{_CHART}') AS chart, "
    f"regexp_matches(t,'{_SOURCE}') AS src, regexp_matches(t,'{_UNIT}') AS unit, regexp_matches(t,'{_CONTENTS}') AS toc, regexp_matches(t,'{_LEGAL}') AS legal, (w<>'' AND length(w)<=240 AND regexp_matches(w,'(?i)\\b(?:figure|fig\\.|exhibit|chart|table)\\s*[0-9A-ZIVX.-]*|(?:图表|圖表|图|圖|表)\\s*[0-9一二三四五六七八九十百]+')) AS title_like "
    rf"FROM (SELECT *, coalesce(page_text,'') AS t, trim(regexp_replace(coalesce(title,''),'{WS}',' ','g')) AS w FROM chart_candidates)))"
)
def page_kinds(spark, d):
    n = F.greatest(F.size("numbers"), F.lit(0))
    kind = P.page_kind(F.col("page_text"), n, F.col("object_count_on_page"), F.try_element_at("crop_quality", F.lit("area_ratio")), F.lit(0), F.col("page"))
    rows = table(spark, d, "chart_candidates").select("chart_row_id", kind.alias("k"), P.analytical_page(F.col("page_text"), n).alias("analytical"), P.chart_title(F.col("title")).alias("title_like"))
    return rows.select("chart_row_id", "k.page_type", "k.action", F.array_join("k.signals", "|").alias("signals"), "analytical", "title_like")


@query(
    "SELECT report_id, page, count(bbox) AS boxes, count(s) AS usable, round((coalesce(max(s),0))::DECIMAL(38,10),3)::DOUBLE AS max_share FROM (SELECT report_id, page, bbox, CASE WHEN a BETWEEN 0.001 AND 0.75 THEN a END AS s FROM (SELECT report_id, page, bbox, "
    "greatest(0,bbox[3]-bbox[1])*greatest(0,bbox[4]-bbox[2])/nullif(greatest(0,page_bbox[3]-page_bbox[1])*greatest(0,page_bbox[4]-page_bbox[2]),0) AS a FROM chart_candidates)) GROUP BY 1,2"
)
def page_visuals(spark, d):
    return P.visual_statistics(table(spark, d, "chart_candidates"), ["report_id", "page"], F.col("bbox"), F.col("page_bbox"))


@query(
    "SELECT chart_row_id, round((CASE WHEN art THEN -3.0 ELSE 0 END::DOUBLE + CASE WHEN coalesce(title,'')='' AND coalesce(caption,'')='' THEN 1.2 ELSE 0 END::DOUBLE + CASE WHEN coalesce(source_note,'')='' THEN 1.0 ELSE 0 END::DOUBLE + CASE WHEN coalesce(unit_hint,'')='' AND len(coalesce(numbers,[]))>0 THEN 0.9 ELSE 0 END::DOUBLE "
    "+ CASE WHEN len(coalesce(dates,[]))=0 THEN 0.45 ELSE 0 END::DOUBLE + CASE WHEN coalesce(crop_quality['oversized_visual']<>0,false) OR coalesce(crop_quality['narrow_crop']<>0,false) OR coalesce(crop_quality['low_confidence']<>0,false) THEN 1.2 ELSE 0 END::DOUBLE "
    "+ CASE WHEN len(list_filter(['fallback','page_body','merged','broad'], lambda t: contains(lower(coalesce(detection_method,'')),t)))>0 THEN 0.8 ELSE 0 END::DOUBLE + CASE WHEN len(list_filter(['page','body','visual'], lambda t: contains(lower(coalesce(object_role,'')),t)))>0 THEN 0.25 ELSE 0 END::DOUBLE "
    "+ CASE WHEN coalesce(object_count_on_page,0)>=2 THEN 0.35 ELSE 0 END::DOUBLE + CASE WHEN length(coalesce(nearby_text,''))<80 THEN 0.45 ELSE 0 END::DOUBLE + CASE WHEN coalesce(page IN (0,1),false) THEN -0.15 ELSE 0 END::DOUBLE + CASE WHEN len(coalesce(warnings,[]))>0 THEN 0.7::DOUBLE+0.1::DOUBLE*least(5,len(warnings)) ELSE 0 END)::DECIMAL(38,10),3)::DOUBLE AS priority "
    "FROM (SELECT *, len(list_filter(['table of contents','contents','图表目录','目录','disclaimer','important information','risk disclosure','免责声明','重要声明','风险提示','法律声明'], lambda t: contains(h,t)))>0 OR contains(nb,'table of contents') OR contains(nb,'图表目录') OR h IN ('cover','toc') "
    "OR len(list_filter(['footer','sidebar','legal'], lambda t: contains(lower(concat_ws(' ',object_role,chart_kind_hint)),t)))>0 AS art FROM (SELECT *, lower(trim(coalesce(nullif(title,''),coalesce(caption,'')),' ')) AS h, substring(lower(trim(coalesce(nearby_text,''),' ')),1,240) AS nb FROM chart_candidates))"
)
def review_priorities(spark, d):
    names = ["title", "caption", "nearby_text", "object_role", "chart_kind_hint", "crop_quality", "source_note", "unit_hint", "numbers", "dates", "warnings", "detection_method", "object_count_on_page", "page"]
    return table(spark, d, "chart_candidates").select("chart_row_id", P.review_priority({n: F.col(n) for n in names}).alias("priority"))


_STOP = "'the','and','for','with','from','amid','focus','chart','table','figure','figures','events','source','sources','investment','market','markets'"


def _tokens(x: str) -> str:
    return rf"list_filter(list_distinct(regexp_extract_all({x},'[\x{{4e00}}-\x{{9fff}}]{{2,}}|[a-z0-9]{{3,}}')), lambda t: length(t)>1 AND NOT list_contains([{_STOP}], t))"


@query(
    "SELECT report_id, chart_row_id, CASE WHEN max(g)>0 THEN min(CASE WHEN g=m THEN text END) END AS expected_match, max(g) AS shared FROM (SELECT report_id, chart_row_id, text, g, max(g) OVER (PARTITION BY chart_row_id) AS m FROM (SELECT c.report_id, c.chart_row_id, e.text, "
    "CASE WHEN len(list_intersect(e.b,c.a))>=3 AND len(list_intersect(e.b,c.a))>=0.45*len(e.b) THEN len(list_intersect(e.b,c.a)) ELSE 0 END AS g "
    f"FROM (SELECT report_id, chart_row_id, {_tokens('x')} AS a FROM (SELECT *, {_n('concat_ws(' + chr(39) + ' ' + chr(39) + ', title, nearby_text)')} AS x FROM chart_candidates)) c LEFT JOIN (SELECT sample_id, text, {_tokens('x')} AS b FROM (SELECT sample_id, text, {_n('text')} AS x FROM "
    "(SELECT DISTINCT sample_id, concat_ws(' ', report_title, query) AS text FROM golden_manifest))) e ON c.report_id=e.sample_id)) GROUP BY 1,2"
)
def expected_charts(spark, d):
    charts = table(spark, d, "chart_candidates").select("report_id", "chart_row_id", F.concat_ws(" ", "title", "nearby_text").alias("x"))
    expected = table(spark, d, "golden_manifest").select(F.col("sample_id").alias("report_id"), F.concat_ws(" ", "report_title", "query").alias("text"))
    return P.expected_charts(charts, expected, "report_id", "chart_row_id", X.chart_tokens(X.collapse_spaces(F.lower("x"))), "text")


@query()
def fact_roles(spark, d):
    from docaudit.operators.classify import fact_importance

    claim = F.concat_ws(" ", "report_title", "query")
    return table(spark, d, "golden_manifest").select("manifest_id", P.fact_role(claim, F.lit(None).cast("string"), F.lit(None).cast("string")).alias("role"), fact_importance(claim).alias("importance"))


@query(
    "SELECT manifest_id, round(((length(coalesce(report_title,''))>=1)::INT+(length(coalesce(query,''))>=1)::INT+(length(coalesce(notes,''))>=30)::INT+(length(coalesce(target_reader,''))>=20)::INT+(length(coalesce(publication_period,''))>=20)::INT+(length(coalesce(candidate_path,''))>=20)::INT)::DECIMAL(38,10)/6,3)::DOUBLE AS completeness FROM golden_manifest"
)
def chain_completeness(spark, d):
    """The columns of the manifest stand for the parts of a line of reasoning, which the test tables do not have."""
    lengths = {"report_title": 1, "query": 1, "notes": 30, "target_reader": 20, "publication_period": 20, "candidate_path": 20}
    return table(spark, d, "golden_manifest").select("manifest_id", P.completeness({c: (F.col(c), n) for c, n in lengths.items()}).alias("completeness"))


@query(
    "SELECT article_id, n>=1800 AND n>=m*0.18 AND n<=m*1.25 AS usable, coalesce(trim(t,' -|') IN ('summary','key risks','小结'),false) AS generic FROM (SELECT article_id, length(coalesce(text_preview,'')) AS n, coalesce(text_length,0) AS m, "
    f"{_n('title')} AS t FROM article_quality)"
)
def page_texts(spark, d):
    n = F.repeat(F.lit("x"), F.coalesce("text_length", F.lit(0)).cast("int"))
    return table(spark, d, "article_quality").select("article_id", FI.usable_excerpt(F.col("text_preview"), n).alias("usable"), FI.generic_title(X.text_or_empty("title"), ["summary", "key risks", "小结"]).alias("generic"))


@query("SELECT manifest_id, source_page_count IS NOT NULL AND source_page_count>0 AS paged, coalesce(TRY_CAST(source_page_count AS DOUBLE),-1.0) AS pages FROM golden_manifest")
def safe_numbers(spark, d):
    rows = table(spark, d, "golden_manifest").select("manifest_id", F.col("source_page_count").cast("string").alias("t"))
    return rows.select("manifest_id", F.coalesce(N.safe_number(F.col("t"), 0.0) > 0, F.lit(False)).alias("paged"), N.safe_number(F.col("t"), -1.0).alias("pages"))
