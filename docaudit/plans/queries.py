"""Queries over the test tables: one per operator or family of operators, with the same query in SQL.

Each runs over whole tables and whole texts. The SQL is for DuckDB, where the tables are views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import geometry as G
from docaudit.functions import numbers as N
from docaudit.functions import structures as S
from docaudit.functions import text as X
from docaudit.operators import aggregates as A
from docaudit.operators import classify as C
from docaudit.operators import evidence as E
from docaudit.operators import filters as FI
from docaudit.operators import joins as J
from docaudit.operators import projections as P
from docaudit.operators import redlines, rules, scoring
from docaudit.operators import windows as W
from docaudit.plans import pipeline
from docaudit.session import table
from docaudit.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WS = r"[\t-\r\x{85}\p{Z}]+"
NORMAL = rf"trim(regexp_replace(lower(coalesce(text,'')),'{WS}',' ','g'))"
TERMS = ["risk", "outlook", "summary", "scenario", "source", "growth", "风险", "展望", "来源", "risiken", "risques", "riesgos"]
SUBTYPES = {"outlook": ["outlook", "ausblick", "展望", "注目点"], "risk": ["risk", "risiken", "risques", "riesgos", "风险", "リスク"], "scenario": ["scenario", "情景"], "summary": ["summary", "zusammenfassung", "resumen", "小结", "まとめ"]}
NEGATIVE = ["podcast", "webinar", "video"]


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _list(terms: list[str]) -> str:
    return "[" + ",".join("'" + t.replace("'", "''") + "'" for t in terms) + "]"


# --- text ---------------------------------------------------------------------------------


@query(rf"SELECT doc_id, length(c) AS clean_length, md5(c) AS clean_hash FROM (SELECT doc_id, trim(regexp_replace(coalesce(text,''),'{WS}',' ','g')) AS c FROM documents)")
def text_clean(spark, d):
    c = X.collapse_spaces("text")
    return table(spark, d, "documents").select("doc_id", F.length(c).alias("clean_length"), F.md5(c).alias("clean_hash"))


@query()
def text_normalized(spark, d):
    c = X.normalize_text("text")
    return table(spark, d, "documents").select("doc_id", F.length(c).alias("normal_length"), F.md5(c).alias("normal_hash"))


@query(
    "SELECT doc_id, CASE WHEN s2 = '' THEN 'item' ELSE s2 END AS slug FROM (SELECT doc_id, trim(substring(s,1,90),'-') AS s2 FROM "
    r"(SELECT doc_id, trim(regexp_replace(lower(coalesce(title,'')),'[^a-z0-9\x{4e00}-\x{9fff}]+','-','g'),'-') AS s FROM documents))"
)
def slugs(spark, d):
    return table(spark, d, "documents").select("doc_id", X.slug("title", 90).alias("slug"))


@query(
    "SELECT doc_id, CASE WHEN length(t)<=2000 THEN t ELSE substring(t,1,1440)||chr(10)||chr(10)||'[... middle omitted for token control ...]'||chr(10)||chr(10)||right(t,360) END AS compacted, "
    "CASE WHEN length(t)<=300 THEN t ELSE substring(t,1,300)||'...[truncated '||(length(t)-300)||' chars]' END AS shortened, greatest(1, length(t)//4) AS tokens "
    "FROM (SELECT doc_id, coalesce(text,'') AS t FROM documents)"
)
def text_cuts(spark, d):
    return table(spark, d, "documents").select("doc_id", X.compact("text", 2000).alias("compacted"), X.shorten("text", 300).alias("shortened"), X.estimate_tokens("text").alias("tokens"))


_SENT = rf"""
SELECT doc_id, pos, s AS sentence FROM (
 SELECT doc_id, unnest(l) AS s, unnest(range(1, len(l)+1)) AS pos FROM (
  SELECT doc_id, list_transform(list_filter(list_transform(string_split(m, chr(1)), lambda x: regexp_replace(x,'^{WS}|{WS}$','','g')), lambda x: length(x)>=25), lambda x: substring(x,1,1200))[1:1000] AS l FROM (
   SELECT doc_id, regexp_replace(regexp_replace(coalesce(replace(text,chr(1),' '),''),'([。！？.!?]){WS}','\1'||chr(1),'g'),'\n+',chr(1),'g') AS m FROM documents)))
"""


def _sentences(spark, d, **cuts):
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(X.split_sentences(F.replace("text", F.lit("\x01"), F.lit(" ")), **cuts)).alias("p", "sentence"))
    return rows.select("doc_id", (F.col("p") + 1).alias("pos"), "sentence")


@query(_SENT)
def sentences(spark, d):
    return _sentences(spark, d, longest=1200, most=1000)  # as in the SQL


def _fingerprints(rows):
    return rows.groupBy("doc_id").agg(F.count_distinct(X.fingerprint(F.lower("sentence"))).alias("distinct_sentences"), F.count("*").alias("n_sentences"))


@query(
    f"SELECT doc_id, count(DISTINCT regexp_replace(lower(sentence),'[^\\p{{L}}\\p{{N}}]+','','g')) AS distinct_sentences, count(*) AS n_sentences FROM ({_SENT}) GROUP BY doc_id"
)
def sentence_fingerprints(spark, d):
    return _fingerprints(sentences(spark, d))


_SENT_WHOLE = _SENT.replace("list_transform(list_filter(", "list_filter(").replace("), lambda x: substring(x,1,1200))[1:1000] AS l", ") AS l")


@query(_SENT_WHOLE)
def sentences_whole(spark, d):
    return _sentences(spark, d)


@query(
    f"SELECT doc_id, count(DISTINCT regexp_replace(lower(sentence),'[^\\p{{L}}\\p{{N}}]+','','g')) AS distinct_sentences, count(*) AS n_sentences FROM ({_SENT_WHOLE}) GROUP BY doc_id"
)
def sentence_fingerprints_whole(spark, d):
    return _fingerprints(sentences_whole(spark, d))


@query(
    f"SELECT doc_id, len(list_filter({_list(TERMS)}, lambda t: contains(n,t))) AS distinct_hits, "
    + "+".join(f"(length(n)-length(replace(n,'{t}','')))//{len(t)}" for t in TERMS)
    + f" AS occurrences FROM (SELECT doc_id, {NORMAL} AS n FROM documents)"
)
def term_counts(spark, d):
    n = X.collapse_spaces(F.lower("text"))
    rows = table(spark, d, "documents").select("doc_id", n.alias("n"))
    return rows.select("doc_id", X.distinct_hits(F.col("n"), TERMS).alias("distinct_hits"), X.occurrences(F.col("n"), TERMS).alias("occurrences"))


TOKENS = rf"list_filter(list_distinct(regexp_extract_all(n,'([\x{{4e00}}-\x{{9fff}}]{{2,}}|[a-z0-9][a-z0-9_\-./%]*)',1)), lambda t: length(t)>1 AND NOT list_contains({_list(D.STOPWORDS)}, t))"


@query(f"SELECT doc_id, len({TOKENS}) AS n_tokens FROM (SELECT doc_id, {NORMAL} AS n FROM documents)")
def token_sets(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(X.token_set(X.collapse_spaces(F.lower("text")))).alias("n_tokens"))


@query(
    "SELECT doc_id, round(("
    + "+".join("CASE WHEN " + " OR ".join(f"contains(n,'{t}')" for t in terms) + " THEN 1 ELSE 0 END" for terms in D.SECTION_GROUPS.values())
    + f")/{float(len(D.SECTION_GROUPS))},4) AS coverage FROM (SELECT doc_id, {NORMAL} AS n FROM documents)"
)
def group_coverage(spark, d):
    rows = table(spark, d, "documents").select("doc_id", X.collapse_spaces(F.lower("text")).alias("n"))
    return rows.select("doc_id", F.round(X.group_coverage(F.col("n")), 4).alias("coverage"))


@query(
    "SELECT doc_id, t[1] AS first_line, len(t) AS n_lines FROM (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text,''),chr(10)), "
    rf"lambda x: regexp_replace(x,'^{WS}|{WS}$','','g')), lambda x: x<>'') AS t FROM documents)"
)
def first_lines(spark, d):
    rows = table(spark, d, "documents").select("doc_id", X.lines("text").alias("l"))
    return rows.select("doc_id", F.try_element_at("l", F.lit(1)).alias("first_line"), F.size("l").alias("n_lines"))


@query()
def heading_lines(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(X.headings("text")).alias("p", "heading"))
    return rows.select("doc_id", (F.col("p") + 1).alias("pos"), "heading")


@query(
    "SELECT chart_row_id, substring(regexp_extract(t,'(?i)((?:sources?|data source|资料来源|数据来源|来源)[ \\t]*[:：-][^\\n]+)',1),1,220) AS note, "
    "array_to_string(list_transform(list_filter(list_zip(u, range(1,len(u)+1)), lambda z: list_position(u, z[1])=z[2]), lambda z: z[1]),' ') AS units, coalesce(list_filter(list_transform(string_split(t,chr(10)), "
    rf"lambda x: regexp_replace(x,'^{WS}|{WS}$','','g')), lambda x: length(x)>=4 AND length(x)<=160)[1], title) AS inferred_title FROM (SELECT chart_row_id, title, coalesce(nearby_text,'') AS t, regexp_extract_all(lower(coalesce(nearby_text,'')),'(%|bps|bp|usd|eur|cny|rmb|billion|million|亿元|万元|倍|个百分点|个基点)',1) AS u FROM chart_candidates)"
)
def source_notes(spark, d):
    rows = table(spark, d, "chart_candidates")
    return rows.select("chart_row_id", X.source_note("nearby_text").alias("note"), F.array_join(X.unit_hints("nearby_text"), " ").alias("units"), X.infer_title("nearby_text", F.col("title")).alias("inferred_title"))


@query(
    "SELECT doc_id, CASE WHEN length(t)>0 THEN round((" + "+".join(f"(length(t)-length(replace(t,'{m}','')))//{len(m)}" for m in D.MOJIBAKE_MARKERS) + ")/length(t)::DOUBLE,6) ELSE 0.0 END AS ratio FROM (SELECT doc_id, coalesce(text,'') AS t FROM documents)"
)
def mojibake_audit(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(X.mojibake_ratio("text"), 6).alias("ratio"))


@query(
    "SELECT article_id, CASE WHEN p IS NOT NULL AND length(t)>s THEN rtrim(substring(t,1,s+p-1)) ELSE t END AS trimmed FROM (SELECT *, nullif(least("
    + ",".join(f"CASE WHEN strpos(substring(lower(t),s+1),'{m}')=0 THEN 1000000 ELSE strpos(substring(lower(t),s+1),'{m}') END" for m in ("all rights reserved", "you may also like", "版权所有"))
    + "),1000000) AS p FROM (SELECT article_id, coalesce(text_preview,'') AS t, greatest(400, floor(length(coalesce(text_preview,''))*0.2)::INT) AS s FROM article_quality))"
)
def boundary_trim(spark, d):
    cut = X.trim_at_markers("text_preview", ["all rights reserved", "you may also like", "版权所有"], 400)
    return table(spark, d, "article_quality").select("article_id", cut.alias("trimmed"))


@query()
def boilerplate_trim(spark, d):
    return table(spark, d, "article_quality").select("article_id", X.trim_boilerplate("text_preview").alias("trimmed"))


@query()
def chart_token_sets(spark, d):
    tokens = X.chart_tokens(X.normalize_text(F.concat_ws(" ", "title", "caption", "nearby_text")))
    return table(spark, d, "chart_candidates").select("chart_row_id", F.array_join(tokens, " ").alias("tokens"))


@query()
def paragraph_chunks(spark, d):
    rows = table(spark, d, "extracted_documents").select("extract_id", F.posexplode(X.chunk_paragraphs("text_excerpt", 900)).alias("p", "chunk"))
    return rows.select("extract_id", (F.col("p") + 1).alias("chunk_no"), F.length("chunk").alias("chars"), F.md5("chunk").alias("chunk_hash"))


# --- numbers, dates -----------------------------------------------------------------------


@query()
def numbers_extracted(spark, d):
    found = N.extract_numbers("text_preview")
    return table(spark, d, "article_quality").select("article_id", F.size(found).alias("n_numbers"), F.array_join(found, "|").alias("numbers"))


@query()
def quantities_parsed(spark, d):
    rows = table(spark, d, "chart_candidates").select("chart_row_id", F.posexplode(N.parse_quantities("nearby_text")).alias("p", "q"))
    return rows.select("chart_row_id", (F.col("p") + 1).alias("pos"), "q.raw", "q.unit_class", F.round("q.value", 6).alias("value"))


@query(
    r"SELECT manifest_id, coalesce(nullif(regexp_extract(t,'((?:19|20)[0-9]{2}[-/.年](?:0?[1-9]|1[0-2])[-/.月](?:[12][0-9]|3[01]|0?[1-9]))',1),''), "
    r"nullif(regexp_extract(t,'(?i)((?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.? [0-9]{1,2},? (?:19|20)[0-9]{2})',1),''), "
    r"nullif(regexp_extract(t,'(?i)((?:19|20)[0-9]{2} ?q[1-4]|q[1-4] ?(?:19|20)[0-9]{2})',1),'')) AS found_date FROM (SELECT manifest_id, coalesce(report_date,'') AS t FROM golden_manifest)"
)
def report_dates(spark, d):
    return table(spark, d, "golden_manifest").select("manifest_id", N.report_date("report_date").alias("found_date"))


@query()
def dates_extracted(spark, d):
    found = N.extract_dates("text")
    return table(spark, d, "documents").select("doc_id", F.size(found).alias("n_dates"), F.array_join(found, "|").alias("dates"))


_VALUE = "CASE WHEN a=0 AND b=0 THEN 1.0 WHEN abs(a-b)/greatest(abs(a),abs(b),1.0)<=0.002 THEN 1.0 WHEN abs(a-b)/greatest(abs(a),abs(b),1.0)<=0.01 THEN 0.92 WHEN abs(a-b)/greatest(abs(a),abs(b),1.0)<=0.05 THEN 0.75 ELSE 0.0 END"


@query(
    f"SELECT o_orderkey, matched, match_score, l_linenumber FROM (SELECT o_orderkey, l_linenumber, coalesce(s,0.0)::DOUBLE AS match_score, coalesce(s>=0.82,false) AS matched, row_number() OVER (PARTITION BY o_orderkey ORDER BY s DESC NULLS LAST, l_linenumber, b) AS rn FROM "
    f"(SELECT o_orderkey, l_linenumber, b, CASE WHEN b IS NULL THEN NULL ELSE round(0.78*{_VALUE}+0.22,3) END AS s FROM (SELECT o_orderkey, o_totalprice AS a, l_extendedprice AS b, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey=l_orderkey))) WHERE rn=1"
)
def numeric_match(spark, d):
    usd = F.lit("usd")
    expected = table(spark, d, "orders").select("o_orderkey", F.lit(0).alias("no"), F.col("o_totalprice").alias("a"), usd.alias("ca"))
    observed = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_extendedprice").alias("b"), usd.alias("cb"))
    out = E.numeric_matches(expected, observed, ["o_orderkey"], "no", "a", "ca", "l_linenumber", "b", "cb")
    return out.select("o_orderkey", "matched", "match_score", "l_linenumber")


@query(
    "SELECT chart_row_id, CASE WHEN len(e)=0 THEN 0.8 ELSE round(len(list_filter(e, lambda x: len(list_filter(o, lambda y: x=y OR contains(y,x) OR contains(x,y)))>0))/len(e)::DOUBLE,4) END AS preserved FROM "
    "(SELECT chart_row_id, list_filter(list_transform(coalesce(numbers,[]), lambda v: regexp_replace(lower(v),'[,，\\s%％]','','g')), lambda v: v<>'') AS e, "
    "list_filter(list_transform(coalesce(dates,[]), lambda v: regexp_replace(lower(v),'[,，\\s%％]','','g')), lambda v: v<>'') AS o FROM chart_candidates)"
)
def numbers_preserved(spark, d):
    return table(spark, d, "chart_candidates").select("chart_row_id", F.round(N.preserved_share(F.col("numbers"), F.col("dates")), 4).alias("preserved"))


# --- classification -----------------------------------------------------------------------


@query(
    r"SELECT doc_id, CASE WHEN z>=20 AND z>=a*0.08 THEN 'zh' ELSE 'en' END AS language FROM (SELECT doc_id, len(regexp_extract_all(coalesce(text,''),'[\x{4e00}-\x{9fff}]')) AS z, len(regexp_extract_all(coalesce(text,''),'[A-Za-z]')) AS a FROM documents)"
)
def language_vote(spark, d):
    return table(spark, d, "documents").select("doc_id", C.zh_or_en(F.col("text")).alias("language"))


@query(
    "SELECT extract_id, CASE WHEN w AND n=0 THEN 'failed' WHEN m>0.01 THEN 'poor' WHEN n>12000 THEN 'excellent' WHEN n>5000 THEN 'good' WHEN n>1000 THEN 'fair' ELSE 'poor' END AS quality FROM (SELECT extract_id, length(t) AS n, len(coalesce(extraction_warnings,[]))>0 AS w, CASE WHEN length(t)>0 THEN ("
    + "+".join(f"(length(t)-length(replace(t,'{m}','')))//{len(m)}" for m in D.MOJIBAKE_MARKERS)
    + ")/length(t)::DOUBLE ELSE 0 END AS m FROM (SELECT *, coalesce(text_excerpt,'') AS t FROM extracted_documents))"
)
def parse_quality(spark, d):
    warned = F.size(F.coalesce("extraction_warnings", F.array().cast("array<string>"))) > 0
    return table(spark, d, "extracted_documents").select("extract_id", C.parse_quality(F.col("text_excerpt"), warned).alias("quality"))


_SUBTYPE = (
    "SELECT doc_id, CASE WHEN list_max(v)>0 THEN " + _list(list(SUBTYPES)) + "[list_position(v,list_max(v))] ELSE 'thematic_strategy' END AS guessed FROM (SELECT doc_id, ["
    + ",".join("+".join(f"contains(h,'{k}')::INT" for k in ks) for ks in SUBTYPES.values())
    + "] AS v FROM (SELECT doc_id, lower(concat_ws(' ', title, substring(coalesce(text,''),1,3000))) AS h FROM documents))"
)


@query(_SUBTYPE)
def subtype_vote(spark, d):
    return table(spark, d, "documents").select("doc_id", C.subtype(F.col("title"), F.col("text"), SUBTYPES, "thematic_strategy", 3000).alias("guessed"))  # as in the SQL


@query(_SUBTYPE.replace("substring(coalesce(text,''),1,3000)", "coalesce(text,'')"))
def subtype_vote_whole(spark, d):
    return table(spark, d, "documents").select("doc_id", C.subtype(F.col("title"), F.col("text"), SUBTYPES, "thematic_strategy").alias("guessed"))


@query(
    "SELECT extract_id, CASE WHEN coalesce(parse_quality='failed',false) OR coalesce(page_count=0,false) THEN 'Reject' WHEN coalesce(parse_quality='poor',false) THEN 'C' WHEN p>=4 THEN 'A' WHEN p>=2 THEN 'B' ELSE 'C' END AS tier FROM (SELECT *, coalesce((file_size_bytes>=500000)::INT,0)+coalesce((page_count>=8)::INT,0)+coalesce((page_count>=20)::INT,0)+coalesce((format IN ('pdf'))::INT,0)+coalesce((parse_quality='good')::INT,0) AS p FROM extracted_documents)"
)
def size_tiers(spark, d):
    c = F.col
    return table(spark, d, "extracted_documents").select("extract_id", C.size_tier(c("file_size_bytes"), c("page_count"), c("parse_quality"), c("format"), ["pdf"]).alias("tier"))


@query(
    "SELECT article_id, array_to_string(list_filter([CASE WHEN text_length<600 THEN 'too_short' END, CASE WHEN link_text_ratio>0.5 THEN 'link_heavy' END, CASE WHEN landing_signal_count>=4 THEN 'landing_page' END, CASE WHEN cookie_count+consent_terms>=6 THEN 'consent_heavy' END, CASE WHEN coalesce(trim(title),'')='' THEN 'no_title' END], lambda x: x IS NOT NULL),';') AS errors, "
    "(coalesce(text_length<600,false) OR coalesce(link_text_ratio>0.5,false) OR coalesce(landing_signal_count>=4,false) OR coalesce(cookie_count+consent_terms>=6,false) OR coalesce(trim(title),'')='')=false AS admitted FROM article_quality"
)
def admission_audit(spark, d):
    c = F.col
    errors, ok = C.admission_errors([(c("text_length") < 600, "too_short"), (c("link_text_ratio") > 0.5, "link_heavy"), (c("landing_signal_count") >= 4, "landing_page"), (c("cookie_count") + c("consent_terms") >= 6, "consent_heavy"), (F.trim(F.coalesce("title", F.lit(""))) == "", "no_title")])
    return table(spark, d, "article_quality").select("article_id", F.array_join(errors, ";").alias("errors"), ok.alias("admitted"))


@query()
def numeric_discipline(spark, d):
    return pipeline.numeric_discipline(table(spark, d, "documents"), "doc_id", "text")


@query()
def redline_spans(spark, d):
    patterns = [r"\bguarante\w+\b", r"\brisk[- ]free\b", r"\bmust buy\b", r"\badd on weakness\b", r"无风险", r"保证收益", r"分批增加", r"garantiz\w+", r"garanti\w*"]
    rows = table(spark, d, "documents").select("doc_id", F.explode(redlines.spans(F.col("text"), patterns)).alias("s"))
    decision = C.redline_decision(F.col("s.matched"), F.col("s.context"), ["must buy", "guaranteed return", "保证收益"], ["not guarantee", "no guarantee", "不保证", "keine garantie"])
    return rows.select("doc_id", "s.matched", "s.start", "s.end", decision.alias("decision"))


@query(
    "SELECT chart_row_id, CASE WHEN regexp_matches(h,'\\b(table|tabelle|tableau|tabla)\\b|表') THEN 'table' WHEN regexp_matches(h,'\\b(line|path|trend|verlauf)\\b|走势|路径') THEN 'line' WHEN regexp_matches(h,'\\b(bar|column|balken)\\b|柱') THEN 'bar' WHEN regexp_matches(h,'\\b(pie|share|anteil)\\b|占比') THEN 'pie' ELSE 'other' END AS kind FROM (SELECT chart_row_id, lower(coalesce(title,'')) AS h FROM chart_candidates)"
)
def chart_kinds(spark, d):
    return table(spark, d, "chart_candidates").select("chart_row_id", C.chart_kind(F.col("title")).alias("kind"))


# --- filters, projections -----------------------------------------------------------------


@query(
    "SELECT article_id, coalesce(regexp_matches(title,'(?i)outlook|risk|展望|风险'),false) AND NOT coalesce(regexp_matches(title,'(?i)podcast|summary'),false) AS wanted, coalesce(lower(trim(title)) IN ('summary','key risks','小结'),false) AS generic, "
    "length(coalesce(text_preview,''))>=600 AND length(coalesce(text_preview,''))>=0.18*coalesce(text_length,0) AS long_enough, ((coalesce(quality_score>=60,false))::INT+(coalesce(article_like,false))::INT+(coalesce(link_text_ratio<0.4,false))::INT)>=2 AS two_of_three FROM article_quality"
)
def article_filters(spark, d):
    c = F.col
    n = F.length(X.text_or_empty("text_preview"))
    return table(spark, d, "article_quality").select(
        "article_id", FI.positive_title(c("title"), "(?i)outlook|risk|展望|风险", "(?i)podcast|summary").alias("wanted"), rules.true(F.lower(F.trim("title")).isin("summary", "key risks", "小结")).alias("generic"),
        ((n >= 600) & (n >= 0.18 * F.coalesce("text_length", F.lit(0)))).alias("long_enough"), FI.at_least([c("quality_score") >= 60, c("article_like"), c("link_text_ratio") < 0.4], 2).alias("two_of_three"),
    )


@query("SELECT manifest_id, candidate_path FROM golden_manifest WHERE coalesce(lower(trim(source_format)) IN ('html','htm'),false) OR coalesce(regexp_matches(lower(candidate_path),'[.]html?$'),false)")
def html_rows(spark, d):
    rows = table(spark, d, "golden_manifest")
    return rows.where(FI.declared_or_suffix(F.col("source_format"), F.col("candidate_path"), ["html", "htm"], ".html", ".htm")).select("manifest_id", "candidate_path")


@query(
    "SELECT extract_id, array_to_string(list_filter([CASE WHEN title_hint IS NULL OR trim(title_hint)='' THEN 'missing_title_hint' END, CASE WHEN sha256 IS NULL OR trim(sha256)='' THEN 'missing_sha256' END, CASE WHEN text_excerpt IS NULL OR trim(text_excerpt)='' THEN 'missing_text_excerpt' END], lambda x: x IS NOT NULL),';') AS errors, len(headings[1:3]) AS n_headings FROM extracted_documents"
)
def validated_extracts(spark, d):
    rows = P.validated(table(spark, d, "extracted_documents").select("extract_id", "title_hint", "sha256", "text_excerpt", "headings"), ["title_hint", "sha256", "text_excerpt"], {"headings": 3})
    return rows.select("extract_id", F.array_join("errors", ";").alias("errors"), F.when(F.col("headings").isNotNull(), F.size("headings")).alias("n_headings"))


@query(
    "SELECT manifest_id, CASE strategy_subtype WHEN 'annual_outlook' THEN 'outlook' WHEN 'midyear_outlook' THEN 'outlook' ELSE strategy_subtype END AS kind, CASE WHEN report_date IS NOT NULL AND report_date<>'' THEN report_date WHEN publication_period IS NOT NULL AND publication_period<>'' THEN publication_period END AS shown_date FROM golden_manifest"
)
def mapped_manifest(spark, d):
    c = F.col
    kinds = {"annual_outlook": "outlook", "midyear_outlook": "outlook"}
    return table(spark, d, "golden_manifest").select("manifest_id", P.looked_up(c("strategy_subtype"), kinds).alias("kind"), F.coalesce(F.nullif("report_date", F.lit("")), F.nullif("publication_period", F.lit(""))).alias("shown_date"))


# --- links, keys --------------------------------------------------------------------------

_HOST = r"lower(nullif(regexp_extract(url,'^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)',1),''))"


@query(
    rf"SELECT article_id, h AS host, array_to_string(string_split(regexp_replace(h,'^www\.',''),'.')[-2:],'.') AS registered, nullif(regexp_extract(regexp_extract(url,'^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)',1),'([^/]+)$',1),'') AS name, coalesce(contains(h,'news'),false) OR coalesce(contains(lower(url),'/views/'),false) AS noise FROM (SELECT article_id, url, {_HOST} AS h FROM article_quality)"
)
def url_parts(spark, d):
    u = F.col("url")
    return table(spark, d, "article_quality").select("article_id", S.host(u).alias("host"), S.registered_host(u).alias("registered"), F.nullif(S.filename_of(u, ""), F.lit("")).alias("name"), S.is_noise_url(u, ["news"], ["/views/"]).alias("noise"))


@query(
    "SELECT extract_id, count(*) AS n_links, sum(CASE WHEN regexp_matches(lower(href),'^https?://') AND regexp_extract(href,'^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)',1) NOT IN ('','/') THEN 1 ELSE 0 END) AS n_deep FROM (SELECT extract_id, l.href AS href FROM (SELECT extract_id, unnest(links) AS l FROM extracted_documents)) GROUP BY extract_id"
)
def link_targets(spark, d):
    rows = table(spark, d, "extracted_documents").select("extract_id", F.explode("links").alias("l"))
    deep = F.lower(F.col("l.href")).rlike("^https?://") & ~S.url_path(F.col("l.href")).isin("", "/")
    return rows.groupBy("extract_id").agg(F.count("*").alias("n_links"), F.count_if(deep).alias("n_deep"))


@query("SELECT chart_row_id, concat_ws(':', page::VARCHAR, (round(bbox[1]/12)*12)::BIGINT::VARCHAR, (round(bbox[2]/12)*12)::BIGINT::VARCHAR, (round(bbox[3]/12)*12)::BIGINT::VARCHAR, (round(bbox[4]/12)*12)::BIGINT::VARCHAR) AS grid FROM chart_candidates")
def grid_keys(spark, d):
    return table(spark, d, "chart_candidates").select("chart_row_id", S.grid_key(F.col("page"), F.col("bbox")).alias("grid"))


@query("SELECT event_id, substring(sha1(event_type||':'||user_id),1,8) AS key8, (regexp_extract(props,'\"k\": *([0-9]+)',1))::INT AS k FROM events")
def event_keys(spark, d):
    kept = F.get_json_object(S.json_object(F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))), "$.k").cast("int")
    return table(spark, d, "events").select("event_id", S.short_hash(F.concat_ws(":", "event_type", F.col("user_id").cast("string"))).alias("key8"), kept.alias("k"))


# --- joins --------------------------------------------------------------------------------

_LATEST = "(SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY loaded_at DESC NULLS LAST, extract_id DESC) AS rn FROM extracted_documents) WHERE rn=1)"


def _latest(spark, d):
    rows = table(spark, d, "extracted_documents").select("extract_id", "sample_id", "parse_quality", "page_count", "format", "loaded_at", "text_excerpt", "headings")
    return J.pick_one(rows, ["sample_id"], [F.coalesce(-F.unix_micros("loaded_at"), F.lit(2**62)), -F.col("extract_id")])


@query(f"SELECT g.manifest_id, g.sample_id, e.extract_id, e.parse_quality FROM golden_manifest g LEFT JOIN {_LATEST} e ON g.sample_id=e.sample_id")
def left_merge_latest(spark, d):
    rows = table(spark, d, "golden_manifest").select("manifest_id", "sample_id")
    right = table(spark, d, "extracted_documents").select("sample_id", "extract_id", "parse_quality", "loaded_at")
    out = J.lookup(rows, right, ["sample_id"], [F.coalesce(-F.unix_micros("loaded_at"), F.lit(2**62)), -F.col("extract_id")])
    return out.select("manifest_id", "sample_id", "extract_id", "parse_quality")


@query("SELECT sample_id, 'extracted' AS origin FROM extracted_documents UNION ALL SELECT sample_id, 'manifest' AS origin FROM golden_manifest g WHERE sample_id IS NULL OR NOT EXISTS (SELECT 1 FROM extracted_documents e WHERE e.sample_id=g.sample_id)")
def anti_union(spark, d):
    rows = table(spark, d, "extracted_documents").select("sample_id", F.lit("extracted").alias("origin"))
    return J.add_missing(rows, table(spark, d, "golden_manifest").select("sample_id", F.lit("manifest").alias("origin")), ["sample_id"])


@query("SELECT manifest_id, sample_id IS NOT NULL AND sample_id IN (SELECT sample_id FROM extracted_documents) AS has_extract FROM golden_manifest")
def semi_flag(spark, d):
    out = J.flag_present(table(spark, d, "golden_manifest").select("manifest_id", "sample_id"), table(spark, d, "extracted_documents"), ["sample_id"], "has_extract")
    return out.select("manifest_id", "has_extract")


@query("SELECT kept, count(*) AS n FROM (SELECT CASE WHEN report_id IN (SELECT sample_id FROM golden_manifest WHERE sample_id IS NOT NULL) THEN 'kept' ELSE 'rejected' END AS kept FROM chart_candidates) GROUP BY kept")
def semi_anti_split(spark, d):
    charts = table(spark, d, "chart_candidates").select(F.col("report_id").alias("sample_id"))
    kept, rejected = J.split_by(charts, table(spark, d, "golden_manifest"), ["sample_id"])
    return kept.select(F.lit("kept").alias("kept")).unionAll(rejected.select(F.lit("rejected").alias("kept"))).groupBy("kept").agg(F.count("*").alias("n"))


@query(
    f"SELECT g.manifest_id, e.page_count, c.n_charts, c.best_score FROM golden_manifest g LEFT JOIN {_LATEST} e ON g.sample_id=e.sample_id LEFT JOIN (SELECT report_id, count(*) AS n_charts, max(candidate_score) AS best_score FROM chart_candidates GROUP BY report_id) c ON g.sample_id=c.report_id"
)
def three_way_left(spark, d):
    rows = table(spark, d, "golden_manifest").select("manifest_id", "sample_id")
    charts = table(spark, d, "chart_candidates").groupBy(F.col("report_id").alias("sample_id")).agg(F.count("*").alias("n_charts"), F.max("candidate_score").alias("best_score"))
    return rows.join(_latest(spark, d).select("sample_id", "page_count"), "sample_id", "left").join(charts, "sample_id", "left").select("manifest_id", "page_count", "n_charts", "best_score")


@query(
    "SELECT chart_id, n_rows, last_row, promoted FROM (SELECT chart_id, count(*) AS n_rows, max(chart_row_id) AS last_row, bool_or(coalesce(candidate_score>=60,false)) AS promoted FROM chart_candidates GROUP BY chart_id)"
)
def promoted_charts(spark, d):
    charts = table(spark, d, "chart_candidates").select("chart_id", "chart_row_id", "candidate_score")
    judges = charts.where("candidate_score >= 60").select("chart_id").distinct()
    groups = charts.groupBy("chart_id").agg(F.count("*").alias("n_rows"), F.max("chart_row_id").alias("last_row"))
    yes, no = J.split_by(groups, judges, ["chart_id"])
    return yes.withColumn("promoted", F.lit(True)).unionByName(no.withColumn("promoted", F.lit(False)))


@query("SELECT n.n_nationkey, r.r_name, row_number() OVER (ORDER BY n_nationkey)-1 AS place FROM nation n JOIN region r ON n_regionkey=r_regionkey")
def strict_lookup(spark, d):
    ids = table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"), F.col("n_nationkey").cast("long").alias("place"))
    return J.strict_lookup(ids, table(spark, d, "region"), "r_regionkey", "place").select("n_nationkey", "r_name", "place")


@query(
    "SELECT a.article_id, f.doc_id AS first_doc FROM article_quality a LEFT JOIN (SELECT title, min(doc_id) AS doc_id FROM documents WHERE title IS NOT NULL GROUP BY title) f ON a.title=f.title"
)
def first_match(spark, d):
    out = J.lookup(table(spark, d, "article_quality").select("article_id", "title"), table(spark, d, "documents").select("title", "doc_id"), ["title"], [F.col("doc_id")])
    return out.select("article_id", F.col("doc_id").alias("first_doc"))


@query(
    "SELECT o_orderkey, l_linenumber, CASE WHEN n>i THEN i ELSE n-1 END AS picked FROM (SELECT l_orderkey AS o_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)-1 AS i, 2 AS n FROM lineitem)"
)
def positional_join(spark, d):
    from pyspark.sql.window import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    right = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", (F.row_number().over(w) - 1).alias("i"))
    left = right.select("o_orderkey").distinct().select("o_orderkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("picked"))
    return J.positional(left, right, "o_orderkey", "picked", "i").select("o_orderkey", "l_linenumber", "picked")


@query(
    "SELECT user_id, array_to_string(list_sort(list_transform(map_entries(m), lambda e: e.key||'='||e.value)),',') AS merged FROM (SELECT user_id, map_from_entries(list_concat(list_filter(a, lambda x: NOT list_contains(list_transform(b, lambda y: y.k), x.k)), b)) AS m FROM "
    "(SELECT user_id, coalesce(list({'k': event_type, 'v': n::VARCHAR}) FILTER (WHERE half=0), []) AS a, coalesce(list({'k': event_type, 'v': n::VARCHAR}) FILTER (WHERE half=1), []) AS b FROM (SELECT user_id, event_type, event_id%2 AS half, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id))"
)
def map_merge(spark, d):
    counts = table(spark, d, "events").groupBy("user_id", (F.col("event_id") % 2).alias("half"), "event_type").agg(F.count("*").alias("n"))
    maps = counts.groupBy("user_id").agg(*(F.map_from_entries(F.collect_list(F.when(F.col("half") == h, F.struct("event_type", F.col("n").cast("string"))))).alias(c) for h, c in ((0, "a"), (1, "b"))))
    merged = S.merged_maps(F.col("a"), F.col("b"))
    return maps.select("user_id", F.array_join(F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",").alias("merged"))


_CLAIM_N = rf"trim(regexp_replace(lower(coalesce(report_title,'')),'{WS}',' ','g'))"


def _tok(x: str) -> str:
    return TOKENS.replace("(n,", f"({x},")


@query(
    f"SELECT manifest_id, round(CASE WHEN len(a)>0 THEN len(list_intersect(a,b))/len(a)::DOUBLE ELSE 0.0 END,4) AS overlap FROM (SELECT g.manifest_id, {_tok(_CLAIM_N)} AS a, {_tok('e.n')} AS b FROM golden_manifest g JOIN (SELECT sample_id, trim(regexp_replace(lower(coalesce(text_excerpt,'')),'{WS}',' ','g')) AS n FROM {_LATEST}) e ON g.sample_id=e.sample_id)"
)
def claim_overlap(spark, d):
    facts = table(spark, d, "golden_manifest").select("sample_id", "manifest_id", "report_title")
    out = E.claim_support(facts, _latest(spark, d), "sample_id", "manifest_id", "report_title", "text_excerpt")
    return out.select("manifest_id", F.round("overlap", 4).alias("overlap"))


@query()
def source_evidence(spark, d):
    rows = table(spark, d, "extracted_documents").select("extract_id", "sample_id", "loaded_at", F.col("text_excerpt").alias("text"), "links")
    latest = J.pick_one(rows, ["sample_id"], [F.coalesce(-F.unix_micros("loaded_at"), F.lit(2**62)), -F.col("extract_id")])
    pack = F.concat_ws(" ", "source_document_path", "source_format", "source_file_name", "source_sha256", F.col("source_page_count").cast("string"), "source_parse_quality")
    sources = table(spark, d, "golden_manifest").select("sample_id", F.col("manifest_id").alias("at"), pack.alias("text"), F.col("source_document_path").alias("href"))
    charts = table(spark, d, "chart_candidates").select(F.col("report_id").alias("sample_id"), F.col("chart_row_id").alias("at"), "chart_id", "source_note", "nearby_text")
    out = E.source_evidence("sample_id", latest, latest, sources, charts)
    return out.withColumn("authority_terms", F.array_join("authority_terms", "|"))


@query()
def evidence_topk(spark, d):
    facts = table(spark, d, "golden_manifest").select("sample_id", "manifest_id", F.concat_ws(" ", "report_title", "query").alias("claim"))
    chunks = E.chunked(_latest(spark, d), "sample_id", "text_excerpt", neighbours=1)
    return E.evidence_packs(facts, chunks, "sample_id", "manifest_id", "claim").select("manifest_id", "rank", "chunk_index", "score")


@query(
    f"SELECT g.manifest_id, nh<>'' AND (contains(e.n,nh) OR (len(a)>0 AND len(list_intersect(a,b))/len(a)::DOUBLE>=0.42)) AS present FROM (SELECT *, {_CLAIM_N} AS nh, {_tok(_CLAIM_N)} AS a FROM golden_manifest) g JOIN (SELECT sample_id, n, {TOKENS} AS b FROM (SELECT sample_id, trim(regexp_replace(lower(array_to_string(coalesce(headings,[]),chr(10))),'{WS}',' ','g')) AS n FROM {_LATEST})) e ON g.sample_id=e.sample_id"
)
def fuzzy_headings(spark, d):
    facts = table(spark, d, "golden_manifest").select("sample_id", "manifest_id", X.collapse_spaces(F.lower("report_title")).alias("needle"))
    docs = _latest(spark, d).select("sample_id", X.collapse_spaces(F.lower(F.array_join(F.coalesce("headings", F.array().cast("array<string>")), "\n"))).alias("hay"))
    return facts.join(docs, "sample_id").select("manifest_id", X.contains_fuzzy(F.col("needle"), F.col("hay")).alias("present"))


@query(
    "SELECT chart_row_id, count(k) AS n_near FROM (SELECT c.chart_row_id, CASE WHEN least(c.bbox[3],b.bbox[3])-greatest(c.bbox[1],b.bbox[1])>-80 AND b.bbox[4]>=c.bbox[2]-130 AND b.bbox[2]<=c.bbox[4]+170 THEN 1 END AS k FROM chart_candidates c LEFT JOIN (SELECT report_id, page, bbox FROM chart_candidates WHERE bbox IS NOT NULL AND page IS NOT NULL AND len(list_filter(bbox, lambda x: x IS NULL))=0) b ON c.report_id=b.report_id AND c.page=b.page) GROUP BY chart_row_id"
)
def near_boxes(spark, d):
    charts = table(spark, d, "chart_candidates").select("report_id", "page", "chart_row_id", "bbox", F.coalesce("title", F.lit("")).alias("title"))
    blocks = charts.where("bbox is not null and page is not null").select("report_id", "page", F.col("bbox").alias("block_box"), F.col("title").alias("text"))
    return J.near_boxes(charts, blocks, ["report_id", "page"], "chart_row_id").select("chart_row_id", "n_near")


@query()
def suppressed_boxes(spark, d):
    charts = table(spark, d, "chart_candidates").select("report_id", "page", "chart_row_id", "bbox", F.coalesce("candidate_score", F.lit(0.0)).alias("score"))
    return J.suppress_overlaps(charts, ["report_id", "page"], "chart_row_id", "score").select("report_id", "page", "chart_row_id")


@query()
def box_clusters(spark, d):
    charts = table(spark, d, "chart_candidates").where("bbox is not null").select("report_id", "page", "chart_row_id", "bbox")
    return J.cluster_boxes(charts, ["report_id", "page"], "chart_row_id").select("chart_row_id", "cluster_id")


# --- aggregates ---------------------------------------------------------------------------


def _field_sql(fields, table_name, body):
    return " UNION ALL ".join(f"SELECT '{f}' AS field, coalesce(nullif(trim({f}::VARCHAR,' '),''),'unknown') AS value, {body} FROM {table_name} GROUP BY 2" for f in fields)


@query(_field_sql(["language", "chosen_selector", "institution"], "article_quality", "count(*) AS n, round((avg(quality_score))::DECIMAL(38,10),2)::DOUBLE AS avg_score, min(quality_score) AS min_score, max(quality_score) AS max_score, sum(coalesce(article_like,false)::INT) AS passed, round((sum(coalesce(article_like,false)::INT)/count(*)::DOUBLE)::DECIMAL(38,10),3)::DOUBLE AS pass_rate"))
def layered_summary(spark, d):
    return A.layered_summary(table(spark, d, "article_quality"), ["language", "chosen_selector", "institution"], "quality_score", "article_like")


@query("SELECT field, value, n, round((100.0::DOUBLE*n/sum(n) OVER (PARTITION BY field))::DECIMAL(38,10),2)::DOUBLE AS share FROM (" + _field_sql(["suite", "query_language", "strategy_subtype", "quality_tier", "source_format"], "golden_manifest", "count(*) AS n") + ")")
def distributions(spark, d):
    return A.distributions(table(spark, d, "golden_manifest"), ["suite", "query_language", "strategy_subtype", "quality_tier", "source_format"])


@query("SELECT field, value, count(*) AS n FROM (SELECT 'reject_reasons' AS field, unnest(reject_reasons) AS value FROM article_quality UNION ALL SELECT 'warnings', unnest(warnings) FROM article_quality) WHERE value IS NOT NULL GROUP BY 1,2")
def reason_histogram(spark, d):
    return A.array_histogram(table(spark, d, "article_quality"), ["reject_reasons", "warnings"])


@query("SELECT o_orderpriority, count(o_totalprice) AS n, min(o_totalprice) AS min, round((avg(o_totalprice))::DECIMAL(38,10),2)::DOUBLE AS mean, round((median(o_totalprice))::DECIMAL(38,10),2)::DOUBLE AS median, max(o_totalprice) AS max FROM orders GROUP BY 1")
def score_statistics(spark, d):
    return A.statistics(table(spark, d, "orders"), "o_totalprice", ["o_orderpriority"])


@query("SELECT coalesce(nullif(trim(event_type),''),'unknown') AS event_type, count(*) AS calls, round((sum(value))::DECIMAL(38,10),2)::DOUBLE AS sum_value, round((avg(value))::DECIMAL(38,10),2)::DOUBLE AS avg_value, sum(greatest(0, coalesce(attempts,0)-1)) AS retries, sum((event_type='error')::INT) AS errors FROM (SELECT *, (user_id%4)::INT AS attempts FROM events) GROUP BY 1")
def token_usage(spark, d):
    calls = table(spark, d, "events").select("event_type", "value", (F.col("user_id") % 4).cast("int").alias("attempts"), F.when(F.col("event_type") == "error", "error").alias("error"))
    return A.usage_by(calls, "event_type", ["value"], "attempts", "error")


@query("SELECT coalesce(nullif(trim(source),''),'unknown') AS value, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def top_sources(spark, d):
    return A.top_counts(table(spark, d, "documents"), "source")


@query("SELECT event_type, min(substring(ts::VARCHAR,1,10)) AS first_day, max(substring(ts::VARCHAR,1,10)) AS last_day, count(*) AS n FROM events GROUP BY 1")
def date_ranges(spark, d):
    return A.date_range(table(spark, d, "events"), "ts", ["event_type"])


@query("SELECT l_returnflag, round((coalesce(avg(l_discount),0.0))::DECIMAL(38,10),6)::DOUBLE AS mean_discount, round((sum(l_discount*l_quantity) FILTER (WHERE l_quantity>0)/sum(l_quantity) FILTER (WHERE l_quantity>0))::DECIMAL(38,10),6)::DOUBLE AS weighted_discount FROM lineitem GROUP BY 1")
def weighted_means(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.groupBy("l_returnflag").agg(N.half_up(A.nan_mean(F.col("l_discount")), 6).alias("mean_discount"), N.half_up(A.weighted_mean(F.col("l_discount"), F.col("l_quantity")), 6).alias("weighted_discount"))


@query(
    "SELECT l_orderkey, count(*) AS n, round((avg(l_discount))::DECIMAL(38,10),4)::DOUBLE AS mean_score, round((avg(l_discount) FILTER (WHERE rn<=3))::DECIMAL(38,10),4)::DOUBLE AS worst_mean, round((0.7::DOUBLE*avg(l_discount)+(1-0.7::DOUBLE)*avg(l_discount) FILTER (WHERE rn<=3))::DECIMAL(38,10),4)::DOUBLE AS blended FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount) AS rn FROM lineitem WHERE l_discount IS NOT NULL) GROUP BY 1"
)
def worst_blend(spark, d):
    return A.worst_blend(table(spark, d, "lineitem").select("l_orderkey", "l_discount"), ["l_orderkey"], "l_discount")


@query(
    "SELECT report_id, count(bbox) AS boxes, min(bbox[1]) AS x0, min(bbox[2]) AS y0, max(bbox[3]) AS x1, max(bbox[4]) AS y1 FROM chart_candidates GROUP BY 1"
)
def box_unions(spark, d):
    return A.box_union(table(spark, d, "chart_candidates").select("report_id", "bbox"), ["report_id"], "bbox")


@query(
    "SELECT coalesce(nullif(trim(language),''),'unknown') AS language, count(*) AS n_distinct, array_to_string(list(url ORDER BY url) FILTER (WHERE rn<=20),' ') AS samples FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY url) AS rn FROM (SELECT DISTINCT coalesce(nullif(trim(language),''),'unknown') AS language, url FROM article_quality WHERE url IS NOT NULL)) GROUP BY 1"
)
def distinct_urls(spark, d):
    rows = table(spark, d, "article_quality").select(A.named("language").alias("language"), "url")
    return A.distinct_with_samples(rows, ["language"], "url")


@query(
    "SELECT count(*) AS total, sum((coalesce(parse_quality IN ('ok','skipped','good','excellent'),false))::INT) AS completed, sum((NOT coalesce(parse_quality IN ('ok','skipped','good','excellent'),false))::INT) AS failures, round((sum(page_count))::DECIMAL(38,10),2)::DOUBLE AS total_seconds, max(page_count) AS max_seconds FROM extracted_documents"
)
def batch_completion(spark, d):
    rows = table(spark, d, "extracted_documents").withColumn("status", F.when(F.col("parse_quality").isin("good", "excellent"), "ok").otherwise(F.col("parse_quality")))
    return A.completion(rows, "status", [], "page_count")


@query(
    "SELECT report_id, object_role, round((avg(v))::DECIMAL(38,10),4)::DOUBLE AS score, count(v) AS items FROM (SELECT report_id, object_role, chart_id, arg_max(candidate_score, chart_row_id) FILTER (WHERE true) AS v0, list(candidate_score ORDER BY chart_row_id DESC)[1] AS v FROM chart_candidates GROUP BY ALL) GROUP BY ALL"
)
def checklist_groups(spark, d):
    rows = table(spark, d, "chart_candidates").select("report_id", "object_role", "chart_id", "candidate_score", "chart_row_id")
    return A.checklist_scores(rows, ["report_id"], "chart_id", "object_role", "candidate_score", "chart_row_id")


@query(
    "SELECT e AS error FROM (SELECT unnest(list_filter([CASE WHEN sum((language='en')::INT)<10 THEN 'en_below_10' END, CASE WHEN sum((language='zh')::INT)<9999999 THEN 'zh_below_9999999' END, CASE WHEN sum((language='de')::INT)>5 THEN 'de_above_5' END, CASE WHEN count(DISTINCT coalesce(nullif(trim(subtype),''),'unknown'))<50 THEN 'distinct_subtype_below_50' END], lambda x: x IS NOT NULL)) AS e FROM frozen_html_set) UNION ALL SELECT 'institution_above_3' FROM (SELECT max(n) AS m FROM (SELECT count(*) AS n FROM frozen_html_set GROUP BY coalesce(nullif(trim(institution),''),'unknown'))) WHERE m>3"
)
def set_requirements(spark, d):
    lang = F.col("language")
    return A.requirement_errors(table(spark, d, "frozen_html_set"), {"en": (lang == "en", 10), "zh": (lang == "zh", 9999999)}, {"de": (lang == "de", 5)}, ("institution", 3), ("subtype", 50))


# --- windows, order -----------------------------------------------------------------------


@query("SELECT extract_id, CASE WHEN rn>1 THEN substring(sample_id,1,90-length('_'||rn))||'_'||rn ELSE substring(sample_id,1,90) END AS unique_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY extract_id) AS rn FROM extracted_documents)")
def uniquify_ids(spark, d):
    return W.uniquify(table(spark, d, "extracted_documents").select("extract_id", "sample_id"), "sample_id", [F.col("extract_id")], by_sort=True).select("extract_id", "unique_id")


@query(
    "SELECT article_id, url FROM (SELECT *, row_number() OVER (PARTITION BY institution ORDER BY s, article_id) AS rn FROM (SELECT * FROM (SELECT article_id, url, institution, -coalesce(quality_score,-1) AS s, row_number() OVER (PARTITION BY url ORDER BY -coalesce(quality_score,-1), article_id) AS u FROM article_quality) WHERE u=1)) WHERE rn<=3"
)
def cap_per_institution(spark, d):
    rows = table(spark, d, "article_quality").select("article_id", "url", "institution", (-F.coalesce("quality_score", F.lit(-1.0))).alias("s"))
    return W.cap_per_group(rows, "institution", "url", [F.col("s"), F.col("article_id")], 3).select("article_id", "url")


@query("SELECT doc_id, lang, rank FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC NULLS LAST, doc_id) AS rank FROM documents WHERE lang IN ('en','zh')) WHERE rank<=25")
def balanced_languages(spark, d):
    rows = table(spark, d, "documents").where("lang in ('en','zh')").select("doc_id", "lang", "n_chars")
    return W.top_per_group(rows, ["lang"], [F.desc_nulls_last("n_chars"), F.col("doc_id")], 25).select("doc_id", "lang", "rank")


@query()
def quota_selection(spark, d):
    rows = table(spark, d, "golden_manifest").select("manifest_id", A.named("institution_name").alias("institution"), A.named("strategy_subtype").alias("subtype"), "source_sha256", F.coalesce("key_fact_count", F.lit(0)).alias("score"))
    return W.quota_selection(rows, [("score", True), ("manifest_id", False)], {"institution": 2, "subtype": 12}, 60, "source_sha256").select("manifest_id", "institution", "subtype")


@query(
    "SELECT manifest_id, suite, band FROM (SELECT *, CASE WHEN n<=10 THEN 'all' WHEN rn<=3 THEN 'low' WHEN rn>n-4 THEN 'high' WHEN rn>3 AND rn<=n-4 AND (rn-4)%greatest(1,n//3)=0 AND (rn-4)//greatest(1,n//3)<3 THEN 'middle' END AS band FROM (SELECT manifest_id, suite, row_number() OVER (PARTITION BY suite ORDER BY key_fact_count NULLS FIRST, manifest_id) AS rn, count(*) OVER (PARTITION BY suite) AS n FROM golden_manifest)) WHERE band IS NOT NULL"
)
def stratified_sample(spark, d):
    rows = table(spark, d, "golden_manifest").select("manifest_id", "suite", "key_fact_count")
    return W.stratified(rows, ["suite"], "key_fact_count", "manifest_id", 10).select("manifest_id", "suite", "band")


@query("SELECT l_orderkey, l_linenumber, context FROM (SELECT l_orderkey, l_linenumber, string_agg(l_returnflag||l_linestatus||l_linenumber, '/') OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS context FROM lineitem)")
def neighbour_context(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("place"), F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("t"))
    return W.neighbours(rows, ["l_orderkey"], "place", "t", 1, "context", "/").select("l_orderkey", "l_linenumber", "context")


@query(
    'SELECT extract_id, start, coalesce(lead(start) OVER (PARTITION BY extract_id ORDER BY start), least(start+3000, n)) AS "end" FROM (SELECT DISTINCT extract_id, strpos(t, lower(h)) AS start, length(t) AS n FROM (SELECT extract_id, lower(coalesce(text_excerpt,\'\')) AS t, unnest(headings) AS h FROM extracted_documents) WHERE h IS NOT NULL AND h<>\'\' AND strpos(t, lower(h))>0)'
)
def section_ends(spark, d):
    rows = table(spark, d, "extracted_documents").select("extract_id", F.lower(X.text_or_empty("text_excerpt")).alias("t"), F.explode("headings").alias("h")).where("h is not null and h != ''")
    found = rows.select("extract_id", F.expr("locate(lower(h), t)").alias("start"), F.length("t").alias("n")).where("start > 0").distinct()
    return W.section_ends(found, ["extract_id"], "start", F.col("n")).select("extract_id", "start", "end")


@query(
    "SELECT doc_id, num, start FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY num) AS rn FROM (SELECT doc_id, num, min(pos) AS start FROM (SELECT doc_id, pos, try_cast(nullif(regexp_extract(l,'^\\(?([0-9]{1,3})[.)] ',1),'') AS INT) AS num FROM (SELECT doc_id, unnest(s) AS l, unnest(range(1,len(s)+1)) AS pos FROM (SELECT doc_id, string_split(coalesce(text,''),chr(10)) AS s FROM documents))) WHERE num IS NOT NULL GROUP BY 1,2)) WHERE rn=num) WHERE n>=2"
)
def numbered_headings(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(X.text_or_empty("text"), "\n")).alias("p", "l"))
    nums = rows.select("doc_id", F.nullif(F.regexp_extract("l", r"^\(?([0-9]{1,3})[.)] ", 1), F.lit("")).cast("int").alias("num"), (F.col("p") + 1).alias("start"))
    return W.running_numbers(nums, ["doc_id"], "num", "start").select("doc_id", "num", "start")


@query(
    "SELECT chart_row_id, place FROM (SELECT chart_row_id, row_number() OVER (PARTITION BY report_id ORDER BY later, s, chart_row_id) AS place FROM (SELECT chart_row_id, report_id, -coalesce(candidate_score,-1) AS s, (row_number() OVER (PARTITION BY report_id, page ORDER BY -coalesce(candidate_score,-1), chart_row_id)>1)::INT AS later FROM chart_candidates)) WHERE place<=6"
)
def diverse_charts(spark, d):
    rows = table(spark, d, "chart_candidates").select("chart_row_id", "report_id", "page", (-F.coalesce("candidate_score", F.lit(-1.0))).alias("s"))
    return W.diverse_top(rows, ["report_id"], "page", [F.col("s"), F.col("chart_row_id")], 6).select("chart_row_id", "place")


@query("SELECT chart_row_id, row_number() OVER (PARTITION BY report_id, page ORDER BY chart_row_id) AS place, count(*) OVER (PARTITION BY report_id, page) AS on_page FROM chart_candidates")
def object_places(spark, d):
    rows = table(spark, d, "chart_candidates").select("chart_row_id", "report_id", "page")
    return W.object_places(rows, ["report_id", "page"], [F.col("chart_row_id")], by_sort=True).select("chart_row_id", "place", "on_page")


@query(
    "SELECT report_id, CASE WHEN len(s)=0 THEN 0 ELSE 1+len(list_filter(range(2,len(s)+1), lambda i: s[i]-s[i-1]>=25)) END AS centers FROM (SELECT report_id, list_sort(list_filter(list((bbox[1]+bbox[3])/2), lambda x: x IS NOT NULL)) AS s FROM chart_candidates GROUP BY report_id)"
)
def distinct_centers(spark, d):
    middle = (F.get("bbox", 0) + F.get("bbox", 2)) / 2
    return W.center_counts(table(spark, d, "chart_candidates").select("report_id", "bbox"), ["report_id"], middle, 25.0)


@query("SELECT text_hash, min(doc_id) AS doc_id FROM (SELECT doc_id, md5(coalesce(text,'')) AS text_hash FROM documents) GROUP BY 1")
def dedupe_first(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.md5(X.text_or_empty("text")).alias("text_hash"))
    return W.first_per_key(rows, ["text_hash"], [F.col("doc_id")]).select("text_hash", "doc_id")


@query("SELECT url, article_id, quality_score FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY quality_score DESC NULLS LAST, article_id) AS rn FROM article_quality) WHERE rn=1")
def dedupe_best(spark, d):
    rows = table(spark, d, "article_quality").select("url", "article_id", "quality_score")
    return W.first_per_key(rows, ["url"], [F.coalesce(-F.col("quality_score"), F.lit(1e18)), F.col("article_id")]).select("url", "article_id", "quality_score")


@query("SELECT chart_id, chart_row_id, candidate_tier FROM (SELECT *, row_number() OVER (PARTITION BY chart_id ORDER BY chart_row_id DESC) AS rn FROM chart_candidates) WHERE rn=1")
def dedupe_last(spark, d):
    return W.last_per_key(table(spark, d, "chart_candidates").select("chart_id", "chart_row_id", "candidate_tier"), ["chart_id"], "chart_row_id").select("chart_id", "chart_row_id", "candidate_tier")


@query("SELECT doc_id, 'fact_'||lpad(rn::VARCHAR,3,'0') AS item_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY fetched_at, doc_id) AS rn FROM documents WHERE regexp_matches(coalesce(text,''),'[0-9]')) WHERE rn<=12")
def numbered_facts(spark, d):
    rows = table(spark, d, "documents").where("text rlike '[0-9]'").select("doc_id", "source", "fetched_at")
    return W.numbered(rows, ["source"], [F.col("fetched_at"), F.col("doc_id")], 12).select("doc_id", "item_id")


@query("SELECT event_id, coalesce(sum(c) OVER w,0)>=20 AND c>0 AS skipped FROM (SELECT *, (event_type<>'view')::INT AS c FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def running_budget(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", (F.col("event_type") != "view").cast("int").alias("c"))
    return W.over_budget(rows, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("c"), 20).select("event_id", "skipped")


@query("SELECT extract_id, sha256 IS NOT NULL AND count(*) OVER (PARTITION BY sha256)>1 AS duplicate_file_hash FROM extracted_documents")
def repeated_hashes(spark, d):
    return W.flag_repeats(table(spark, d, "extracted_documents").select("extract_id", "sha256"), "sha256", "duplicate_file_hash").select("extract_id", "duplicate_file_hash")


@query("SELECT chart_row_id, rank, rank<=5 AS selected FROM (SELECT chart_row_id, row_number() OVER (PARTITION BY report_id ORDER BY candidate_score DESC NULLS LAST, chart_row_id) AS rank FROM chart_candidates)")
def topk_overflow(spark, d):
    rows = table(spark, d, "chart_candidates").select("chart_row_id", "report_id", "candidate_score")
    return W.top_with_overflow(rows, ["report_id"], [F.desc_nulls_last("candidate_score"), F.col("chart_row_id")], 5, by_sort=True).select("chart_row_id", "rank", "selected")


_RANK = "CASE severity WHEN 'blocker' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 9 END"
_SEV = "CASE l_linenumber%4 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'blocker' ELSE 'other' END"


@query(f"SELECT l_suppkey, l_orderkey, severity, issue_no FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {_RANK}, l_orderkey*1000+l_linenumber*10, l_partkey) AS issue_no FROM (SELECT *, {_SEV} AS severity FROM lineitem)) WHERE issue_no<=5")
def ranked_issues(spark, d):
    severity = F.when(F.col("l_linenumber") % 4 == 0, "high").when(F.col("l_linenumber") % 4 == 1, "low").when(F.col("l_linenumber") % 4 == 2, "blocker").otherwise("other")
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", severity.alias("severity"), F.struct(F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10, "l_partkey").alias("at"))
    return scoring.ranked_issues(rows, ["l_suppkey"], "severity", "at", 5).select("l_suppkey", "l_orderkey", "severity", "issue_no")


@query("SELECT article_id, quality_score FROM article_quality ORDER BY coalesce(nullif(quality_score,0),-1), article_id LIMIT 10")
def lowest_scores(spark, d):
    return scoring.lowest(table(spark, d, "article_quality"), "article_id", "quality_score")


# --- sets ---------------------------------------------------------------------------------


@query(
    "SELECT (SELECT count(*) FROM (SELECT title FROM documents UNION ALL SELECT title FROM article_quality)) AS n_all, (SELECT count(*) FROM (SELECT title FROM documents INTERSECT SELECT title FROM article_quality)) AS n_both, (SELECT count(*) FROM (SELECT title FROM documents EXCEPT SELECT title FROM article_quality)) AS n_only, (SELECT count(*) FROM (SELECT DISTINCT title FROM documents)) AS n_distinct"
)
def title_sets(spark, d):
    a, b = table(spark, d, "documents").select("title"), table(spark, d, "article_quality").select("title")
    parts = a.unionAll(b).select(F.lit("n_all").alias("k")), a.intersect(b).select(F.lit("n_both").alias("k")), a.subtract(b).select(F.lit("n_only").alias("k")), a.distinct().select(F.lit("n_distinct").alias("k"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    return rows.agg(*(F.count_if(F.col("k") == k).alias(k) for k in ("n_all", "n_both", "n_only", "n_distinct")))


@query("SELECT extract_id, array_to_string(list_sort(list_distinct(list_concat(range(0,least(18,p)), range(greatest(0,p-6),p)))),',') AS pages FROM (SELECT extract_id, coalesce(page_count,0) AS p FROM extracted_documents)")
def page_sets(spark, d):
    p = F.coalesce("page_count", F.lit(0))
    span = lambda a, b: F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))
    pages = F.array_sort(F.array_union(span(F.lit(0), F.least(F.lit(18), p)), span(F.greatest(F.lit(0), p - 6), p)))
    return table(spark, d, "extracted_documents").select("extract_id", F.array_join(F.transform(pages, lambda x: x.cast("string")), ",").alias("pages"))


@query("SELECT g.manifest_id FROM golden_manifest g WHERE sample_id IS NULL OR sample_id NOT IN (SELECT sample_id FROM extracted_documents)")
def pending_samples(spark, d):
    return files.pending(table(spark, d, "golden_manifest"), table(spark, d, "extracted_documents"), ["sample_id"]).select("manifest_id")


# --- geometry -----------------------------------------------------------------------------

_AREA = "greatest(0.0,bbox[3]-bbox[1])*greatest(0.0,bbox[4]-bbox[2])"
_PAGE = "greatest(0.0,page_bbox[3]-page_bbox[1])*greatest(0.0,page_bbox[4]-page_bbox[2])"


@query(
    f"SELECT chart_row_id, round(coalesce({_AREA},0.0)::DECIMAL(38,10),2)::DOUBLE AS area, coalesce(a/nullif(p,0)>=0.01 AND a/nullif(p,0)<=0.95 AND greatest(bbox[3]-bbox[1],bbox[4]-bbox[2])/nullif(least(bbox[3]-bbox[1],bbox[4]-bbox[2]),0)<=12,false) AS usable FROM (SELECT *, coalesce({_AREA},0.0) AS a, coalesce({_PAGE},0.0) AS p FROM chart_candidates)"
)
def box_shapes(spark, d):
    b, p = F.col("bbox"), F.col("page_bbox")
    return table(spark, d, "chart_candidates").select("chart_row_id", N.half_up(G.area(b), 2).alias("area"), G.usable(b, p).alias("usable"))


@query(
    f"SELECT chart_row_id, array_to_string(list_filter([CASE WHEN bbox IS NULL THEN 'no_box' END, CASE WHEN a/nullif(p,0)<0.02 THEN 'too_small' END, CASE WHEN a/nullif(p,0)>0.85 THEN 'whole_page' END, CASE WHEN bbox[1]<=page_bbox[1] OR bbox[2]<=page_bbox[2] OR bbox[3]>=page_bbox[3] OR bbox[4]>=page_bbox[4] THEN 'touches_edge' END, CASE WHEN greatest(bbox[3]-bbox[1],bbox[4]-bbox[2])/nullif(least(bbox[3]-bbox[1],bbox[4]-bbox[2]),0)>8 THEN 'extreme_shape' END], lambda x: x IS NOT NULL),';') AS flags FROM (SELECT *, coalesce({_AREA},0.0) AS a, coalesce({_PAGE},0.0) AS p FROM chart_candidates)"
)
def crop_quality(spark, d):
    return table(spark, d, "chart_candidates").select("chart_row_id", F.array_join(C.crop_flags(F.col("bbox"), F.col("page_bbox")), ";").alias("flags"))


# --- scoring ------------------------------------------------------------------------------


def _articles(spark, d):
    c = F.col
    rows = table(spark, d, "article_quality").select("article_id", "quality_score", "long_paragraph_count", "link_text_ratio", "report_signal_count")
    parts = {"quality": N.clamp(F.coalesce(c("quality_score") / 100, F.lit(0.0))), "depth": N.saturation(F.coalesce("long_paragraph_count", F.lit(0)), 4), "focus": N.clamp(1 - F.coalesce(c("link_text_ratio"), F.lit(1.0))), "signals": N.saturation(F.coalesce("report_signal_count", F.lit(0)), 5)}
    return rows.select("article_id", *(v.alias(k) for k, v in parts.items()))


_WEIGHTS = {"quality": 40.0, "depth": 20.0, "focus": 20.0, "signals": 20.0}
_SAT = "CASE WHEN {c}<=0 THEN 0.0 ELSE greatest(0.0,least(1.0,1-exp(-ln(5.0)*{c}/{t}))) END"
_ART = (
    "(SELECT article_id, greatest(0.0,least(1.0,coalesce(quality_score/100,0.0))) AS quality, " + _SAT.format(c="coalesce(long_paragraph_count,0)", t=4) + " AS depth, greatest(0.0,least(1.0,1-coalesce(link_text_ratio,1.0))) AS focus, " + _SAT.format(c="coalesce(report_signal_count,0)", t=5) + " AS signals FROM article_quality)"
)


@query(
    f"SELECT article_id, overall, CASE WHEN overall>=90 THEN 'Gold' WHEN overall>=80 THEN 'Silver' WHEN overall>=70 THEN 'Bronze' ELSE 'Reject' END AS grade, array_to_string(list_filter([CASE WHEN overall<70 THEN 'overall_below_threshold' END, CASE WHEN round(focus,3)<0.6 THEN 'focus_below_threshold' END],lambda x: x IS NOT NULL),';') AS failures FROM (SELECT article_id, focus, round(quality*40.0+depth*20.0+focus*20.0+signals*20.0,2) AS overall FROM {_ART})"
)
def weighted_grades(spark, d):
    rows = _articles(spark, d)
    out = rows.select("article_id", N.weighted_sum({k: F.col(k) for k in _WEIGHTS}, _WEIGHTS).alias("overall"), F.create_map(F.lit("focus"), F.round("focus", 3)).alias("dims"))
    fails = scoring.gate_failures(F.col("overall"), F.col("dims"), {"overall": 70.0, "focus": 0.6, "depth": None})
    return out.select("article_id", "overall", scoring.grade(F.col("overall")).alias("grade"), F.array_join(fails, ";").alias("failures"))


@query(
    f"SELECT article_id, round(sum(least(1.0,greatest(0.0,coalesce(b,s)))*w),2) AS overall FROM (SELECT m.article_id, m.w, m.s, 0.7*m.s+(1-0.7)*j.judged AS b FROM (SELECT article_id, 'quality' AS module, quality AS s, 40.0 AS w FROM {_ART} UNION ALL SELECT article_id, 'depth', depth, 20.0 FROM {_ART} UNION ALL SELECT article_id, 'focus', focus, 20.0 FROM {_ART} UNION ALL SELECT article_id, 'signals', signals, 20.0 FROM {_ART}) m LEFT JOIN (SELECT article_id, 'quality' AS module, (article_id%10)/10.0 AS judged FROM article_quality WHERE article_like) j ON m.article_id=j.article_id AND m.module=j.module) GROUP BY 1"
)
def judged_totals(spark, d):
    long = scoring.long_modules(_articles(spark, d), "article_id", {k: F.col(k) for k in _WEIGHTS})
    judged = table(spark, d, "article_quality").where("article_like").select("article_id", F.lit("quality").alias("module"), ((F.col("article_id") % 10) / 10.0).alias("judged"))
    return scoring.total_scores(scoring.with_judgements(long, judged, "article_id", {"quality": 0.7}), "article_id", _WEIGHTS).select("article_id", "overall")


@query(
    f"SELECT article_id, module, rank FROM (SELECT article_id, module, row_number() OVER (PARTITION BY article_id ORDER BY s DESC, module) AS rank FROM (SELECT article_id, 'depth' AS module, depth AS s FROM {_ART} UNION ALL SELECT article_id, 'signals', signals FROM {_ART} UNION ALL SELECT article_id, 'quality', quality FROM {_ART}) WHERE s>=0.82 AND NOT (module='focus')) WHERE rank<=4"
)
def module_strengths(spark, d):
    long = scoring.long_modules(_articles(spark, d), "article_id", {k: F.col(k) for k in _WEIGHTS})
    about = _articles(spark, d).select("article_id", F.lit("focus").alias("module"))
    return scoring.strengths(long, about, "article_id").select("article_id", "module", "rank")


@query(
    f"SELECT m.article_id, m.module, coalesce(i.n,0) AS issues FROM (SELECT article_id, unnest(['quality','depth','focus','signals']) AS module FROM article_quality) m LEFT JOIN (SELECT article_id, 'focus' AS module, count(*) AS n FROM (SELECT article_id, unnest(warnings) AS w FROM article_quality) GROUP BY 1) i ON m.article_id=i.article_id AND m.module=i.module"
)
def issues_by_module(spark, d):
    long = scoring.long_modules(_articles(spark, d), "article_id", {k: F.col(k) for k in _WEIGHTS})
    issues = table(spark, d, "article_quality").select("article_id", F.explode("warnings").alias("w")).select("article_id", F.lit("focus").alias("module"))
    return J.group_issues(long, issues, ["article_id"]).select("article_id", "module", "issues")


def _sat(count: str, target: int) -> str:
    return f"(CASE WHEN {count}<=0 THEN 0.0 ELSE greatest(0.0,least(1.0,1-exp(-ln(5.0)*{count}/{target}))) END)"


_CAND_TERMS = D.RISK_TERMS + D.SCENARIO_TERMS
_OCC = "+".join(f"(length(n)-length(replace(n,'{t}','')))//{len(t)}" for t in D.SOURCE_TERMS)
_COVER = "+".join("CASE WHEN " + " OR ".join(f"contains(n,'{t}')" for t in terms) + " THEN 1 ELSE 0 END" for terms in D.SECTION_GROUPS.values())
_CAND = (
    "(SELECT *, round(structure*20.0+sources*20.0+numbers*20.0+scenario_risk*25.0+delivery*15.0,2) AS overall FROM (SELECT *, "
    f"({_COVER})/{float(len(D.SECTION_GROUPS))} AS structure, {_sat('(' + _OCC + ')', 3)} AS sources, "
    + _sat("len(regexp_extract_all(n,'[0-9]+(?:[.,][0-9]+)?\\s?(?:%|percent|billion|million|个|亿|bps|basis)'))", 8)
    + f" AS numbers, {_sat(f'len(list_filter({_list(_CAND_TERMS)}, lambda t: contains(n,t)))', 3)} AS scenario_risk, "
    f"CASE WHEN length(n)>=1800 THEN 1.0 WHEN length(n)>=600 THEN 0.7 WHEN length(n)>0 THEN 0.4 ELSE 0.0 END AS delivery FROM (SELECT *, {NORMAL} AS n FROM documents)))"
)
_FAILS = "array_to_string(list_filter([CASE WHEN overall<55 THEN 'overall_below_threshold' END, CASE WHEN round(structure,3)<0.3 THEN 'structure_below_threshold' END, CASE WHEN delivery<0.5 THEN 'delivery_below_threshold' END], lambda x: x IS NOT NULL),';')"


@query(f"SELECT doc_id, overall, CASE WHEN overall>=90 THEN 'Gold' WHEN overall>=80 THEN 'Silver' WHEN overall>=70 THEN 'Bronze' ELSE 'Reject' END AS grade, {_FAILS} AS failures FROM {_CAND}")
def candidate_reports(spark, d):
    out = pipeline.scored_reports(table(spark, d, "documents"), "doc_id", "text")
    return out.select("doc_id", "overall", "grade", F.array_join("failures", ";").alias("failures"))


@query()
def reference_reports(spark, d):
    cases = table(spark, d, "golden_manifest").where("sample_id is not null").select("sample_id", "report_title")
    return pipeline.evaluate_cases(cases, _latest(spark, d), None, "sample_id", "report_title", "text_excerpt").select("sample_id", "overall", "grade")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Reports scored from their texts, and summed up by language, subtype and source."""
    rows = table(spark, d, "documents").select("doc_id", "text", "lang", "subtype", "source")
    scored = pipeline.scored_reports(rows, "doc_id", "text").select("doc_id", "overall", "passed")
    return A.layered_summary(rows.drop("text").join(scored, "doc_id"), ["lang", "subtype", "source"], "overall", "passed")


QUERIES["candidate_summary"] = flagship
SQL["candidate_summary"] = _field_sql(["lang", "subtype", "source"], f"(SELECT lang, subtype, source, overall, {_FAILS}='' AS passed FROM {_CAND})", "count(*) AS n, round(avg(overall)::DECIMAL(38,10),2)::DOUBLE AS avg_score, min(overall) AS min_score, max(overall) AS max_score, sum(passed::INT) AS passed, round((sum(passed::INT)/count(*)::DOUBLE)::DECIMAL(38,10),3)::DOUBLE AS pass_rate")
