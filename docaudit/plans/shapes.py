"""Queries over shapes: nested rows, items of several kinds, links, pages of markup, bytes, boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from docaudit.functions import geometry as G
from docaudit.functions import html as H
from docaudit.functions import numbers as N
from docaudit.functions import structures as S
from docaudit.functions import text as X
from docaudit.operators import classify as C
from docaudit.operators import filters as FI
from docaudit.operators import projections as P
from docaudit.operators import scoring
from docaudit.plans.queries import query
from docaudit.session import table


@query("SELECT chart_row_id, bbox[1] AS \"box.x0\", bbox[2] AS \"box.y0\", title AS \"shown.title\", coalesce(unit_hint,'') AS \"shown.unit\" FROM chart_candidates")
def flattened_charts(spark, d):
    nested = table(spark, d, "chart_candidates").select("chart_row_id", F.struct(F.get("bbox", 0).alias("x0"), F.get("bbox", 1).alias("y0")).alias("box"), F.struct("title", F.coalesce("unit_hint", F.lit("")).alias("unit")).alias("shown"))
    return P.flatten(nested)


@query("SELECT chart_row_id, coalesce(CASE WHEN title NOT IN ('','0','0.0','false') THEN title END, CASE WHEN caption NOT IN ('','0','0.0','false') THEN caption END, CASE WHEN page_chart_id NOT IN ('','0','0.0','false') THEN page_chart_id END) AS label FROM chart_candidates")
def chart_labels(spark, d):
    return table(spark, d, "chart_candidates").select("chart_row_id", S.first_present(F.col("title"), F.col("caption"), F.col("page_chart_id")).alias("label"))


@query(
    "SELECT manifest_id, pos::INT AS pos, coalesce(text,'') AS text, id FROM (SELECT manifest_id, 1 AS pos, query AS text, 'item_001' AS id FROM golden_manifest WHERE trim(query,' ')<>'' AND ltrim(query,' ') NOT LIKE '[%' AND ltrim(query,' ') NOT LIKE '{%' "
    "UNION ALL SELECT manifest_id, CASE WHEN trim(query,' ')<>'' AND ltrim(query,' ') NOT LIKE '[%' AND ltrim(query,' ') NOT LIKE '{%' THEN 2 ELSE 1 END, report_title, CASE WHEN suite IS NOT NULL THEN suite WHEN trim(query,' ')<>'' AND ltrim(query,' ') NOT LIKE '[%' AND ltrim(query,' ') NOT LIKE '{%' THEN 'item_002' ELSE 'item_001' END FROM golden_manifest)"
)
def coerced_items(spark, d):
    """Items of a JSON array that are strings or objects with other names for their fields."""
    plain = F.when((F.trim("query") != "") & ~F.ltrim("query").startswith("[") & ~F.ltrim("query").startswith("{"), F.col("query"))
    as_json = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    items = F.concat(F.lit("["), F.concat_ws(",", F.when(plain.isNotNull(), as_json(plain)), F.to_json(F.struct(F.col("report_title").alias("claim"), F.col("suite").alias("id")))), F.lit("]"))
    rows = table(spark, d, "golden_manifest").select("manifest_id", F.posexplode(P.coerced_items(items, {"text": ["claim", "fact"], "id": ["fact_id"]}, "text", "id")).alias("p", "i"))
    return rows.select("manifest_id", (F.col("p") + 1).alias("pos"), F.coalesce("i.text", F.lit("")).alias("text"), "i.id")


@query(
    "SELECT extract_id, len(coalesce(links,[]))::INT AS n_links, len(list_filter(coalesce(links,[]), lambda l: coalesce(regexp_matches(lower(regexp_replace(l.href,'#.*$','')),'^[a-z][a-z0-9+.-]*://[^/]*/.*\\.pdf'),false)))::INT AS n_pdf, "
    "len(list_filter(coalesce(links,[]), lambda l: coalesce(contains(lower(l.href),'/n/'),false)))::INT AS n_noise FROM extracted_documents"
)
def link_kinds(spark, d):
    links = F.coalesce("links", F.array().cast("array<struct<text:string,href:string>>"))
    count = lambda test: F.size(F.filter(links, lambda link: test(link["href"])))
    return table(spark, d, "extracted_documents").select("extract_id", F.size(links).alias("n_links"), count(S.is_pdf_url).alias("n_pdf"), count(lambda u: S.is_noise_url(u, [], ["/n/"])).alias("n_noise"))


@query("SELECT article_id, coalesce(article_like,false) AS accepted FROM article_quality")
def routed_articles(spark, d):
    rows, _ = FI.routed(table(spark, d, "article_quality").select("article_id", "article_like"), F.col("article_like"), keep_rejected=True)
    return rows.select("article_id", "accepted")


@query(
    "SELECT article_id, CASE WHEN contains(x,'cookie') THEN n<1500 WHEN contains(x,'subscribe') OR contains(x,'newsletter') THEN n<360 ELSE n<80 END AS overlay FROM (SELECT article_id, length(coalesce(text_preview,'')) AS n, lower(coalesce(text_preview,'')) AS x FROM article_quality)"
)
def overlay_pages(spark, d):
    return table(spark, d, "article_quality").select("article_id", FI.overlay_text(F.col("text_preview"), ["cookie"], ["subscribe", "newsletter"]).alias("overlay"))


_BOX = "greatest(0, least(c[3],p[3])-greatest(c[1],p[1]))*greatest(0, least(c[4],p[4])-greatest(c[2],p[2]))"


@query(
    "SELECT chart_row_id, CASE WHEN a>0 THEN round(coalesce(i,0)/a,6) ELSE 0 END::DOUBLE AS inside, greatest(c[1]-20,p[1]) AS x0, greatest(c[2]-30,p[2]) AS y0, least(c[3]+20,p[3]) AS x1, least(c[4]+40,p[4]) AS y1 "
    f"FROM (SELECT chart_row_id, bbox AS c, page_bbox AS p, greatest(0,bbox[3]-bbox[1])*greatest(0,bbox[4]-bbox[2]) AS a, {_BOX.replace('c[', 'bbox[').replace('p[', 'page_bbox[')} AS i FROM chart_candidates WHERE bbox IS NOT NULL AND page_bbox IS NOT NULL)"
)
def grown_boxes(spark, d):
    rows = table(spark, d, "chart_candidates").where("bbox IS NOT NULL AND page_bbox IS NOT NULL")
    grown = G.expand(F.col("bbox"), F.col("page_bbox"), 20, 30, 40)
    return rows.select("chart_row_id", F.round(G.contained(F.col("page_bbox"), F.col("bbox")), 6).alias("inside"), *(F.get(grown, i).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))


@query(
    "SELECT article_id, CASE WHEN lower(trim(language,' ')) IN ('zh','en') THEN lower(trim(language,' ')) ELSE 'other' END AS language, CASE WHEN lower(language) LIKE 'zh%' THEN 'zh' WHEN lower(language) LIKE 'en%' THEN 'en' WHEN han>greatest(80, lat*0.2) THEN 'zh' ELSE 'en' END AS declared, "
    "CASE WHEN h9>20 THEN 'zh' ELSE 'en' END AS of_source FROM (SELECT article_id, language, len(regexp_extract_all(coalesce(text_preview,''),'[\\x{3400}-\\x{9fff}]')) AS han, len(regexp_extract_all(coalesce(text_preview,''),'[\\x{4e00}-\\x{9fff}]')) AS h9, len(regexp_extract_all(coalesce(text_preview,''),'[A-Za-z]')) AS lat FROM article_quality)"
)
def declared_languages(spark, d):
    t = F.col("text_preview")
    return table(spark, d, "article_quality").select("article_id", S.one_of(F.col("language"), ["zh", "en"], "other").alias("language"), C.declared_zh_or_en(F.col("language"), t).alias("declared"), C.source_zh_or_en(F.lit(None).cast("string"), t).alias("of_source"))


@query(
    "SELECT chart_row_id, list_transform(list_filter(coalesce(numbers,[]), lambda x: x IS NOT NULL AND trim(x,' ')<>''), lambda x: substring(x,1,6)) AS cut, TRY_CAST(replace(nullif(regexp_extract(numbers[1],'([-+]?[0-9][0-9,]*(?:[.][0-9]+)?)',1),''),',','') AS DOUBLE) AS first_number FROM chart_candidates"
)
def listed_numbers(spark, d):
    return table(spark, d, "chart_candidates").select("chart_row_id", S.listed(F.col("numbers"), 6).alias("cut"), N.numeric_scalar(F.get("numbers", F.lit(0))).alias("first_number"))


@query(
    "SELECT article_id, 'https://***@' || split_part(url,'://',2) || '?api_key=***&page=2' AS redacted FROM article_quality WHERE url LIKE 'https://%'"
)
def redacted_urls(spark, d):
    rows = table(spark, d, "article_quality").where("url LIKE 'https://%'")
    with_secrets = F.concat(F.lit("https://user:pw@"), F.element_at(F.split("url", "://"), 2), F.lit("?api_key=abc&page=2"))
    return rows.select("article_id", S.redact(with_secrets).alias("redacted"))


@query(
    "SELECT sample_id, round(1.0-CASE WHEN n<2000 THEN 0.20 ELSE 0 END-CASE WHEN w THEN 0.10 ELSE 0 END-CASE WHEN v THEN 0.06 ELSE 0 END,3)::DOUBLE AS confidence, concat_ws('|', CASE WHEN n<2000 THEN 'short_analysis_text' END, CASE WHEN w THEN 'extraction_warning' END, CASE WHEN v THEN 'no_visual_objects' END) AS reasons "
    "FROM (SELECT extract_id AS sample_id, length(coalesce(text_excerpt,'')) AS n, len(coalesce(extraction_warnings,[]))>0 AS w, len(coalesce(visual_images,[]))=0 AS v FROM extracted_documents)"
)
def evaluation_confidence(spark, d):
    size = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>")))
    score, reasons = scoring.confidence([(F.length(X.text_or_empty("text_excerpt")) < 2000, 0.20, "short_analysis_text"), (size("extraction_warnings") > 0, 0.10, "extraction_warning"), (size("visual_images") == 0, 0.06, "no_visual_objects")])
    return table(spark, d, "extracted_documents").select(F.col("extract_id").alias("sample_id"), score.alias("confidence"), F.array_join(reasons, "|").alias("reasons"))


def _page(title: str, text: str):
    """A page of markup around a text, one paragraph a line, with furniture that a reader must leave out."""
    safe = lambda c: F.replace(F.replace(F.replace(X.text_or_empty(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.array_join(F.transform(X.lines(text), lambda s: F.concat(F.lit("<p>"), safe(s), F.lit("</p>"))), "\n")
    return F.concat(F.lit("<html lang='en'><head><title>"), safe(title), F.lit("</title><style>p{background:url(a.png)}</style></head><body><script>var x = '<p>no</p>';</script><h1>Page</h1>"), body, F.lit("<a href='/next'>Next</a><img src='b.png'></body></html>"))


@query(
    "SELECT article_id, trim(regexp_replace(coalesce(title,''),'[\\t-\\r\\x{85}\\p{Z}]+',' ','g')) AS title, len(list_filter(string_split(coalesce(text_preview,''),chr(10)), lambda s: trim(regexp_replace(s,'[\\t-\\r\\x{85}\\p{Z}]+',' ','g'))<>''))::INT AS paragraphs, 1 AS links, 1 AS images, 'Page' AS headings FROM article_quality"
)
def parsed_pages(spark, d):
    rows = table(spark, d, "article_quality").select("article_id", H.parse_html(_page("title", "text_preview")).alias("p"))
    return rows.select("article_id", "p.title", "p.paragraphs", F.size("p.links").alias("links"), "p.images", F.array_join("p.headings", "|").alias("headings"))


@query("SELECT doc_id, coalesce(text,'') AS text, 'utf-8' AS encoding FROM documents")
def decoded_bytes(spark, d):
    rows = table(spark, d, "documents").select("doc_id", H.decode_bytes(F.encode(X.text_or_empty("text"), "UTF-8")).alias("x"))
    return rows.select("doc_id", "x.text", "x.encoding")
