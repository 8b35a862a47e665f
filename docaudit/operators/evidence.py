"""Evidence for claims: retrieval of chunks, agreement of numbers and sections, expected charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import numbers as N
from docaudit.functions import text as X
from docaudit.operators.windows import first_per_key

#: Weights of the parts of a retrieval score (fixed values).
RETRIEVAL_WEIGHTS = {"token_overlap": 0.50, "number_similarity": 0.35, "hint_overlap": 0.10, "date_similarity": 0.05}


def chunked(documents: DataFrame, key: str, text: str, size: int = 900, neighbours: int = 0, most: int | None = None) -> DataFrame:
    """``key, chunks``: for each document its chunks, or the first ``most``, with their text, tokens, numbers, quantities and dates.

    With ``neighbours`` each chunk is read together with as many before and after it. A document is one
    row, so nothing is shuffled, and tokens are taken once per chunk instead of once per pair.
    """
    chunks = X.chunk_paragraphs(F.col(text), size, most)
    spread = documents.select(key, chunks.alias("__c"))
    wide = F.transform("__c", lambda _, i: F.array_join(F.slice(F.col("__c"), F.greatest(F.lit(1), i + 1 - neighbours), F.lit(neighbours) + F.least(i, F.lit(neighbours)) + 1), "\n\n")) if neighbours else F.col("__c")
    spread = spread.select(key, wide.alias("__w"))
    quantities = lambda c: F.transform(N.parse_quantities(c), lambda q: F.struct(q["unit_class"].alias("unit_class"), q["value"].alias("value")))
    facts = lambda c: F.struct(c.alias("text"), X.token_set(X.collapse_spaces(F.lower(c))).alias("tokens"), N.extract_numbers(c).alias("numbers"), quantities(c).alias("quantities"), N.extract_dates(c).alias("dates"))
    return spread.select(key, F.transform("__w", facts).alias("chunks"))


def evidence_packs(facts: DataFrame, chunks: DataFrame, key: str, fact_id: str, claim: str, top_k: int = 5, hint: str | None = None, weights: dict[str, float] = RETRIEVAL_WEIGHTS) -> DataFrame:
    """For each fact the best chunks of its document: ``key, fact_id, rank, chunk_index, score, snippet``.

    The chunks of a document arrive as one array, so facts and chunks are never crossed by a
    shuffle: scores are computed within the row. Chunks with a positive score are ranked by it, ties by
    position; a fact that nothing supports has chunk 0 with score 0, one whose document has no chunks no row.
    """
    normal = X.collapse_spaces(F.lower(F.coalesce(F.col(claim), F.lit(""))))
    hinted = X.collapse_spaces(F.lower(F.coalesce(F.col(hint) if hint else F.lit(""), F.lit(""))))
    wanted = facts.select(
        key, fact_id, X.token_set(F.concat_ws(" ", normal, F.nullif(hinted, F.lit("")))).alias("__t"), X.token_set(hinted).alias("__h"),
        N.extract_numbers(F.col(claim)).alias("__n"), N.parse_quantities(F.col(claim)).alias("__q"), F.array_distinct(N.extract_dates(F.col(claim))).alias("__d"),
    )
    joined = wanted.join(chunks, key)

    def score(c: Column) -> Column:
        number = F.when(F.size("__n") > 0, N.number_similarity(F.col("__n"), c["numbers"], F.col("__q"), c["quantities"])).otherwise(F.lit(0.0))
        date = F.when(F.size("__d") > 0, N.date_share(F.col("__d"), c["dates"])).otherwise(F.lit(0.0))
        words = weights["token_overlap"] * X.overlap_ratio(F.col("__t"), c["tokens"]) + weights["hint_overlap"] * X.overlap_ratio(F.col("__h"), c["tokens"])
        return words + weights["number_similarity"] * number + weights["date_similarity"] * date

    scored = F.transform("chunks", lambda c, i: F.struct((-score(c)).alias("minus"), i.alias("at"), F.substring(c["text"], 1, 1200).alias("snippet")))
    ranked = F.slice(F.array_sort(F.filter(scored, lambda s: s["minus"] < 0)), 1, top_k)
    fallback = F.transform(F.slice("chunks", 1, 1), lambda c: F.struct(F.lit(0.0).alias("minus"), F.lit(0).alias("at"), F.substring(c["text"], 1, 1200).alias("snippet")))
    best = joined.select(key, fact_id, F.posexplode(F.when(F.size(ranked) > 0, ranked).otherwise(fallback)).alias("p", "s"))
    return best.select(key, fact_id, (F.col("p") + 1).alias("rank"), F.col("s.at").alias("chunk_index"), F.round(-F.col("s.minus"), 4).alias("score"), "s.snippet")


def claim_support(facts: DataFrame, documents: DataFrame, key: str, fact_id: str, claim: str, text: str) -> DataFrame:
    """``key, fact_id, overlap, preserved, score, supported``: how far a document bears out a claim by words and numbers."""
    tokens = lambda c: X.token_set(X.collapse_spaces(F.lower(F.coalesce(F.col(c), F.lit("")))))
    docs = documents.select(key, tokens(text).alias("__dt"), N.extract_numbers(F.col(text)).alias("__dn"))
    joined = facts.select(key, fact_id, tokens(claim).alias("__t"), N.extract_numbers(F.col(claim)).alias("__n")).join(docs, key)
    overlap = X.overlap_ratio(F.col("__t"), F.col("__dt"))
    preserved = N.preserved_share(F.col("__n"), F.col("__dn"))
    out = joined.select(key, fact_id, overlap.alias("overlap"), preserved.alias("preserved"))
    score = F.round(0.72 * N.clamp(F.col("overlap") / 0.55) + 0.28 * F.col("preserved"), 3)
    return out.withColumn("score", score).withColumn("supported", (F.col("overlap") >= 0.44) | ((F.col("overlap") >= 0.25) & (F.col("preserved") >= 0.6)))


def source_evidence(
    key: str, texts: DataFrame, links: DataFrame, sources: DataFrame, charts: DataFrame, authorities: list[str] = D.AUTHORITY_TERMS, longest: int | None = None, compared: int | None = None, shown: int | None = None
) -> DataFrame:
    """``key, kind, at, location, text, href, authority_terms, authority_hit``: what a report says of its sources, each once.

    ``texts`` has ``text``, ``links`` an array ``links`` of ``text, href``, both a row per key; ``sources`` a row per entry of
    the source pack with ``at, text, href``; ``charts`` a row per chart with ``at, chart_id, source_note, nearby_text``. Of
    equal kind, text and href the first by ``at`` is kept. All is taken whole; the reference cuts statements at 220
    characters (``longest``), compares 180 (``compared``) and shows 360 (``shown``), of 40 statements and 80 charts.
    """
    place = lambda name: F.concat(F.lit(name + "_"), F.when(F.col("at") < 1000, F.lpad(F.col("at").cast("string"), 3, "0")).otherwise(F.col("at").cast("string")))
    item = lambda kind, location, text, href: (F.lit(kind).alias("kind"), F.col("at").cast("long").alias("at"), location.alias("location"), text.alias("text"), F.coalesce(href, F.lit("")).alias("href"))
    none, given = F.lit(""), lambda c: F.nullif(F.col(c), F.lit(""))
    said = texts.select(key, F.posexplode(X.source_statements("text", longest)).alias("p", "s")).withColumn("at", F.col("p") + 1)
    linked = links.select(key, F.posexplode("links").alias("p", "l")).withColumn("at", F.col("p") + 1)
    chart = F.coalesce(given("chart_id"), F.lit("chart"))
    nearby = F.get(X.source_statements("nearby_text", longest), F.lit(0))
    parts = [
        said.select(key, *item("text_source_statement", place("text_match"), F.col("s"), none)),
        linked.select(key, *item("link", place("link"), F.coalesce(given("l.text"), F.col("l.href")), F.col("l.href"))),
        sources.select(key, *item("source_pack", place("source_pack"), F.col("text"), F.col("href"))),
        charts.select(key, *item("chart_source_note", chart, F.col("source_note"), none)),
        charts.select(key, *item("chart_nearby_source", chart, nearby, none)),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.withColumn("text", X.collapse_spaces("text")).where((F.col("text") != "") | (F.col("href") != ""))
    rows = rows.withColumn("__same", F.col("text") if compared is None else F.substring("text", 1, compared))
    once = first_per_key(rows, [key, "kind", "__same", "href"], [F.col("at"), F.col("location"), F.col("text")])
    once = once.withColumn("__normal", X.normalize_text(F.concat_ws(" ", "text", "href")))
    terms = X.term_hits(F.col("__normal"), authorities)
    out = once.select(key, "kind", "at", "location", (F.col("text") if shown is None else F.substring("text", 1, shown)).alias("text"), "href", terms.alias("authority_terms"))
    return out.withColumn("authority_hit", F.size("authority_terms") > 0)


def section_presence(text: Column, heading_text: Column, name: Column) -> Column:
    """Whether a section is there: fuzzily among the headings, or in the text."""
    n = X.collapse_spaces(F.lower(name))
    return X.contains_fuzzy(n, heading_text, 0.36) | X.contains_fuzzy(n, text, 0.5)


def numeric_matches(expected: DataFrame, observed: DataFrame, keys: list[str], expected_id: str, value_e: str, class_e: str, observed_id: str, value_o: str, class_o: str, threshold: float = 0.82) -> DataFrame:
    """For each expected quantity the observed one of the same keys that agrees best, and whether well enough.

    Ties go to the first observed. The best is an aggregate over pairs that are combined before the shuffle.
    """
    from docaudit.operators.joins import best_match

    score = N.match_score(F.col(value_e), F.col(class_e), F.col(value_o), F.col(class_o))
    out = best_match(expected, observed, keys, [expected_id], score, [F.col(observed_id)], threshold)
    return out.withColumn("match_score", F.round(F.coalesce("match_score", F.lit(0.0)), 3))
