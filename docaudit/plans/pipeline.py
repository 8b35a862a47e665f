"""Composed plans: candidate reports from text to grade, and audits of extracted documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docaudit import dictionaries as D
from docaudit.functions import numbers as N
from docaudit.functions import text as X
from docaudit.operators import classify, scoring

#: Weights of the modules of a candidate report; they sum to 100 (fixed values).
WEIGHTS = {"structure": 20.0, "sources": 20.0, "numbers": 20.0, "scenario_risk": 25.0, "delivery": 15.0}
THRESHOLDS = {"overall": 55.0, "structure": 0.3, "delivery": 0.5}


def module_scores(reports: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and a score per module of each report, each in one pass over its text."""
    base = reports.select(F.col(key), F.col(text).alias("__text")).select(key, "__text", X.collapse_spaces(F.lower(X.text_or_empty("__text"))).alias("__normal"))
    n = F.col("__normal")
    length = F.length("__normal")
    digits = F.regexp_count(n, F.lit(r"[0-9]+(?:[.,][0-9]+)?\s?(?:%|percent|billion|million|个|亿|bps|basis)"))
    return base.select(
        key,
        X.group_coverage(n).alias("structure"),
        N.saturation(X.occurrences(n, D.SOURCE_TERMS), 3).alias("sources"),
        N.saturation(digits, 8).alias("numbers"),
        N.saturation(X.distinct_hits(n, D.RISK_TERMS + D.SCENARIO_TERMS), 3).alias("scenario_risk"),
        F.when(length >= 1800, 1.0).when(length >= 600, 0.7).when(length > 0, 0.4).otherwise(0.0).alias("delivery"),
    )


def scored_reports(reports: DataFrame, key: str, text: str, weights: dict[str, float] = WEIGHTS, thresholds: dict[str, float | None] = THRESHOLDS, disabled: tuple[str, ...] = ()) -> DataFrame:
    """``key, overall, grade, failures, passed`` of each report, without a shuffle: a report is one row throughout."""
    rows = module_scores(reports, key, text)
    parts = {m: F.col(m) for m in weights}
    overall = N.weighted_sum(parts, {m: 0.0 if m in disabled else w for m, w in weights.items()})
    dims = F.create_map(*(x for m in weights for x in (F.lit(m), F.round(F.col(m), 3))))
    out = rows.select(key, *weights, overall.alias("overall"), dims.alias("dimensions"))
    failures = scoring.gate_failures(F.col("overall"), F.col("dimensions"), thresholds)
    return out.select(key, *weights, "overall", scoring.grade(F.col("overall")).alias("grade"), failures.alias("failures")).withColumn("passed", F.size("failures") == 0)


def numeric_discipline(reports: DataFrame, key: str, text: str) -> DataFrame:
    """Share of sentences with telling numbers, and of those the share with context, for each report; 0 without any."""
    sentences = X.split_sentences(F.col(text))
    telling = F.filter(sentences, lambda s: classify.analytical_numeric(s))
    counted = reports.select(key, F.size(sentences).alias("n_sentences"), telling.alias("__t"))
    with_context = F.size(F.filter("__t", lambda s: classify.has_numeric_context(s)))
    share = lambda a, b: F.when(b > 0, F.round(a / b, 4)).otherwise(F.lit(0.0))
    return counted.select(key, "n_sentences", F.size("__t").alias("n_numeric"), share(F.size("__t"), F.col("n_sentences")).alias("numeric_share"), share(with_context, F.size("__t")).alias("context_share"))


def evaluate_cases(cases: DataFrame, reports: DataFrame, judgements: DataFrame | None, key: str, claim: str, text: str, weights: dict[str, float] | None = None) -> DataFrame:
    """Reports against what their cases expect: claim support by words and numbers, section coverage, delivery,
    blended with judgements where there are any: ``key, overall, grade``."""
    from docaudit.operators.evidence import claim_support

    support = claim_support(cases.withColumn("__f", F.monotonically_increasing_id()), reports, key, "__f", claim, text)
    facts = support.groupBy(key).agg(F.avg("score").alias("facts"))
    modules = module_scores(reports, key, text).join(facts, key, "left").withColumn("facts", F.coalesce("facts", F.lit(0.6)))
    weights = weights or {"facts": 40.0, "structure": 20.0, "sources": 15.0, "scenario_risk": 15.0, "delivery": 10.0}
    long = scoring.long_modules(modules, key, {m: F.col(m) for m in weights})
    if judgements is not None:
        long = scoring.with_judgements(long, judgements, key, {"facts": 0.72, "structure": 0.78}, 0.65)
    totals = scoring.total_scores(long, key, weights)
    return totals.select(key, "overall", scoring.grade(F.col("overall")).alias("grade"), "dimensions")
