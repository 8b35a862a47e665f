"""Scores as a long table (key, module, score): fusion, grades, gates, confidence, issues, feedback.

Weights, thresholds and labels are parameters; a profile changes data, never code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docaudit import dictionaries as D
from docaudit.functions import numbers as N
from docaudit.operators.rules import reasons, tiers


def long_modules(rows: DataFrame, key: str, modules: dict[str, Column]) -> DataFrame:
    """``key, module, score`` from a column per module."""
    parts = F.array(*(F.struct(F.lit(name).alias("module"), F.coalesce(score, F.lit(0.0)).alias("score")) for name, score in modules.items()))
    return rows.select(key, F.explode(parts).alias("m")).select(key, "m.module", "m.score")


def with_judgements(modules: DataFrame, judgements: DataFrame, key: str, rule_weights: dict[str, float], default_weight: float = 1.0) -> DataFrame:
    """Rule scores blended with those of an outside judge where it gave one: ``judgements (key, module, judged)``."""
    weight = F.lit(default_weight)
    for name, w in rule_weights.items():
        weight = F.when(F.col("module") == name, F.lit(w)).otherwise(weight)
    joined = modules.join(judgements.groupBy(key, "module").agg(F.max("judged").alias("judged")), [key, "module"], "left")
    return joined.select(key, "module", F.coalesce(weight * F.col("score") + (1 - weight) * F.col("judged"), F.col("score")).alias("score"))


def total_scores(modules: DataFrame, key: str, weights: dict[str, float], disabled: tuple[str, ...] = ()) -> DataFrame:
    """``key, overall, dimensions``: the sum of clamped scores times weights; a disabled module has weight 0 and the
    others are not raised for it. ``dimensions`` maps modules to clamped scores."""
    weight = F.lit(0.0)
    for name, w in weights.items():
        weight = F.when(F.col("module") == name, F.lit(0.0 if name in disabled else float(w))).otherwise(weight)
    score = N.clamp(F.coalesce(F.nanvl(F.col("score"), F.lit(0.0)), F.lit(0.0)))
    return modules.groupBy(key).agg(F.round(F.sum(score * weight), 2).alias("overall"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("module", F.round(score, 3).alias("score"))))).alias("dimensions"))


def grade(overall: Column, redline: Column | None = None, grades: tuple = D.GRADES, lowest: str = D.LOWEST_GRADE) -> Column:
    """The grade of a score; the lowest for anything with a redline."""
    by_score = tiers(overall, list(grades), lowest)
    return by_score if redline is None else F.when(F.coalesce(redline, F.lit(False)), F.lit(lowest)).otherwise(by_score)


def gate_failures(overall: Column, dimensions: Column, thresholds: dict[str, float | None], redline: Column | None = None) -> Column:
    """Codes of the gates that fail. ``thresholds`` names modules or ``overall``; None switches one off."""
    checks = []
    for name, least in thresholds.items():
        if least is not None:
            value = overall if name == "overall" else F.coalesce(F.try_element_at(dimensions, F.lit(name)), F.lit(0.0))
            checks.append((value < least, f"{name}_below_threshold"))
    if redline is not None:
        checks.append((F.coalesce(redline, F.lit(False)), "redline_issue_present"))
    return reasons(checks)


def confidence(penalties: list[tuple[Column, float, str]]) -> tuple[Column, Column]:
    """1 less the penalties that apply, at least 0, and their codes."""
    total = F.lit(1.0)
    for condition, amount, _ in penalties:
        total = total - F.when(condition, F.lit(amount)).otherwise(F.lit(0.0))
    return F.round(N.clamp(total), 3), reasons([(c, code) for c, _, code in penalties])


def severity_rank(severity: Column, ranks: dict[str, int] = D.SEVERITY_RANK) -> Column:
    out = F.lit(D.UNKNOWN_RANK)
    for name, rank in ranks.items():
        out = F.when(severity == name, F.lit(rank)).otherwise(out)
    return out


def ranked_issues(issues: DataFrame, key: list[str], severity: str, ordinal: str, most: int = 60) -> DataFrame:
    """The gravest issues of each key, in the order they were found within a severity."""
    w = Window.partitionBy(*key).orderBy(severity_rank(F.col(severity)), F.col(ordinal))
    return issues.withColumn("issue_no", F.row_number().over(w)).where(F.col("issue_no") <= most)


def strengths(modules: DataFrame, issues: DataFrame, key: str, least: float = 0.82, most: int = 4) -> DataFrame:
    """The best modules of each key that no issue is about, from the best down."""
    clean = modules.where(F.col("score") >= least).join(issues.select(key, "module").distinct(), [key, "module"], "left_anti")
    return clean.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "module"))).where(F.col("rank") <= most)


def lowest(rows: DataFrame, key: str, score: str, most: int = 10) -> DataFrame:
    """The rows with the lowest scores; a missing score and 0 come first, ties by key."""
    value = F.coalesce(F.nullif(F.col(score).cast("double"), F.lit(0.0)), F.lit(-1.0))
    return rows.select(key, F.col(score).alias(score)).orderBy(value, key).limit(most)
