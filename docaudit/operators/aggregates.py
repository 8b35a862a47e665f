"""Aggregates: layered summaries, histograms, statistics, worst-k blends, audits of whole sets.

Several groupings of one table are one pass over its rows, expanded into a key per grouping; counts
and sums are combined before the shuffle, so a hot group costs a row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docaudit.functions.numbers import half_up

UNKNOWN = "unknown"


def named(column: Column | str) -> Column:
    """A grouping value with null and blank as ``unknown``."""
    c = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(UNKNOWN))


def layered_summary(rows: DataFrame, fields: list[str], score: str, passed: str) -> DataFrame:
    """``field, value, n, avg_score, min_score, max_score, passed, pass_rate`` for each value of each field.

    One pass: every row is expanded into one key per field before the partial aggregate. Null
    values count as ``unknown``, null scores not at all, a null ``passed`` as false.
    """
    keys = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), named(f).alias("value")) for f in fields)))
    long = rows.select(keys.alias("k"), F.col(score).cast("double").alias("s"), F.coalesce(F.col(passed), F.lit(False)).cast("int").alias("p"))
    return long.groupBy("k.field", "k.value").agg(
        F.count("*").alias("n"),
        half_up(F.avg("s"), 2).alias("avg_score"),
        F.min("s").alias("min_score"),
        F.max("s").alias("max_score"),
        F.sum("p").alias("passed"),
        half_up(F.sum("p") / F.count("*"), 3).alias("pass_rate"),
    )


def distributions(rows: DataFrame, fields: list[str]) -> DataFrame:
    """``field, value, n, share`` of each value of each field, in one aggregate."""
    keys = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), named(f).alias("value")) for f in fields)))
    counts = rows.select(keys.alias("k")).groupBy("k.field", "k.value").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("field"))
    return counts.withColumn("share", half_up(100.0 * F.col("n") / total, 2))


def array_histogram(rows: DataFrame, arrays: list[str]) -> DataFrame:
    """``field, value, n`` of the entries of array columns; null arrays and entries do not count."""

    def labelled(name: str) -> Column:
        given = F.array_compact(F.coalesce(F.col(name), F.array().cast("array<string>")))
        return F.transform(given, lambda v: F.struct(F.lit(name).alias("field"), v.alias("value")))

    entries = F.flatten(F.array(*map(labelled, arrays)))
    return rows.select(F.explode(entries).alias("e")).groupBy("e.field", "e.value").agg(F.count("*").alias("n"))


def statistics(rows: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """``n, min, mean, median, max`` of a column, the median exact; nulls do not count, an empty column has null."""
    x = F.col(column).cast("double")
    return rows.groupBy(*(by or [])).agg(F.count(x).alias("n"), F.min(x).alias("min"), half_up(F.avg(x), 2).alias("mean"), half_up(F.median(x), 2).alias("median"), F.max(x).alias("max"))


def usage_by(rows: DataFrame, by: str, tokens: list[str], attempts: str | None = None, error: str | None = None) -> DataFrame:
    """Calls, sums and averages of token columns, repeated attempts and errors by a key."""
    aggregates = [F.count("*").alias("calls")]
    for t in tokens:
        aggregates += [half_up(F.sum(F.col(t).cast("double")), 2).alias(f"sum_{t}"), half_up(F.avg(F.col(t).cast("double")), 2).alias(f"avg_{t}")]
    if attempts:
        aggregates.append(F.sum(F.greatest(F.lit(0), F.coalesce(F.col(attempts), F.lit(0)) - 1)).alias("retries"))
    if error:
        aggregates.append(F.count_if(F.col(error).isNotNull() & (F.col(error).cast("string") != "")).alias("errors"))
    return rows.groupBy(named(by).alias(by)).agg(*aggregates)


def top_counts(rows: DataFrame, column: str, most: int = 20) -> DataFrame:
    """The most frequent values; ties go to the lesser value."""
    return rows.groupBy(named(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc("value")).limit(most)


def date_range(rows: DataFrame, column: str, by: list[str]) -> DataFrame:
    """First and last day by key, from the first ten characters."""
    day = F.substring(F.col(column).cast("string"), 1, 10)
    return rows.groupBy(*by).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(day).alias("n"))


def nan_mean(column: Column, default: float = 0.0) -> Column:
    """Mean without null and NaN; ``default`` for none."""
    return F.coalesce(F.avg(F.when(~F.isnan(column), column)), F.lit(default))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of value times weight over the sum of weights, of rows with both and a positive weight; the plain mean without any."""
    ok = value.isNotNull() & (weight > 0)
    return F.coalesce(F.sum(F.when(ok, value * weight)) / F.nullif(F.sum(F.when(ok, weight)), F.lit(0.0)), F.avg(value))


def worst_blend(rows: DataFrame, by: list[str], score: str, k: int = 3, mean_weight: float = 0.7) -> DataFrame:
    """``by, n, mean_score, worst_mean, blended``: the mean blended with the mean of the ``k`` lowest scores.

    The mean is a plain aggregate; for the lowest each task's part of a group is cut to ``k`` rows before the
    shuffle, so no group is gathered whole. Null scores do not count; null keys are a group.
    """
    x = F.col(score).cast("double")
    known = rows.where(x.isNotNull())
    means = known.groupBy(*by).agg(F.count("*").alias("n"), F.avg(x).alias("__m"))
    names = [f"__k{i}" for i in range(len(by))]
    low = known.select(*(F.col(b).alias(n) for b, n in zip(by, names, strict=True)), x.alias("__x")).withColumn("__rn", F.row_number().over(Window.partitionBy(*names).orderBy("__x"))).where(F.col("__rn") <= k)
    low = low.groupBy(*names).agg(F.avg("__x").alias("__w"))
    same = F.lit(True)
    for b, n in zip(by, names, strict=True):
        same = same & F.col(b).eqNullSafe(F.col(n))
    agg = means.join(low, same)
    return agg.select(*by, "n", half_up(F.col("__m"), 4).alias("mean_score"), half_up(F.col("__w"), 4).alias("worst_mean"), half_up(mean_weight * F.col("__m") + (1 - mean_weight) * F.col("__w"), 4).alias("blended"))


def checklist_scores(items: DataFrame, key: list[str], item: str, group: str, value: str, ordinal: str) -> DataFrame:
    """Mean score of each group of checklist items; of an item given twice the last counts, null (not applicable) does not."""
    last = items.groupBy(*key, group, item).agg(F.max_by(value, ordinal).alias("__v"))
    return last.groupBy(*key, group).agg(half_up(F.avg("__v"), 4).alias("score"), F.count("__v").alias("items"))


def box_union(rows: DataFrame, by: list[str], box: str) -> DataFrame:
    """The bounding box of all boxes of a group."""
    b = F.col(box)
    return rows.groupBy(*by).agg(F.count(b).alias("boxes"), F.min(F.get(b, 0)).alias("x0"), F.min(F.get(b, 1)).alias("y0"), F.max(F.get(b, 2)).alias("x1"), F.max(F.get(b, 3)).alias("y1"))


def distinct_with_samples(rows: DataFrame, by: list[str], column: str, most: int = 20) -> DataFrame:
    """Count of distinct values and the first ``most`` of them in order, joined by spaces.

    The values are counted by aggregate; for the samples each task's part of a group is cut to ``most`` values before
    the shuffle, so a hot group is in no task. Null values do not count; null keys are a group.
    """
    distinct = rows.where(F.col(column).isNotNull()).select(*by, column).distinct()
    names = [f"__k{i}" for i in range(len(by))]
    first = distinct.select(*(F.col(b).alias(n) for b, n in zip(by, names, strict=True)), column).withColumn("__rn", F.row_number().over(Window.partitionBy(*names).orderBy(column))).where(F.col("__rn") <= most)
    first = first.groupBy(*names).agg(F.array_join(F.array_sort(F.collect_list(column)), " ").alias("samples"))
    same = F.lit(True)
    for b, n in zip(by, names, strict=True):
        same = same & F.col(b).eqNullSafe(F.col(n))
    return distinct.groupBy(*by).agg(F.count("*").alias("n_distinct")).join(first, same).select(*by, "n_distinct", "samples")


def completion(rows: DataFrame, status: str, failed: list[Column], seconds: str | None = None) -> DataFrame:
    """One row: all, completed and failed rows; a row fails with a status other than ok or skipped, or by any of ``failed``."""
    bad = ~F.coalesce(F.col(status).isin("ok", "skipped"), F.lit(False))
    for f in failed:
        bad = bad | F.coalesce(f, F.lit(False))
    out = [F.count("*").alias("total"), F.count_if(~bad).alias("completed"), F.count_if(bad).alias("failures")]
    if seconds:
        out += [half_up(F.sum(seconds), 2).alias("total_seconds"), F.max(seconds).alias("max_seconds")]
    return rows.agg(*out)


def requirement_errors(rows: DataFrame, minimum: dict[str, tuple[Column, int]], maximum: dict[str, tuple[Column, int]], most_of: tuple[str, int] | None = None, distinct: tuple[str, int] | None = None) -> DataFrame:
    """``error``: one row for each requirement of the whole set that fails: least and most rows that fulfil a
    condition, most rows of one value of a column, least number of distinct values."""
    tests = [F.when(F.count_if(c) < n, F.lit(f"{name}_below_{n}")) for name, (c, n) in minimum.items()]
    tests += [F.when(F.count_if(c) > n, F.lit(f"{name}_above_{n}")) for name, (c, n) in maximum.items()]
    if distinct:
        tests.append(F.when(F.count_distinct(named(distinct[0])) < distinct[1], F.lit(f"distinct_{distinct[0]}_below_{distinct[1]}")))
    out = rows.agg(F.array_compact(F.array(*tests)).alias("e")).select(F.explode("e").alias("error"))
    if most_of:
        largest = rows.groupBy(named(most_of[0]).alias("v")).agg(F.count("*").alias("n")).agg(F.max("n").alias("n"))
        out = out.unionByName(largest.where(F.col("n") > most_of[1]).select(F.lit(f"{most_of[0]}_above_{most_of[1]}").alias("error")))
    return out
