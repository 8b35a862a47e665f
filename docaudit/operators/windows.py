"""Ranking, neighbours, quotas, deduplication and samples.

Ranks over a hot partition are cut early where the feature allows it (Spark keeps only the first
rows of a group when the rank is filtered); what is sequential by nature runs over candidates
that were cut by rank before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docaudit.operators.joins import pick_one
from docaudit.session import shared_checkpoint


def ranked(df: DataFrame, by: list[str], order: list[Column], out: str = "rank", by_sort: bool = False) -> DataFrame:
    """``df`` with the place of each row in its group, from 1.

    A window takes each group in one task. With ``by_sort`` the rows are sorted as a whole, which
    splits a hot group over many tasks, and written to the shared folder; a row's place is its place
    in its part plus the sizes of the parts of its group before it. The same ranks, for groups that
    may hold a large share of all rows. ``order`` must leave no ties. Null keys are a group.
    """
    if not by_sort:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    rows = df.drop(out).orderBy(*by, *order).withColumn("__at", F.monotonically_increasing_id())
    rows = shared_checkpoint(rows)
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    keys = [F.col(b).alias(f"__k{i}") for i, b in enumerate(by)]
    parts = rows.groupBy(*keys, F.col("__part").alias("__p")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*(f"__k{i}" for i in range(len(by)))).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("__before", F.coalesce(before, F.lit(0)))  # a row per group and task
    same = F.col("__part") == F.col("__p")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__k{i}"))
    joined = rows.join(parts, same)
    return joined.withColumn(out, (F.col("__before") + F.col("__at") - F.col("__first") + 1).cast("int")).select(*df.drop(out).columns, out)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First-wins deduplication: one row per key. Null keys are a key like any other."""
    return pick_one(df, keys, order)


def last_per_key(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Last-wins deduplication by an ordinal column without ties."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordinal).alias("__one")).select(*keys, *(F.col("__one")[c].alias(c) for c in rest))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def top_with_overflow(df: DataFrame, by: list[str], order: list[Column], n: int, by_sort: bool = False) -> DataFrame:
    """All rows with their rank and whether they are within the first ``n``; the overflow stays for the audit."""
    return ranked(df, by, order, "rank", by_sort).withColumn("selected", F.col("rank") <= n)


def uniquify(df: DataFrame, column: str, order: list[Column], out: str = "unique_id", longest: int = 90, by_sort: bool = False) -> DataFrame:
    """Unique ids: the n-th row with an id gets the suffix _n, the id being cut to make room for it."""
    n = F.col("__rn")
    suffix = F.when(n > 1, F.concat(F.lit("_"), n.cast("string"))).otherwise(F.lit(""))
    return ranked(df, [column], order, "__rn", by_sort).withColumn(out, F.concat(F.substring(F.col(column), F.lit(1), F.lit(longest) - F.length(suffix)), suffix)).drop("__rn")


def cap_per_group(df: DataFrame, group: str, key: str, order: list[Column], most: int) -> DataFrame:
    """Rows with distinct keys, the first of each, and of those at most ``most`` per group in the same order."""
    once = pick_one(df, [key], order)
    return once.withColumn("__rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__rn") <= most).drop("__rn")


def diverse_top(df: DataFrame, by: list[str], group: str, order: list[Column], n: int) -> DataFrame:
    """The best row of each group value first, then the others by order: ``n`` rows for each ``by``, with their place.

    Of each group value no more than its first ``n`` rows can be chosen: each task's part is cut to them before the
    shuffle, and so are the candidates of each ``by``, so a hot one is in no task.
    """
    within = F.row_number().over(Window.partitionBy(*by, group).orderBy(*order))
    few = df.withColumn("__within", within).where(F.col("__within") <= n).withColumn("__later", (F.col("__within") > 1).cast("int"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("__later", *order))
    return few.withColumn("place", place).where(F.col("place") <= n).drop("__within", "__later")


def stratified(df: DataFrame, by: list[str], score: str, tie: str, most: int) -> DataFrame:
    """A third of ``most`` from the low end, the middle and the high end of each group by score.

    Groups within ``most`` come whole. What does not divide by three goes to the high end; the middle is
    taken at even steps over the group's size, starting right behind the low third.
    """
    low, high = most // 3, -(-most // 3)
    middle = most - low - high
    places = ranked(df, by, [F.col(score).asc_nulls_first(), F.col(tie)], "__rn", by_sort=True)  # strata are few, so large
    sizes = df.groupBy(*(F.col(b).alias(f"__s{i}") for i, b in enumerate(by))).agg(F.count("*").alias("__n"))
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__s{i}"))
    placed = places.join(sizes, same).drop(*(f"__s{i}" for i in range(len(by))))
    rn, n = F.col("__rn"), F.col("__n")
    step = F.greatest(F.lit(1), F.floor(n / F.lit(max(1, middle))).cast("int"))
    at = rn - low - 1
    in_middle = (rn > low) & (rn <= n - high) & (at % step == 0) & (F.floor(at / step) < middle)
    band = F.when(n <= most, "all").when(rn <= low, "low").when(rn > n - high, "high").when(in_middle, "middle")
    return placed.withColumn("band", band).where(F.col("band").isNotNull()).drop("__rn", "__n")


def neighbours(df: DataFrame, by: list[str], position: str, text: str, k: int = 1, out: str = "context", joiner: str = "\n\n") -> DataFrame:
    """Each row with the texts of the ``k`` rows before and after it, joined."""
    w = Window.partitionBy(*by).orderBy(position).rowsBetween(-k, k)
    return df.withColumn(out, F.array_join(F.collect_list(text).over(w), joiner))


def section_ends(df: DataFrame, by: list[str], start: str, text_length: Column, last: int = 3000) -> DataFrame:
    """Where each section ends: where the next starts; the last runs ``last`` characters or to the end of the text."""
    following = F.lead(start).over(Window.partitionBy(*by).orderBy(start))
    return df.withColumn("end", F.coalesce(following, F.least(F.col(start) + last, text_length)))


def running_numbers(df: DataFrame, by: list[str], number: str, start: str, least: int = 2) -> DataFrame:
    """Numbered headings 1, 2, 3, ... up to the first gap, the first place of each number; none if fewer than ``least``."""
    first = df.where(F.col(number).isNotNull()).groupBy(*by, number).agg(F.min(start).alias(start))
    w = Window.partitionBy(*by)
    run = first.withColumn("__rn", F.row_number().over(w.orderBy(number))).where(F.col("__rn") == F.col(number))
    return run.withColumn("__n", F.count("*").over(w)).where(F.col("__n") >= least).drop("__rn", "__n")


def numbered(df: DataFrame, by: list[str], order: list[Column], most: int, pattern: str = "fact_%03d", out: str = "item_id") -> DataFrame:
    """The first ``most`` rows of each group with running ids."""
    return top_per_group(df, by, order, most, "__rn").withColumn(out, F.format_string(pattern, "__rn")).drop("__rn")


def object_places(df: DataFrame, by: list[str], order: list[Column], by_sort: bool = False) -> DataFrame:
    """``place`` of each row on its page and ``on_page``, how many there are: counted by aggregate and joined."""
    counts = df.groupBy(*(F.col(b).alias(f"__g{i}") for i, b in enumerate(by))).agg(F.count("*").alias("on_page"))
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__g{i}"))
    return ranked(df, by, order, "place", by_sort).join(counts, same).select(*df.columns, "place", "on_page")


def distinct_centers(values: Column, gap: float) -> Column:
    """How many of the values stand at least ``gap`` behind the one before, the first counting; nulls do not."""
    s = F.array_sort(F.array_compact(values))
    steps = F.zip_with(F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0))), F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))), lambda b, a: (b - a >= gap).cast("int"))
    return F.when(F.size(s) == 0, 0).otherwise(1 + F.aggregate(steps, F.lit(0), lambda a, x: a + x))


def center_counts(df: DataFrame, by: list[str], value: Column, gap: float) -> DataFrame:
    """``by, centers``: as ``distinct_centers``, over the rows of each group.

    Within a cell of width ``gap`` no value is that far behind another, so only the least and the greatest of each cell count:
    they are aggregates, combined before the shuffle, and what is put in order per group are its cells.
    """
    cells = df.select(*by, value.alias("__v")).groupBy(*by, F.floor(F.col("__v") / gap).alias("__c")).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    before = F.lag("__high").over(Window.partitionBy(*by).orderBy(F.asc_nulls_last("__c")))
    new = F.col("__c").isNotNull() & (before.isNull() | (F.col("__low") - before >= gap))
    return cells.withColumn("__new", new).groupBy(*by).agg(F.count_if("__new").alias("centers"))


def running_before(df: DataFrame, by: list[str], order: list[Column], value: Column, out: str = "before", by_sort: bool = False) -> DataFrame:
    """``df`` with the sum of a value over the rows of its group that come before; 0 for the first.

    With ``by_sort`` as in ``ranked``: sums within the sorted parts, and those of the parts before.
    """
    frame = (Window.unboundedPreceding, -1)
    if not by_sort:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*frame)
        return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
    rows = df.drop(out).withColumn("__v", F.coalesce(value, F.lit(0))).orderBy(*by, *order).withColumn("__at", F.monotonically_increasing_id())
    rows = shared_checkpoint(rows).withColumn("__part", F.shiftright("__at", 33))
    names = [f"__k{i}" for i in range(len(by))]
    parts = rows.groupBy(*(F.col(b).alias(n) for b, n in zip(by, names, strict=True)), F.col("__part").alias("__p")).agg(F.sum("__v").alias("__sum"))
    parts = parts.withColumn("__base", F.coalesce(F.sum("__sum").over(Window.partitionBy(*names).orderBy("__p").rowsBetween(*frame)), F.lit(0)))
    same = F.col("__part") == F.col("__p")
    for b, n in zip(by, names, strict=True):
        same = same & F.col(b).eqNullSafe(F.col(n))
    local = F.coalesce(F.sum("__v").over(Window.partitionBy(*by, "__part").orderBy("__at").rowsBetween(*frame)), F.lit(0))
    return rows.withColumn("__local", local).join(parts, same).withColumn(out, F.col("__base") + F.col("__local")).select(*df.drop(out).columns, out)


def over_budget(df: DataFrame, by: list[str], order: list[Column], cost: Column, most: int, by_sort: bool = False) -> DataFrame:
    """Whether the costs of the rows before have used up the budget; rows that cost nothing pass for free."""
    rows = df.withColumn("__cost", cost)
    spent = running_before(rows, by, order, F.col("__cost"), "spent_before", by_sort)
    return spent.withColumn("skipped", F.coalesce((F.col("spent_before") >= most) & (F.col("__cost") > 0), F.lit(False))).drop("__cost")


def flag_repeats(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Whether the key of a row occurs more than once; null keys never do. Counted by aggregate and joined, so no hot key is gathered."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n").withColumn(flag, F.lit(True))
    return df.join(counts, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def quota_selection(df: DataFrame, order: list[tuple[str, bool]], quotas: dict[str, int], target: int, once: str | None = None, block: int = 1000) -> DataFrame:
    """Greedy choice in an order: a row is taken unless a quota of one of its values is full or its ``once`` key
    was taken; stops at ``target``. A null ``once`` key never clashes; a null quota value is a value. ``order`` must leave no ties.

    Each choice depends on those before. The first ``block`` rows in order are fetched (a top-n: each task sends no more) and
    chosen from; what they filled is excluded by a filter, and the next rows are fetched, until the target is met or
    nothing is left. The first row fetched can always be taken, so there are at most ``target`` fetches, mostly one or two.
    The jobs run when the operator is called; the result has ``target`` rows at most.
    """
    columns = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]
    used: dict[tuple[str, object], int] = {}
    seen: set[object] = set()
    taken: list[tuple] = []
    rest = df
    while len(taken) < target:
        rows = rest.orderBy(*columns).limit(block).collect()
        for row in rows:
            keys = [(q, row[q]) for q in quotas]
            key = row[once] if once else None
            if key in seen or any(used.get(k, 0) >= quotas[k[0]] for k in keys):
                continue
            taken.append(tuple(row))
            if key is not None:
                seen.add(key)
            for k in keys:
                used[k] = used.get(k, 0) + 1
            if len(taken) == target:
                break
        if len(rows) < block or len(taken) == target:
            break
        open_rows = F.lit(True)
        for q, n in quotas.items():
            full = [v for (name, v), count in used.items() if name == q and count >= n]
            open_rows = open_rows & ~(F.coalesce(F.col(q).isin([v for v in full if v is not None]), F.lit(False)) | (F.col(q).isNull() if None in full else F.lit(False)))
        if once:
            open_rows = open_rows & ~F.coalesce(F.col(once).isin(list(seen)), F.lit(False))
        last = rows[-1]
        behind = F.lit(False)
        for c, down in reversed(order):
            value = F.lit(last[c])
            after = (F.col(c) < value if down else F.col(c) > value) | F.col(c).isNull() if last[c] is not None else F.lit(False)
            behind = F.coalesce(after, F.lit(False)) | (F.col(c).eqNullSafe(value) & behind)
        rest = df.where(open_rows & behind)
    return df.sparkSession.createDataFrame(taken, df.schema)
