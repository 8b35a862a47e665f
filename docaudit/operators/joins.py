"""Joins: lookups that keep one match, existence, differences, best matches, positions and places.

Equi-joins are left to Catalyst: it picks the strategy, and adaptive execution splits hot keys.
Where several rows share a key, one is picked by a stated order before the join, so that a hot
key never multiplies rows. No operator builds a cross product: theta joins have an equality first.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docaudit.functions import geometry as G


def pick_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the order. An aggregate, so each key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    rank = F.struct(*order)
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("__one")).select(*keys, *(F.col("__one")[c].alias(c) for c in rest))


def lookup(left: DataFrame, right: DataFrame, keys: list[str], order: list[Column], how: str = "left", prefix: str = "") -> DataFrame:
    """``left`` with the columns of its match in ``right``; of several matches the first in the order.

    Columns of ``right`` that ``left`` has too need a ``prefix`` to come along; without one they are left out.
    Null keys match nothing.
    """
    one = pick_one(right.where(_no_null(keys)), keys, order)
    taken = set(left.columns)
    columns = [F.col(c).alias(prefix + c) for c in one.columns if c not in keys and prefix + c not in taken]
    return left.join(one.select(*keys, *columns), keys, how)


def _no_null(keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def add_missing(rows: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` and those of ``more`` whose key is not among them; columns that one side lacks are null."""
    return rows.unionByName(more.join(rows.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def flag_present(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """``left`` with whether its key is in ``right``; rows are neither lost nor repeated."""
    seen = right.select(*keys).distinct().withColumn(flag, F.lit(True))
    return left.drop(flag).join(seen, keys, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def split_by(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is in ``right``, and the others."""
    seen = right.select(*keys).distinct()
    return left.join(seen, keys, "left_semi"), left.join(seen, keys, "left_anti")


def strict_lookup(ids: DataFrame, rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The rows named by ``ids`` in their order; a missing one raises when the result is read."""
    found = ids.join(rows.withColumn("__found", F.lit(True)), key, "left")
    checked = found.withColumn(key, F.when(F.col("__found"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no row for "), F.col(key).cast("string")))))
    return checked.drop("__found").orderBy(ordinal)


def best_match(left: DataFrame, right: DataFrame, keys: list[str], left_id: list[str], score: Column, tie: list[Column], threshold: float | None = None) -> DataFrame:
    """For each row of ``left`` the row of ``right`` with the highest score among those with the same key.

    ``left`` rows without a partner stay, with nulls. Column names must differ but for the keys. Ties
    go to the first by ``tie``. The maximum is an aggregate: pairs are combined before the shuffle.
    """
    right_columns = [c for c in right.columns if c not in keys]
    pairs = left.join(right, keys, "left").withColumn("__score", score)
    kept = [c for c in left.columns if c not in keys and c not in left_id]
    best = pairs.groupBy(*keys, *left_id).agg(
        *(F.first(c).alias(c) for c in kept),
        F.min_by(F.struct(F.col("__score").alias("match_score"), *right_columns), F.struct((-F.col("__score")).alias("a"), *(t.alias(f"t{i}") for i, t in enumerate(tie)))).alias("__best"),
    )
    out = best.select(*keys, *left_id, *kept, F.col("__best.match_score").alias("match_score"), *(F.col("__best")[c].alias(c) for c in right_columns))
    if threshold is not None:
        out = out.withColumn("matched", F.coalesce(F.col("match_score") >= threshold, F.lit(False)))
    return out


def positional(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str) -> DataFrame:
    """Item i of ``right`` with item min(i, n-1) of the n items of ``left``, for each key; positions count from 0."""
    last = left.groupBy(key).agg((F.max(left_at)).alias("__last"))
    at = right.join(last, key).withColumn(left_at, F.least(F.col(right_at), F.col("__last"))).drop("__last")
    return at.join(left, [key, left_at])


def group_issues(modules: DataFrame, issues: DataFrame, key: list[str], module: str = "module") -> DataFrame:
    """Each module's row with how many issues it has; modules without any have 0."""
    counts = issues.groupBy(*key, module).agg(F.count("*").alias("issues"))
    return modules.join(counts, [*key, module], "left").withColumn("issues", F.coalesce("issues", F.lit(0)))


def near_boxes(boxes: DataFrame, blocks: DataFrame, keys: list[str], id_column: str, box: str = "bbox", block_box: str = "block_box", text: str = "text", side: float = 80, above: float = 130, below: float = 170) -> DataFrame:
    """For each box the texts of the blocks of its page that lie near it, from the top down.

    Boxes and blocks of a page (``keys``) meet only where they share a horizontal band: equality on page
    and band comes first, and of the bands that both touch only the topmost yields the pair.
    """
    b, k = F.col(box), F.col(block_box)
    height = float(above + below)
    band = lambda y: F.floor(y / height)
    whole = lambda c: F.size(F.array_compact(c)) == 4
    top, bottom = G.side(b, 1) - above, G.side(b, 3) + below
    spread = lambda low, high: F.explode(F.sequence(band(low), F.greatest(band(low), band(high))))
    reach = boxes.where(whole(b)).select(*keys, id_column, box, spread(top, bottom).alias("__band"))
    placed = blocks.where(whole(k)).select(*keys, block_box, text, spread(G.side(k, 1), G.side(k, 3)).alias("__band"))
    joined = reach.join(placed, [*keys, "__band"]).where(F.col("__band") == band(F.greatest(top, G.side(k, 1))))
    across = F.least(G.side(b, 2), G.side(k, 2)) - F.greatest(G.side(b, 0), G.side(k, 0))
    near = joined.where((across > -side) & (G.side(k, 3) >= G.side(b, 1) - above) & (G.side(k, 1) <= G.side(b, 3) + below))
    listed = near.groupBy(*keys, id_column).agg(F.array_sort(F.collect_list(F.struct(G.side(k, 1).alias("y"), F.col(text).alias("t")))).alias("__near"))
    texts = listed.select(*keys, id_column, F.array_join(F.transform("__near", lambda x: x["t"]), " ").alias("nearby"), F.size("__near").alias("n_near"))
    return boxes.join(texts, [*keys, id_column], "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def suppress_overlaps(boxes: DataFrame, keys: list[str], id_column: str, score: str, box: str = "bbox", most_overlap: float = 0.6) -> DataFrame:
    """Boxes of each page, best first, without those that overlap one already kept by more than ``most_overlap``.

    Greedy and so dependent on order: one page at a time, in Arrow batches. Boxes that are null or
    whose page is not known are kept without being gathered. Ties go to the lesser id.
    """
    known = F.col(box).isNotNull()
    for c in keys:
        known = known & F.col(c).isNotNull()

    def run(page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values([score, id_column], ascending=[False, True], kind="stable")
        kept: list[tuple[float, float, float, float]] = []
        flags = []
        for b in page[box]:
            values = None if b is None or len(b) < 4 or any(v is None for v in b) else tuple(map(float, b[:4]))
            if values is None:
                flags.append(True)
                continue
            x0, y0, x1, y1 = values
            mine = max(0.0, x1 - x0) * max(0.0, y1 - y0)
            clash = False
            for a0, b0, a1, b1 in kept:
                shared = max(0.0, min(x1, a1) - max(x0, a0)) * max(0.0, min(y1, b1) - max(y0, b0))
                least = min(mine, max(0.0, a1 - a0) * max(0.0, b1 - b0))
                if least > 0 and shared / least > most_overlap:
                    clash = True
                    break
            flags.append(not clash)
            if not clash:
                kept.append(values)
        return page[flags]

    return boxes.where(known).groupBy(*keys).applyInPandas(run, boxes.schema).unionByName(boxes.where(~known))


def cluster_boxes(boxes: DataFrame, keys: list[str], id_column: str, box: str = "bbox", gap: float = 12.0) -> DataFrame:
    """Clusters of boxes of a page that are within ``gap`` of each other, directly or by others: ``keys, id, cluster_id, x0, y0, x1, y1``.

    A sweep from left to right with union-find, one page at a time; the cluster is named by its least id.
    Boxes that are null or whose page is not known belong to no cluster and have no row.
    """
    known = F.col(box).isNotNull()
    for c in keys:
        known = known & F.col(c).isNotNull()
    schema = ", ".join(f"`{k}` {boxes.schema[k].dataType.simpleString()}" for k in [*keys, id_column]) + f", cluster_id {boxes.schema[id_column].dataType.simpleString()}, x0 double, y0 double, x1 double, y1 double"

    def run(page: pd.DataFrame) -> pd.DataFrame:
        rows = [(i, *map(float, b[:4])) for i, b in zip(page[id_column], page[box], strict=True) if b is not None and len(b) >= 4 and not any(v is None for v in b)]
        rows.sort(key=lambda r: (r[1], r[0]))
        parent = list(range(len(rows)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        active: list[int] = []
        for i, (_, x0, y0, x1, y1) in enumerate(rows):
            active = [j for j in active if rows[j][3] + gap >= x0]
            for j in active:
                if rows[j][2] - gap <= y1 and y0 <= rows[j][4] + gap:
                    parent[root(i)] = root(j)
            active.append(i)
        members: dict[int, list[int]] = {}
        for i in range(len(rows)):
            members.setdefault(root(i), []).append(i)
        first = page[keys].iloc[0].tolist()
        out = []
        for group in members.values():
            name = min(rows[i][0] for i in group)
            sides = min(rows[i][1] for i in group), min(rows[i][2] for i in group), max(rows[i][3] for i in group), max(rows[i][4] for i in group)
            out.extend((*first, rows[i][0], name, *sides) for i in group)
        return pd.DataFrame(out, columns=[*keys, id_column, "cluster_id", "x0", "y0", "x1", "y1"])

    return boxes.where(known).groupBy(*keys).applyInPandas(run, schema)
