"""Problem 7: documents into containers of a fixed number of tokens.

Method: swap-based local search. The items of a shard are first put down by best
fit; then, as long as something improves, items move from the emptiest container
into others, or are exchanged one for one or two for one, each step increasing the
sum of squared fills, until the emptiest containers are empty and dropped.

Scale: sizes are counted where the rows are, and only (key, size) is shuffled. Shards
are made by hash with a bounded expected number of items, so no task grows with the
corpus; each shard leaves at most about one container partly empty.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docaudit.llm.encoding import DEFAULT_VOCABULARY, count_tokens

CAPACITY = 2048
#: Expected items of a shard: about 2,000 containers of the sizes seen, packed in about a second.
SHARD_ITEMS = 10_000
#: Bounds of the search, none of which leaves an item out: pairs of containers looked at per container,
#: targets of one donor, items of a donor that are offered in pairs.
LOOKS, WIDEST, PAIRED = 60, 200, 40


def _best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Decreasing best fit; zero sizes go last, into any container."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # rooms that some container has, ascending
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            k = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(item)
        room -= size
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append(k)
    return bins


def _improve(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search: moves, one-for-one and two-for-one exchanges from emptier into fuller containers, until nothing improves or the allowed looks are used up."""
    size = sizes.tolist()
    fill = [sum(size[i] for i in b) for b in bins]
    looks = LOOKS * (len(bins) + 100)
    improved = True
    while improved and looks > 0:
        improved = False
        open_bins = sorted((k for k in range(len(bins)) if bins[k] and fill[k] < capacity), key=lambda k: (fill[k], k))
        for d, donor in enumerate(open_bins[:-1]):
            if looks <= 0 or not fill[donor]:
                continue
            for target in sorted(open_bins[d + 1 :], key=lambda k: -fill[k])[:WIDEST]:  # the fullest first: there a step adds most
                looks -= 1
                room = capacity - fill[target]
                if not room or fill[target] < fill[donor]:
                    continue
                gain, take, give = _step(bins[donor], bins[target], size, room)
                if gain:
                    bins[donor] = [i for i in bins[donor] if i not in take] + list(give)
                    bins[target] = [j for j in bins[target] if j not in give] + list(take)
                    fill[donor] -= gain
                    fill[target] += gain
                    improved = True
                    if not fill[donor]:
                        break
            if not fill[donor] and bins[donor]:  # only empty texts are left in it
                bins[open_bins[d + 1]].extend(bins[donor])
                bins[donor] = []
    return [b for b in bins if b]


def _step(mine: list[int], theirs: list[int], size: list[int], room: int) -> tuple[int, tuple, tuple]:
    """The move or exchange that fills most of the room: what it adds, what goes over, what comes back."""
    mine = sorted(mine, key=lambda i: -size[i])
    best, take, give = 0, (), ()
    for i in mine:
        if 0 < size[i] <= room:
            best, take = size[i], (i,)
            break
    if best < room:
        ordered = sorted((size[j], j) for j in theirs)
        keys = [s for s, _ in ordered]
        few = mine[:PAIRED]
        offers = [(size[i], (i,)) for i in mine] + [(size[a] + size[b], (a, b)) for n, a in enumerate(few) for b in few[n + 1 :]]
        for total, items in offers:  # back comes the smallest of theirs that leaves no more than the room
            at = bisect_left(keys, total - room)
            if at < len(keys) and best < total - keys[at] <= room:
                best, take, give = total - keys[at], items, (ordered[at][1],)
                if best == room:
                    break
    return best, take, give


def pack(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The container of each item; every size is at most ``capacity``."""
    where = np.zeros(len(sizes), np.int64)
    for k, items in enumerate(_improve(_best_fit(sizes, capacity), sizes, capacity)):
        where[items] = k
    return where


def pack_items(sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, counted: DataFrame | None = None) -> DataFrame:
    """Containers of items: ``key, piece_no int, start_token bigint, n_tokens bigint, container_id bigint``.

    ``sizes`` has a row per item. Null sizes count as 0; items of size 0 go into a container
    that exists. An item larger than ``capacity`` alone is split: full pieces have containers
    of their own, what is left is packed like an item. Repeated keys count like all other rows.
    ``counted`` may be another frame of as many rows that is cheaper to count.
    """
    n = F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0))
    cap = F.lit(capacity).cast("long")
    last = F.when((n % cap == 0) & (n > 0), (n - cap)).otherwise(n - n % cap)
    pieces = sizes.select(F.col(key).alias("key"), n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), last, cap)).alias("start_token")).select(
        "key", (F.col("start_token") / capacity + 1).cast("int").alias("piece_no"), "start_token", F.least(F.col("n") - F.col("start_token"), cap).alias("n_tokens")
    )
    items = (sizes if counted is None else counted).select(F.count("*").alias("items"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("items") / shard_items))
    sharded = pieces.crossJoin(F.broadcast(items)).select(  # a single row: the number of items
        "key", "piece_no", "start_token", "n_tokens", F.pmod(F.xxhash64("key"), shards).cast("long").alias("shard")
    )
    key_type = sizes.schema[key].dataType
    schema = T.StructType(
        [T.StructField("key", key_type), T.StructField("piece_no", T.IntegerType()), T.StructField("start_token", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("container_id", T.LongType())]
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "key", "piece_no"], ascending=[False, True, True], kind="stable")
        shard = int(rows["shard"].iloc[0])
        rows["container_id"] = shard * (1 << 32) + pack(rows["n_tokens"].to_numpy(np.int64), capacity)
        return rows[["key", "piece_no", "start_token", "n_tokens", "container_id"]]

    return sharded.groupBy("shard").applyInPandas(run, schema).withColumnRenamed("key", key)


def pack_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``pack_items`` over the token counts of texts; null and empty texts have size 0."""
    return pack_items(count_tokens(documents.select(key, text), text, "n_tokens", vocabulary), key, "n_tokens", capacity, shard_items, documents)


def p7_containers(spark, folder: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{folder}/documents.parquet"))
