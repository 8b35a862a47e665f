"""Structured Streaming over the batch operators: an extension of this engine.

The same functions run on arriving rows; state is bounded by watermarks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def arriving(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder; times without a zone are taken in the session's, as watermarks need."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return rows.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)})


def once_per_key(rows: DataFrame, key: str, time: str, lateness: str = "1 day") -> DataFrame:
    """The first row of each key; keys are forgotten when the watermark has passed them."""
    return rows.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(rows: DataFrame, time: str, by: str, value: str, window: str = "1 hour", slide: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """Counts and sums by tumbling or sliding windows and a key."""
    w = F.window(time, window, slide) if slide else F.window(time, window)
    return rows.withWatermark(time, lateness).groupBy(w, by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("window_start"), by, "n", "total")


def sessions(rows: DataFrame, time: str, by: str, gap: str = "30 minutes", lateness: str = "1 hour") -> DataFrame:
    """Sessions of a key: rows no further apart than ``gap``."""
    s = F.session_window(time, gap)
    return rows.withWatermark(time, lateness).groupBy(s, by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def running_budget(rows: DataFrame, key: str, id_column: str, cost: str, most: int, order: str) -> DataFrame:
    """Whether each arriving row still fits the budget of its key: the streaming twin of ``over_budget``.

    State is one number per key; rows of one trigger are taken in ``order``.
    """
    key_type = rows.schema[key].dataType.simpleString()
    id_type = rows.schema[id_column].dataType.simpleString()

    def step(keys: tuple[Any], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spent = state.get[0] if state.exists else 0
        part = pd.concat(list(batches)).sort_values([order, id_column], kind="stable")
        skipped = []
        for c in part[cost]:
            skipped.append(bool(spent >= most and c > 0))
            spent += int(c)
        state.update((spent,))
        yield pd.DataFrame({key: keys[0], id_column: part[id_column].to_numpy(), "skipped": skipped})

    return rows.groupBy(key).applyInPandasWithState(step, f"`{key}` {key_type}, `{id_column}` {id_type}, skipped boolean", "spent long", "append", GroupStateTimeout.NoTimeout)


def run_available(rows: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None] | None = None, table: str | None = None, mode: str = "append") -> None:
    """Process what has arrived and stop; a restart goes on from the checkpoint."""
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.foreachBatch(each_batch) if each_batch else writer.format("memory").queryName(table)).start()
    query.awaitTermination()
