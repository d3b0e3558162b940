"""Windowed summaries of event streams; the same functions run on batch tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, directory: str, like: DataFrame, files_per_trigger: int = 1) -> DataFrame:
    """A stream over the Parquet files of a directory with the schema of a batch table."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(directory)


def tumbling(events: DataFrame, size: str = "1 day", late: str = "1 hour", time: str = "ts") -> DataFrame:
    """(window_start, event_type, events, total) per window; events later than ``late`` are left out of a stream."""
    rows = events.withWatermark(time, late).groupBy(F.window(time, size), "event_type")
    return rows.agg(F.count("*").alias("events"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "events", "total")


def sliding(events: DataFrame, size: str = "6 hours", step: str = "2 hours", late: str = "1 hour", time: str = "ts") -> DataFrame:
    rows = events.withWatermark(time, late).groupBy(F.window(time, size, step))
    return rows.agg(F.count("*").alias("events"), F.avg("value").alias("mean")).select(F.col("window.start").alias("window_start"), "events", "mean")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour", time: str = "ts") -> DataFrame:
    """(user_id, session_start, session_end, events): a session ends after ``gap`` without an event."""
    rows = events.withWatermark(time, late).groupBy("user_id", F.session_window(time, gap).alias("w"))
    return rows.agg(F.count("*").alias("events")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")


def once(events: DataFrame, keys: list[str], late: str = "1 hour", time: str = "ts") -> DataFrame:
    """Repeated deliveries within the watermark left out."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def write_batch(batch: DataFrame, batch_id: int, path: str, keys: list[str]) -> None:
    """Write a micro-batch, each key once, to its own part of the table at path (``batch=<id>``), in place of what the part holds.

    For foreachBatch: a batch that runs again after a failure replaces itself, and no other part is read or written.  Repeats
    of a key across batches are left out before, by ``once`` within the watermark, or when the table is read, by ``first_batches``.
    """
    rows = batch.dropDuplicates(keys).withColumn("batch", F.lit(batch_id).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def first_batches(table: DataFrame, keys: list[str]) -> DataFrame:
    """A table of batches with each key once, as its first batch has it."""
    columns = [c for c in table.columns if c not in (*keys, "batch")]
    first = table.groupBy(*keys).agg(F.min_by(F.struct(*columns), "batch").alias("f"))
    return first.select(*keys, *(F.col("f")[c].alias(c) for c in columns))


def running_novelty(signatures: DataFrame, key: str, text: str, window: int = 80) -> DataFrame:
    """A stream of (key, text) with novelty: 1 less the greatest similarity to the last ``window`` texts of the key."""
    from difflib import SequenceMatcher

    kind = signatures.schema[key].dataType.simpleString()

    def run(group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = list(state.get[0]) if state.exists else []
        for pdf in batches:
            out = []
            for value in pdf[text].fillna(""):
                out.append(1 - max((SequenceMatcher(None, value, x).ratio() for x in last), default=0.0))
                last = [*last, value][-window:]
            yield pd.DataFrame({key: group[0], text: pdf[text], "novelty": out})
        state.update((last,))

    return signatures.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, {text} string, novelty double", "last array<string>", "append", "NoTimeout")
