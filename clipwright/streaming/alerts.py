"""The batch statistics over a stream of state events."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.operators.boxes import Tracker

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, name: str = "events.parquet", files: int = 1) -> DataFrame:
    """New files of a folder as they appear; the time is an instant, in UTC."""
    raw = spark.readStream.schema(EVENTS).option("pathGlobFilter", name).option("maxFilesPerTrigger", files).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def throughput(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by window and type; what comes later than `late` behind the newest is left out in append mode."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return counted.select(F.unix_timestamp("window.start").alias("start_s"), "event_type", "n", "failed")


def streaks(events: DataFrame, below: float) -> DataFrame:
    """user_id, streak, longest after each batch: runs of values below a bound, carried from batch to batch."""

    def carry(key: tuple, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        now, most = held.get if held.exists else (0, 0)
        for value in pd.concat(list(batches)).sort_values("event_id")["value"]:
            now = now + 1 if value < below else 0
            most = max(most, now)
        held.update((now, most))
        yield pd.DataFrame({"user_id": [key[0]], "streak": [now], "longest": [most]})

    rows = events.select("user_id", "event_id", "value")
    return rows.groupBy("user_id").applyInPandasWithState(carry, "user_id long, streak long, longest long", "streak long, longest long", "update", "NoTimeout")


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """What the stream gives for all that is there now, as a table in memory: for small results and tests."""
    name = f"drained_{uuid.uuid4().hex}"
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def tracks(boxes: DataFrame, threshold: float) -> DataFrame:
    """Object ids over a stream of boxes (clip_key, frame, ord, x1, y1, x2, y2): the rule of the batch tracker, its
    state (the last box of each object) carried from batch to batch. Within a batch boxes are taken in order."""

    def carry(key: tuple, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        tracker = Tracker(threshold, [tuple(b) for b in held.get[0]] if held.exists else [])
        rows = pd.concat(list(batches)).sort_values(["frame", "ord"])
        ids = [tracker.take(box) for box in rows[["x1", "y1", "x2", "y2"]].itertuples(index=False, name=None)]
        held.update(([list(b) for b in tracker.boxes],))
        yield pd.DataFrame({"clip_key": key[0], "frame": rows["frame"], "ord": rows["ord"], "object": ids})

    return boxes.groupBy("clip_key").applyInPandasWithState(carry, "clip_key long, frame long, ord int, object int", "last array<array<double>>", "append", "NoTimeout")
