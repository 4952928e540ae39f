"""Counters, gauges and histograms of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Metrics:
    """Counts taken along with a query, at no extra pass: observe() a frame, run it, then read get()."""

    def __init__(self) -> None:
        self.taken: dict[str, Observation] = {}

    def observe(self, rows: DataFrame, stage: str, **values: Column) -> DataFrame:
        """rows, counted as they pass; values are more aggregates, by name."""
        seen = self.taken[stage] = Observation(stage)
        return rows.observe(seen, F.count(F.lit(1)).alias("clips_processed_total"), *[v.alias(k) for k, v in values.items()])

    def get(self, stage: str) -> dict:
        return self.taken[stage].get


def histogram(rows: DataFrame, value: str, bounds: list[float], *by: str) -> DataFrame:
    """Cumulative counts per upper bound (inclusive), the last one being all rows: by, bound, n."""
    ends = [*bounds, float("inf")]
    counts = [F.count_if(F.col(value) <= b).alias(f"__{k}") for k, b in enumerate(ends)]
    wide = rows.groupBy(*by).agg(*counts)
    cells = F.array(*[F.struct(F.lit(b).alias("bound"), F.col(f"__{k}").alias("n")) for k, b in enumerate(ends)])
    return wide.select(*by, F.inline(cells))


def queue_lengths(now: DataFrame, stages: tuple[str, ...] = ("Pending", "Running", "Writing")) -> DataFrame:
    """How many clips wait in each stage, 0 included: stage, queue_length. now: the latest state of each clip."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in stages]
    cells = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("queue_length")) for s in stages])
    return now.agg(*counts).select(F.inline(cells))


def totals(log: DataFrame) -> DataFrame:
    """The counters of a state log: clips_processed_total and clip_failures_total."""
    return log.agg(F.count_if(F.col("status") == "Done").alias("clips_processed_total"), F.count_if(F.col("status") == "Failed").alias("clip_failures_total"))


def gauge(samples: DataFrame, *by: str, value: str = "value", at: str = "at_s") -> DataFrame:
    """The last value of each series: by, value."""
    return samples.groupBy(*by).agg(F.max_by(value, at).alias(value))
