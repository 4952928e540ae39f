"""Quality statistics and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.plans.config import MetricsThresholds


def empty_rate(empty: Column) -> Column:
    """Share of empty masks; of no masks, 1."""
    return F.coalesce(F.avg(empty.cast("double")), F.lit(1.0))


def empty_rate_counted(empty: Column) -> Column:
    """Empty masks over masks; of no masks, 0."""
    return F.coalesce(F.sum(empty.cast("int")), F.lit(0)) / F.greatest(F.lit(1), F.count(empty))


def distribution(value: Column) -> list[Column]:
    """Least, most and mean; of no values, 0 each."""
    return [F.coalesce(f(value), F.lit(0.0)).alias(n) for f, n in ((F.min, "least"), (F.max, "most"), (F.avg, "mean"))]


def failure_alerts(log: DataFrame, bucket_s: int, most: float) -> DataFrame:
    """Per bucket of time: outcomes, failures, rate, and whether the rate is beyond `most`."""
    ended = log.where(F.col("status").isin("Done", "Failed")).withColumn("bucket", F.floor(F.col("updated_at") / bucket_s))
    rate = ended.groupBy("bucket").agg(F.count(F.lit(1)).alias("ended"), F.count_if(F.col("status") == "Failed").alias("failed"))
    return rate.withColumn("rate", F.col("failed") / F.col("ended")).withColumn("alert", F.col("rate") > most)


def longest_streaks(points: DataFrame, key: str, order: str, low: Column) -> DataFrame:
    """The longest unbroken run of `low` per key, 0 without any."""
    w = Window.partitionBy(key).orderBy(order)
    marked = points.withColumn("__low", low).withColumn("__run", F.sum((~F.col("__low")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "__run").agg(F.count_if("__low").alias("n")).groupBy(key).agg(F.max("n").alias("streak"))


def held_alerts(points: DataFrame, key: str, at_s: str, low: Column, held_s: int) -> DataFrame:
    """Points at which a condition has held for held_s: all of the key's points since then satisfy it, and it was
    observed that far back."""
    w = Window.partitionBy(key).orderBy(F.col(at_s).cast("long"))
    span = w.rangeBetween(-held_s, 0)
    marked = points.withColumn("__low", low)
    all_low = F.min(F.col("__low").cast("int")).over(span) == 1
    since = F.min(F.col(at_s).cast("long")).over(Window.partitionBy(key))
    return marked.withColumn("alert", all_low & (F.col(at_s).cast("long") - since >= held_s)).drop("__low")


def threshold_alerts(log: DataFrame, masks: DataFrame, gpu: DataFrame, limits: MetricsThresholds) -> DataFrame:
    """metric, value, alert for each threshold of the configuration: failures among the outcomes in log (status), empty
    masks among masks (empty), and the GPU's utilisation (device, at_s, used): the share of devices that stayed low for
    the whole window, of which any is one too many."""
    ended = log.where(F.col("status").isin("Done", "Failed")).agg(F.coalesce(F.avg((F.col("status") == "Failed").cast("double")), F.lit(0.0)).alias("value"))
    empty = masks.agg(empty_rate_counted(F.col("empty")).alias("value"))
    held = held_alerts(gpu, "device", "at_s", F.col("used") < limits.gpu_util_min, limits.gpu_util_window_s).groupBy("device").agg(F.max(F.col("alert").cast("double")).alias("low"))
    low = held.agg(F.coalesce(F.avg("low"), F.lit(0.0)).alias("value"))
    row = lambda name, rows, most: rows.select(F.lit(name).alias("metric"), "value", (F.col("value") > most).alias("alert"))
    return row("failure_rate", ended, limits.failure_rate_max).unionByName(row("empty_mask_rate", empty, limits.empty_mask_rate_max)).unionByName(row("gpu_utilization", low, 0.0))
