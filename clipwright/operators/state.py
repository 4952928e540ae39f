"""Clip state as an append-only log and the views over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RESUMABLE = ("Pending", "Failed", "Writing", "Running")
#: Allowed changes of state; every first state is allowed.
STEPS = (("Pending", "Running"), ("Running", "Writing"), ("Writing", "Done"), ("Running", "Failed"), ("Writing", "Failed"), ("Failed", "Running"))


def latest(log: DataFrame, key: str = "clip_key") -> DataFrame:
    """The state of each clip: an update changes all but video_id, which stays as first written."""
    last = F.max_by(F.struct("status", "last_error", "retry_count", "updated_at"), "seq").alias("now")
    return log.groupBy(key).agg(F.min_by("video_id", "seq").alias("video_id"), last).select(key, "video_id", "now.*")


def resumable(state: DataFrame, statuses: tuple[str, ...] | None = None) -> DataFrame:
    """Clips to work on; no or empty statuses mean the default ones."""
    return state.where(F.col("status").isin(*(statuses or RESUMABLE)))


def insert_pending(state: DataFrame, incoming: DataFrame, key: str = "clip_key", order: str = "seq") -> DataFrame:
    """Rows to add: clips not in the state yet, of several for one clip the first."""
    new = incoming.join(state.select(key), key, "left_anti").groupBy(key).agg(F.min_by("video_id", order).alias("video_id"))
    return new.select(key, "video_id", F.lit("Pending").alias("status"), F.lit("").alias("last_error"), F.lit(0).alias("retry_count"))


def transitions(log: DataFrame, key: str = "clip_key") -> DataFrame:
    """How often each change of state occurs, and whether it is allowed."""
    before = F.coalesce(F.lag("status").over(Window.partitionBy(key).orderBy("seq")), F.lit(""))
    steps = log.select(before.alias("before"), F.col("status").alias("after")).groupBy("before", "after").agg(F.count(F.lit(1)).alias("n"))
    allowed = F.concat_ws(">", "before", "after").isin(*(f"{a}>{b}" for a, b in STEPS)) | (F.col("before") == "")
    return steps.withColumn("allowed", allowed)


def dead_letters(log: DataFrame, max_retries: int = 3) -> DataFrame:
    """Failures without another try left; a clip is listed once for each."""
    return log.where((F.col("status") == "Failed") & (F.col("retry_count") >= max_retries)).select("clip_key", "video_id", F.col("last_error").alias("error"), "updated_at")


def lookup(log: DataFrame, key: str, value) -> DataFrame:
    """The state of one clip; the log is filtered before anything is aggregated."""
    return latest(log.where(F.col(key) == value), key)
