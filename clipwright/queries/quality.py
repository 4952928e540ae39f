"""Quality statistics and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwright import fixtures
from clipwright.fixtures import with_
from clipwright.operators import metrics, state
from clipwright.operators import quality as ops
from clipwright.operators.metrics import histogram
from clipwright.plans.config import MetricsThresholds
from clipwright.queries.masks import _counts
from clipwright.functions.masks import rle_area


def _points(spark, sf_dir):
    at = (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at_s")
    return fixtures.table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type", at)


def empty_mask_rate(spark, sf_dir):
    """Of every user, those without masks included, the share of masks that are empty."""
    rows = _points(spark, sf_dir).where("event_type = 'view'")
    users = _points(spark, sf_dir).select("user_id").distinct()
    met = users.join(rows.select("user_id", (F.col("value") < 10).alias("empty")), "user_id", "left")
    rate = met.groupBy("user_id").agg(F.round(ops.empty_rate(F.col("empty")), 9).alias("rate"))
    return rate


def empty_rate_total(spark, sf_dir):
    rows = _points(spark, sf_dir)
    return rows.agg(F.round(ops.empty_rate(F.col("value") < 10), 9).alias("rate"), F.round(ops.empty_rate_counted(F.col("value") < 10), 9).alias("counted"))


def empty_rates_of_nothing(spark, sf_dir):
    """Of no masks at all the two rates differ: 1 and 0."""
    rows = _points(spark, sf_dir).where("event_id < 0")
    return rows.agg(ops.empty_rate(F.col("value") < 10).alias("rate"), ops.empty_rate_counted(F.col("value") < 10).alias("counted"))


def distribution_stats(spark, sf_dir):
    return _points(spark, sf_dir).groupBy("event_type").agg(*ops.distribution(F.col("value"))).withColumn("mean", F.round("mean", 6))


def mask_area_distribution(spark, sf_dir):
    return _counts(spark, sf_dir).agg(*ops.distribution(rle_area(F.col("counts")).cast("double"))).withColumn("mean", F.round("mean", 6))


def failure_rate_alert(spark, sf_dir):
    return ops.failure_alerts(fixtures.state_events(spark, sf_dir), 86_400, 0.5).withColumn("rate", F.round("rate", 9))


def zero_streak(spark, sf_dir):
    return ops.longest_streaks(_points(spark, sf_dir), "user_id", "event_id", F.col("value") < 20)


def sliding_alert(spark, sf_dir):
    return ops.held_alerts(_points(spark, sf_dir), "user_id", "at_s", F.col("value") < 30, 36_000).where("alert").select("user_id", "event_id")


def throughput_buckets(spark, sf_dir):
    hour = F.floor(F.col("updated_at") / 3600).alias("hour")
    return fixtures.state_events(spark, sf_dir).groupBy(hour, "status").agg(F.count(F.lit(1)).alias("clips"))


def latency_histogram(spark, sf_dir):
    rows = histogram(_points(spark, sf_dir), "value", [5.0, 10.0, 20.0, 40.0], "event_type")
    return rows.select("event_type", F.when(F.col("bound") < 1e9, F.col("bound")).otherwise(F.lit(-1.0)).alias("bound"), "n")


def queue_length(spark, sf_dir):
    return metrics.queue_lengths(state.latest(fixtures.state_events(spark, sf_dir)))


def counters_total(spark, sf_dir):
    return metrics.totals(fixtures.state_events(spark, sf_dir))


def gpu_gauge(spark, sf_dir):
    """The last value seen of each user, as of a device."""
    return metrics.gauge(_points(spark, sf_dir).select("user_id", "event_id", "value"), "user_id", at="event_id")


def threshold_alerts(spark, sf_dir):
    """The configuration's thresholds, with users for devices."""
    points = _points(spark, sf_dir)
    gpu = points.select(F.col("user_id").alias("device"), "at_s", (F.col("value") / 100).alias("used"))
    found = ops.threshold_alerts(fixtures.state_events(spark, sf_dir), points.select((F.col("value") < 10).alias("empty")), gpu, MetricsThresholds())
    return found.withColumn("value", F.round("value", 9))


QUERIES = {f.__name__: f for f in (queue_length, counters_total, gpu_gauge, threshold_alerts, latency_histogram, empty_mask_rate, empty_rate_total, empty_rates_of_nothing, distribution_stats, mask_area_distribution, failure_rate_alert, zero_streak, sliding_alert, throughput_buckets)}

SQL = {
    "queue_length": f"""{with_('state_events')}, latest AS (SELECT clip_key, arg_max(status, seq) AS status FROM state_events GROUP BY clip_key)
SELECT stage, count(*) FILTER (status = stage) AS queue_length FROM latest, (VALUES ('Pending'), ('Running'), ('Writing')) t(stage) GROUP BY stage""",
    "counters_total": f"{with_('state_events')} SELECT count(*) FILTER (status = 'Done') AS clips_processed_total, count(*) FILTER (status = 'Failed') AS clip_failures_total FROM state_events",
    "gpu_gauge": "SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
    "threshold_alerts": f"""{with_('state_events')}, timed AS (SELECT user_id, value / 100 < 0.6 AS low, floor(epoch_us(ts) / 1e6)::BIGINT AS s FROM events
), held AS (
  SELECT user_id, min(low::INT) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) = 1 AND s - min(s) OVER (PARTITION BY user_id) >= 600 AS held FROM timed
), found(metric, value, most) AS (
  SELECT 'failure_rate', avg((status = 'Failed')::INT), 0.01 FROM state_events WHERE status IN ('Done', 'Failed')
  UNION ALL SELECT 'empty_mask_rate', avg((value < 10)::INT), 0.2 FROM events
  UNION ALL SELECT 'gpu_utilization', avg(low), 0.0 FROM (SELECT max(held::INT) AS low FROM held GROUP BY user_id)
)
SELECT metric, round(value, 9) AS value, value > most AS alert FROM found""",
    "latency_histogram": """SELECT event_type, b::DOUBLE AS bound, count(*) FILTER (b < 0 OR value <= b) AS n FROM events, (VALUES (5), (10), (20), (40), (-1)) t(b) GROUP BY event_type, b""",
    "empty_mask_rate": """SELECT user_id, round(coalesce(avg((value < 10)::INT) FILTER (event_type = 'view'), 1.0), 9) AS rate FROM events GROUP BY user_id""",
    "empty_rate_total": "SELECT round(coalesce(avg((value < 10)::INT), 1.0), 9) AS rate, round(sum((value < 10)::INT) / greatest(1, count(value)), 9) AS counted FROM events",
    "empty_rates_of_nothing": "SELECT 1.0::DOUBLE AS rate, 0.0::DOUBLE AS counted",
    "distribution_stats": "SELECT event_type, coalesce(min(value), 0.0) AS least, coalesce(max(value), 0.0) AS most, round(coalesce(avg(value), 0.0), 6) AS mean FROM events GROUP BY event_type",
    "mask_area_distribution": f"""{with_('logits')}, areas AS (SELECT len(list_filter(plane, lambda v: v > 0.15))::DOUBLE AS a FROM logits)
SELECT coalesce(min(a), 0.0) AS least, coalesce(max(a), 0.0) AS most, round(coalesce(avg(a), 0.0), 6) AS mean FROM areas""",
    "failure_rate_alert": f"""{with_('state_events')}, buckets AS (
  SELECT floor(updated_at / 86400)::BIGINT AS bucket, count(*) AS ended, count(*) FILTER (status = 'Failed') AS failed FROM state_events WHERE status IN ('Done', 'Failed') GROUP BY bucket)
SELECT bucket, ended, failed, round(failed / ended, 9) AS rate, failed / ended > 0.5 AS alert FROM buckets""",
    "zero_streak": """WITH marked AS (SELECT user_id, value < 20 AS low, sum((NOT value < 20)::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM events
), runs AS (SELECT user_id, count(*) FILTER (low) AS n FROM marked GROUP BY user_id, run)
SELECT user_id, max(n) AS streak FROM runs GROUP BY user_id""",
    "sliding_alert": """WITH timed AS (SELECT user_id, event_id, value, floor(epoch_us(ts) / 1e6)::BIGINT AS s FROM events
), marked AS (
  SELECT user_id, event_id, min((value < 30)::INT) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 36000 PRECEDING AND CURRENT ROW) AS low, s - min(s) OVER (PARTITION BY user_id) AS seen FROM timed)
SELECT user_id, event_id FROM marked WHERE low = 1 AND seen >= 36000""",
    "throughput_buckets": f"{with_('state_events')} SELECT floor(updated_at / 3600)::BIGINT AS hour, status, count(*) AS clips FROM state_events GROUP BY hour, status",
}
