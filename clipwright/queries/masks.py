"""Masks: thresholds, unions, run lengths; frames to look at."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwright import fixtures
from clipwright.fixtures import with_
from clipwright.functions.masks import rle_area, rle_text, run_lengths, swapped_channels
from clipwright.functions.time import stride_of
from clipwright.operators import masks as ops
from clipwright.queries.manifest import framed_clips

SIDE, ON = 8, 0.15


def mask_threshold(spark, sf_dir):
    return fixtures.logits(spark, sf_dir).select("clip", "object", F.size(F.filter("plane", lambda v: v > 0)).cast("long").alias("positive"))


def mask_union(spark, sf_dir):
    rows = fixtures.logits(spark, sf_dir).withColumn("group", F.col("object") % 100)
    return ops.union(rows, "group", SIDE, SIDE, ON).select("group", F.array_join(F.transform("bits", lambda b: b.cast("string")), "").alias("bits"))


def mask_rle(spark, sf_dir):
    return ops.runs(fixtures.logits(spark, sf_dir), "object", SIDE, SIDE, ON).select("object", "run", "bit", "length")


def _counts(spark, sf_dir):
    rows = fixtures.logits(spark, sf_dir)
    return rows.select("clip", "object", run_lengths(ops.bits_by_column(F.col("plane"), SIDE, SIDE, ops.level(rows, ON))).alias("counts"))


def mask_rle_json(spark, sf_dir):
    return _counts(spark, sf_dir).select("object", rle_text(F.col("counts"), SIDE, SIDE).alias("mask_rle"))


def mask_area(spark, sf_dir):
    return _counts(spark, sf_dir).select("object", rle_area(F.col("counts")).cast("long").alias("area"))


def prompt_frames(spark, sf_dir):
    return ops.prompt_frames(fixtures.videos(spark, sf_dir), 2.0, 60)


def frame_scan(spark, sf_dir):
    rows = ops.frames_between(framed_clips(spark, sf_dir), stride_of(F.lit(2.0), F.col("fps")))
    return rows.select("video_id", "line", "frame", "offset", "at_s")


def absolute_frames(spark, sf_dir):
    rows = ops.absolute(ops.frames_between(framed_clips(spark, sf_dir), stride_of(F.lit(4.0), F.col("fps"))))
    return rows.select("video_id", "line", "offset", "frame_index", "timestamp_s")


def found_masks(spark, sf_dir):
    """Frames with a mask: those without one are left out, though counted."""
    rows = fixtures.logits(spark, sf_dir).withColumn("mask", F.when(F.col("object") % 7 == 0, F.lit(None)).otherwise(F.col("plane")))
    return ops.found(rows, "clip", mask="mask")


def channel_swap(spark, sf_dir):
    """Two pixels of three channels for every box."""
    rows = fixtures.boxes(spark, sf_dir).select("frame_key", "ord", F.array("x1", "y1", "x2", "y2", "score", "x1").alias("pixels"))
    return rows.select("frame_key", "ord", F.array_join(F.transform(swapped_channels(F.col("pixels")), lambda v: F.round(v * 100).cast("long").cast("string")), " ").alias("pixels"))


QUERIES = {f.__name__: f for f in (channel_swap, mask_threshold, mask_union, mask_rle, mask_rle_json, mask_area, prompt_frames, frame_scan, absolute_frames, found_masks)}

_RUNS = """pixels AS (
  SELECT object, ((p - 1) % 8) * 8 + (p - 1) // 8 AS pos, (plane[p] > 0.15)::INT AS bit FROM logits, range(1, 65) t(p)
), cut AS (SELECT *, (bit <> lag(bit, 1, 0) OVER (PARTITION BY object ORDER BY pos))::INT AS c FROM pixels
), numbered AS (SELECT *, sum(c) OVER (PARTITION BY object ORDER BY pos ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM cut
), runs AS (SELECT object, run, max(bit) AS bit, count(*) AS length FROM numbered GROUP BY object, run)"""
_SPAN = """framed AS (
  SELECT c.video_id, line, start_s, fps, round_even(start_s * fps, 0)::INT AS fs, round_even(end_s * fps, 0)::INT AS fe FROM clips c JOIN videos USING (video_id))"""

SQL = {
    "channel_swap": f"{with_('boxes')} SELECT frame_key, ord, array_to_string(list_transform([x2, y1, x1, x1, score, y2], lambda v: round(v * 100)::BIGINT::VARCHAR), ' ') AS pixels FROM boxes",
    "mask_threshold": f"{with_('logits')} SELECT clip, object, len(list_filter(plane, lambda v: v > 0)) AS positive FROM logits",
    "mask_union": f"""{with_('logits')}, pixels AS (SELECT object % 100 AS grp, p, bool_or(plane[p] > 0.15) AS bit FROM logits, range(1, 65) t(p) GROUP BY grp, p)
SELECT grp AS "group", string_agg(bit::INT::VARCHAR, '' ORDER BY p) AS bits FROM pixels GROUP BY grp""",
    "mask_rle": f"{with_('logits')}, {_RUNS} SELECT object, run, bit, length FROM runs",
    "mask_rle_json": f"""{with_('logits')}, {_RUNS}, texts AS (SELECT object, string_agg(length::VARCHAR, ', ' ORDER BY run) AS counts, min(run) AS first FROM runs GROUP BY object)
SELECT object, '{{"size": [8, 8], "counts": [' || CASE WHEN first = 1 THEN '0, ' ELSE '' END || counts || ']}}' AS mask_rle FROM texts""",
    "mask_area": f"{with_('logits')} SELECT object, len(list_filter(plane, lambda v: v > 0.15)) AS area FROM logits",
    "prompt_frames": f"""{with_('videos')}, strides AS (SELECT video_id, fps, greatest(1, round_even(2.0 * fps, 0)::INT) AS stride, round_even(duration_s * fps, 0)::INT AS last FROM videos)
SELECT video_id, k::INT AS nth, (k * stride)::INT AS frame, (k * stride)::DOUBLE / fps AS at_s FROM strides, range(0, 60) t(k) WHERE k * stride <= last""",
    "frame_scan": f"""{with_('videos', 'clips')}, {_SPAN}, strides AS (SELECT *, greatest(1, round_even(2.0 * fps, 0)::INT) AS stride FROM framed)
SELECT video_id, line, (fs + k * stride)::INT AS frame, (k * stride)::INT AS "offset", (fs + k * stride)::DOUBLE / fps AS at_s FROM strides, range(0, 100) t(k) WHERE fs + k * stride <= fe""",
    "absolute_frames": f"""{with_('videos', 'clips')}, {_SPAN}, strides AS (SELECT *, greatest(1, round_even(4.0 * fps, 0)::INT) AS stride FROM framed)
SELECT video_id, line, (k * stride)::INT AS "offset", (k * stride + fs)::BIGINT AS frame_index, (k * stride + fs)::DOUBLE / fps AS timestamp_s FROM strides, range(0, 100) t(k) WHERE fs + k * stride <= fe""",
    "found_masks": f"{with_('logits')} SELECT clip, count(*) AS frames, count(*) FILTER (object % 7 <> 0) AS with_mask FROM logits GROUP BY clip",
}
