"""Sources, model adapters and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwright import fixtures
from clipwright.fixtures import with_
from clipwright.operators import manifest
from clipwright.operators.models import STUBS, Segmenter, Thresholds, camera_results, exploded
from clipwright.queries.manifest import _FRAMED, _ID, framed_clips
from clipwright.queries.masks import ON, SIDE, SQL as MASK_SQL
from clipwright.sources import frames
from clipwright.streaming import alerts


def predicted_masks(spark, sf_dir):
    """A stand-in predictor over all planes, in Spark's workers."""
    tasks = fixtures.logits(spark, sf_dir).select(F.col("object").cast("string").alias("clip_id"), "plane")
    return exploded(Segmenter(lambda: Thresholds(SIDE, ON)).run(tasks)).select(F.col("clip_id").cast("long").alias("object"), "mask_rle")


def frame_source(spark, sf_dir):
    frames.register(spark)
    return spark.read.format("frames").options(fps=30, start_s=1, end_s=500, stride=7, rows=500).load()


def stub_poses(spark, sf_dir):
    tasks = fixtures.logits(spark, sf_dir).select(F.col("object").cast("string").alias("clip_id"))
    return exploded(STUBS["hamer"].run(tasks)).select("clip_id", "frame_index", "timestamp_s")


def stub_cameras(spark, sf_dir):
    """Every clip's reconstruction, by a stand-in: no poses, no point cloud, and what was asked for."""
    tasks = manifest.tasks(framed_clips(spark, sf_dir)).dropDuplicates(["clip_id"])
    found = camera_results(STUBS["fast3r"].run(tasks), tasks)
    return found.select("clip_id", F.size("camera_poses").alias("poses"), "pointcloud_path", "video_path", (F.col("end_s") >= F.col("start_s")).alias("ordered"))


def streaming_throughput(spark, sf_dir):
    return alerts.drained(alerts.throughput(alerts.read_events(spark, sf_dir)), "complete")


QUERIES = {f.__name__: f for f in (predicted_masks, frame_source, stub_poses, stub_cameras, streaming_throughput)}

SQL = {
    "predicted_masks": MASK_SQL["mask_rle_json"],
    "frame_source": 'SELECT k - 30 AS "offset", k AS frame_index, k / 30.0::DOUBLE AS timestamp_s FROM range(30, 15001, 7) t(k)',
    "stub_poses": "SELECT ''::VARCHAR AS clip_id, 0::BIGINT AS frame_index, 0.0::DOUBLE AS timestamp_s WHERE false",
    "stub_cameras": f"{with_('videos', 'clips')}, {_FRAMED} SELECT DISTINCT {_ID} AS clip_id, 0 AS poses, '' AS pointcloud_path, path AS video_path, true AS ordered FROM framed",
    "streaming_throughput": """SELECT epoch(date_trunc('hour', ts))::BIGINT AS start_s, event_type, count(*) AS n, count(*) FILTER (event_type = 'error') AS failed
FROM events GROUP BY ALL""",
}
