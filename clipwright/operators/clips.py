"""The run of a clip, from prompt frames to masks: models at both ends, relational operators in between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.functions.geometry import signed_area
from clipwright.functions.time import frames_from_seconds, stride_of
from clipwright.operators import boxes
from clipwright.operators.masks import absolute
from clipwright.operators.models import SEGMENTED, Adapter, exploded, inner
from clipwright.operators.quality import empty_rate_counted
from clipwright.plans.config import PromptConfig

#: Fixed value: the overlap at which a box continues an object.
TRACK_IOU = 0.5
BOX = ("x1", "y1", "x2", "y2")


def whole_file() -> Column:
    """Whether a task means all of its file: neither bound is above zero."""
    return (F.col("start_s") <= 0) & (F.col("end_s") <= 0)


def with_prompt_frames(tasks: DataFrame, interval_s: float, most: int) -> DataFrame:
    """Adds prompt_frames: every interval's frame from the clip's start on, at most `most` and at least one; none where
    the clip has no frame."""
    rate = F.when(F.coalesce(F.col("fps"), F.lit(0.0)) == 0, F.lit(30.0)).otherwise(F.col("fps"))
    length = F.when(whole_file(), F.col("duration_s")).otherwise(F.col("end_s") - F.col("start_s"))
    last = frames_from_seconds(length, rate)
    frames = F.slice(F.sequence(F.lit(0), last, stride_of(F.lit(interval_s), F.col("fps"))), F.lit(1), F.lit(max(1, most)))
    return tasks.withColumn("prompt_frames", F.when(last >= 0, frames).otherwise(F.array().cast("array<int>")))


def prompts(detected: DataFrame, prompt: PromptConfig) -> DataFrame:
    """A detector's frames (clip_id, DETECTED) to clip_id, prompts: an array of frame, object, x1 to y2, in order.

    Per frame: corner boxes in pixels, the best scores, no small box, no box that overlaps a larger one too much. Then
    through the clip, larger boxes first in each frame, boxes that overlap an object's last one continue it.
    """
    frames = detected.withColumn("frame_key", F.struct("clip_id", "frame"))
    rows = boxes.detections(frames)
    rows = boxes.normalized(rows, F.col("width"), F.col("height"))
    rows = boxes.top_k(rows, prompt.max_boxes_per_frame).withColumn("ord", F.col("place"))
    kept = boxes.suppressed(boxes.large_enough(rows, prompt.min_box_area), prompt.nms_iou)
    size = Window.partitionBy("frame_key").orderBy(signed_area({c: F.col(c) for c in BOX}).desc(), F.desc("ord"))
    ordered = kept.select("frame_key.*", F.row_number().over(size).alias("ord"), *BOX)
    objects = boxes.tracked(ordered, TRACK_IOU, "clip_id")
    item = F.struct(F.col("frame").cast("int").alias("frame"), "ord", "object", *BOX)
    listed = objects.groupBy("clip_id").agg(F.sort_array(F.collect_list(item)).alias("items"))  # at most most_prompts x max_boxes
    return listed.select("clip_id", F.transform("items", lambda i: F.struct(i["frame"].alias("frame"), i["object"].alias("object"), *[i[c].alias(c) for c in BOX])).alias("prompts"))


def segmented(tasks: DataFrame, detector: Adapter | None, segmenter: Adapter, prompt: PromptConfig, keep) -> DataFrame:
    """Results of SEGMENTED rows, one per task: of the segmenter for tasks with prompts, empty ones for tasks without.

    Without a detector the segmenter finds its own prompts. If the prompts' source is not the detector's, there are
    none. A detector's failure is the task's. keep(rows) stores what inference gave, so that it runs once.
    """
    if detector is None:
        return segmenter.run(tasks)
    nothing = [F.lit(True).alias("ok"), F.array().cast("array<string>").alias("kinds"), F.lit("").alias("message"), F.array().cast(f"array<struct<{inner(SEGMENTED)}>>").alias("rows")]
    if prompt.source != detector.name:
        return tasks.select("clip_id", *nothing)
    found = keep(detector.run(with_prompt_frames(tasks, prompt.prompt_interval_s, prompt.max_prompts_per_clip)))
    given = keep(prompts(exploded(found), prompt))
    done = segmenter.run(tasks.join(given, "clip_id"))
    failed = found.where(~F.col("ok")).select("clip_id", "ok", "kinds", "message", F.array().cast(f"array<struct<{inner(SEGMENTED)}>>").alias("rows"))
    rest = tasks.join(given.select("clip_id"), "clip_id", "left_anti").join(failed.select("clip_id"), "clip_id", "left_anti")
    return done.unionByName(failed).unionByName(rest.select("clip_id", *nothing))


def mask_rows(results: DataFrame, tasks: DataFrame) -> DataFrame:
    """Frames with a mask: clip_id, frame_index (in the source video), timestamp_s, mask_rle."""
    frames = exploded(results).where("mask_rle is not null").join(tasks.select("clip_id", "start_s", "fps"), "clip_id")
    return absolute(frames).select("clip_id", "frame_index", "timestamp_s", "mask_rle")


def mask_quality(results: DataFrame) -> DataFrame:
    """clip_id, frames, empty_mask_rate: the share of segmented frames without a mask; 1 for a clip without any frame."""
    each = results.where("ok").select("clip_id", F.explode_outer("rows").alias("r"))
    empty = F.when(F.col("r").isNotNull(), F.col("r.mask_rle").isNull())
    rate = each.groupBy("clip_id").agg(F.count("r").alias("frames"), empty_rate_counted(empty).alias("rate"))
    return rate.select("clip_id", "frames", F.when(F.col("frames") == 0, F.lit(1.0)).otherwise(F.col("rate")).alias("empty_mask_rate"))
