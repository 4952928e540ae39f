"""Detections: formats, filters, suppression, tracking."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.functions.geometry import EPSILON, area, columns, iou, signed_area, suppression_iou

BOX = "struct<ord:int,x1:double,y1:double,x2:double,y2:double>"


def top_k(boxes: DataFrame, k: int, frame: str = "frame_key") -> DataFrame:
    """The k best scores of each frame, the later box first among equals; a missing phrase is empty."""
    w = Window.partitionBy(frame).orderBy(F.desc("score"), F.desc("ord"))
    return boxes.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).withColumn("phrase", F.coalesce("phrase", F.lit("")))


def large_enough(boxes: DataFrame, least: float) -> DataFrame:
    return boxes.where(area(columns()) >= least)


def normalized(boxes: DataFrame, width: int | Column, height: int | Column, frame: str = "frame_key") -> DataFrame:
    """Corner boxes in pixels, single precision. Frames where most boxes end left of their start hold centres and
    sizes; frames whose largest value is then at most 1.5 hold shares of the picture. What sticks out is cut off."""
    w = Window.partitionBy(frame)
    rows = boxes.withColumns({c: F.col(c).cast("float") for c in ("x1", "y1", "x2", "y2")})
    rows = rows.withColumn("__c", F.avg((F.col("x2") < F.col("x1")).cast("double")).over(w) > 0.5)
    half = F.lit(2.0).cast("float")
    low = lambda c, s: F.when(F.col("__c"), (F.col(c) - F.col(s) / half).cast("float")).otherwise(F.col(c))
    high = lambda c, s: F.when(F.col("__c"), (F.col(c) + F.col(s) / half).cast("float")).otherwise(F.col(s))
    rows = rows.select(*[c for c in rows.columns if c not in ("x1", "y1", "x2", "y2")], low("x1", "x2").alias("x1"), low("y1", "y2").alias("y1"), high("x1", "x2").alias("x2"), high("y1", "y2").alias("y2"))
    rows = rows.withColumn("__s", F.max(F.greatest("x1", "y1", "x2", "y2")).over(w) <= 1.5)

    def fit(c: str, size: int | Column) -> Column:
        size = size if isinstance(size, Column) else F.lit(size)
        scaled = F.when(F.col("__s"), (F.col(c) * size.cast("float")).cast("float")).otherwise(F.col(c))
        return F.least(F.greatest(scaled, F.lit(0.0).cast("float")), (size - 1).cast("float"))

    return rows.withColumns({"x1": fit("x1", width), "y1": fit("y1", height), "x2": fit("x2", width), "y2": fit("y2", height)}).drop("__c", "__s")


def suppressed(boxes: DataFrame, threshold: float, frame: str = "frame_key") -> DataFrame:
    """Greedy suppression per frame: by area, largest first (the later one of equals), a box stays if its overlap with
    every box kept is below the threshold. A fold over the frame's boxes, without Python or a self-join."""
    item = F.struct((-signed_area(columns())).alias("rank"), (-F.col("ord")).alias("tie"), "ord", "x1", "y1", "x2", "y2")
    gathered = boxes.groupBy(frame).agg(F.sort_array(F.collect_list(item)).alias("items"))

    def step(kept: Column, b: Column) -> Column:
        clear = ~F.exists(kept, lambda k: suppression_iou(k, b) >= threshold)
        return F.when(clear, F.concat(kept, F.array(F.struct(b["ord"], b["x1"], b["y1"], b["x2"], b["y2"]).cast(BOX)))).otherwise(kept)

    kept = F.aggregate("items", F.array().cast(f"array<{BOX}>"), step)
    return gathered.select(frame, F.inline(kept))


class Tracker:
    """The objects of one clip, each with its last box; an object's id is its place, from 1 on."""

    def __init__(self, threshold: float, boxes: list[tuple] | None = None):
        self.threshold, self.boxes = threshold, boxes or []

    def take(self, box: tuple[float, float, float, float]) -> int:
        """The id of the object whose last box overlaps most, at least threshold (the older among equals), or a new id."""
        x1, y1, x2, y2 = box
        size = max(0.0, x2 - x1) * max(0.0, y2 - y1)
        best, chosen = 0.0, -1
        for k, (a1, b1, a2, b2) in enumerate(self.boxes):
            both = max(0.0, min(a2, x2) - max(a1, x1)) * max(0.0, min(b2, y2) - max(b1, y1))
            overlap = both / (max(0.0, a2 - a1) * max(0.0, b2 - b1) + size - both + EPSILON)
            if overlap > best and overlap >= self.threshold:
                best, chosen = overlap, k
        if chosen < 0:
            self.boxes.append(box)
            return len(self.boxes)
        self.boxes[chosen] = box
        return chosen + 1


def tracked(boxes: DataFrame, threshold: float, clip: str = "clip_key", order: str = "frame") -> DataFrame:
    """Object ids per clip: boxes in order of frame and ord take the id of the object whose last box overlaps most, and
    become its last box, or begin a new id. Adds object; of the others clip, frame, ord and the box are kept.

    One pass over each clip's sorted boxes, with one box per object as state; tasks hold whole clips and no clip is
    gathered.
    """
    box = ["x1", "y1", "x2", "y2"]
    rows = boxes.select(clip, F.col(order).cast("long").alias("frame"), "ord", *[F.col(c).cast("double").alias(c) for c in box])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tracker = None, Tracker(threshold)
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), []
            for key, *corners in zip(keys, *(batch.column(c).to_pylist() for c in box)):
                if (key,) != now:
                    now, tracker = (key,), Tracker(threshold)
                ids.append(tracker.take(tuple(corners)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int32())], [*batch.schema.names, "object"])

    sorted_ = rows.repartition(F.col(clip)).sortWithinPartitions(clip, "frame", "ord")
    return sorted_.mapInArrow(run, rows.schema.add("object", "integer"))


def best_match(boxes: DataFrame, known: DataFrame, threshold: float, frame: str = "frame_key") -> DataFrame:
    """For each box the known object of its frame with the largest overlap, at least threshold; the lowest id of equals."""
    near = boxes.join(known.select(frame, F.col("ord").alias("object"), *[F.col(c).alias(f"k{c}") for c in ("x1", "y1", "x2", "y2")]), frame)
    near = near.withColumn("iou", iou(columns("k"), columns())).where((F.col("iou") >= threshold) & (F.col("iou") > 0))
    best = near.groupBy(frame, "ord").agg(F.max(F.struct("iou", (-F.col("object")).alias("old"))).alias("best"))
    return best.select(frame, "ord", (-F.col("best.old")).alias("object"), F.col("best.iou").alias("iou"))


def detections(frames: DataFrame, frame: str = "frame_key") -> DataFrame:
    """Rows of a detector's parallel lists, one per score: frame, ord (from 0), score, phrase (empty where missing), and
    if frames has boxes, x1 to y2 and the frame's height and width; a score without a box is left out."""
    boxed = "boxes" in frames.columns
    more = ["boxes", "height", "width"] if boxed else []
    rows = frames.select(frame, "phrases", *more, F.posexplode("scores").alias("ord", "score"))
    rows = rows.withColumn("phrase", F.coalesce(F.get("phrases", F.col("ord")), F.lit("")))
    if not boxed:
        return rows.select(frame, "ord", "score", "phrase")
    corner = F.get("boxes", F.col("ord"))
    corners = [F.get(corner, F.lit(k)).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))]
    return rows.where(corner.isNotNull()).select(frame, "ord", "score", "phrase", *corners, "height", "width")
