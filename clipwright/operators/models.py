"""Model operators: adapters that run a model inside Spark's workers, and typed stand-ins for models not at hand."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright import schemas
from clipwright.functions.errors import ancestry

#: What a detector says of one prompt frame; boxes are four numbers each, in whatever form the model gives them.
DETECTED = "frame int, height int, width int, boxes array<array<double>>, scores array<double>, phrases array<string>"
#: A segmented frame, counted from the clip's start; null where nothing was found.
SEGMENTED = "offset long, mask_rle string"


class Predictor(Protocol):
    """A segmenter's model: for one task, items with offset (a frame, from the clip's start) and planes (mask planes of
    any number of objects, or None). A task has its columns, and prompts if a detector ran."""

    def frames(self, task: dict[str, Any]) -> Iterable[dict[str, Any]]: ...


class Finder(Protocol):
    """A detector's model: an item of DETECTED for each of the task's prompt_frames."""

    def detect(self, task: dict[str, Any]) -> Iterable[dict[str, Any]]: ...


def encode_mask(mask: np.ndarray) -> str:
    """Column-major run lengths of a mask of any shape (..., height, width); leading axes are united."""
    mask = np.asarray(mask) > 0
    while mask.ndim > 2:
        mask = mask.any(axis=0)
    return json.dumps({"size": list(mask.shape), "counts": run_lengths(mask)})


def run_lengths(mask: np.ndarray) -> list[int]:
    """Lengths of alternating runs, column by column, the first being of zeros (0 if the first bit is 1)."""
    flat = mask.ravel(order="F")
    edges = np.flatnonzero(np.diff(flat)) + 1
    counts = np.diff(np.concatenate(([0], edges, [flat.size]))).tolist() if flat.size else [0]
    return [0, *counts] if flat.size and flat[0] else counts


class Adapter:
    """Runs a method of a model over tasks, a row for each: clip_id, ok, kinds and message of a failure, rows.

    The model is loaded once per worker task, by the first task that needs it; failures, also to load, come back as
    rows and stop nothing.
    """

    def __init__(self, name: str, load: Callable[[], Any], method: str, schema: str):
        self.name, self.load, self.method, self.schema = name, load, method, schema

    def item(self, found: dict[str, Any]) -> dict[str, Any]:
        return found

    def run(self, tasks: DataFrame) -> DataFrame:
        load, method, item = self.load, self.method, self.item

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = None
            for batch in batches:
                out = []
                for task in batch.to_dict("records"):
                    try:
                        model = model or load()
                        out.append((task["clip_id"], True, [], "", [item(f) for f in getattr(model, method)(task)]))
                    except Exception as error:  # noqa: BLE001  a clip's failure is data
                        out.append((task["clip_id"], False, ancestry(error), str(error), []))
                yield pd.DataFrame(out, columns=["clip_id", "ok", "kinds", "message", "rows"])

        return tasks.mapInPandas(work, result(self.schema))


class Segmenter(Adapter):
    """A predictor's planes, united and run-length encoded in the worker: no plane ever leaves it."""

    def __init__(self, load: Callable[[], Predictor]):
        super().__init__("sam2", load, "frames", SEGMENTED)

    def item(self, found: dict[str, Any]) -> dict[str, Any]:
        planes = found["planes"]
        return {"offset": int(found["offset"]), "mask_rle": None if planes is None or not np.size(planes) else encode_mask(planes)}


class Detector(Adapter):
    def __init__(self, load: Callable[[], Finder]):
        super().__init__("groundingdino", load, "detect", DETECTED)


class Stub:
    """An operator whose model is absent: all tasks go well, without rows, of the right type."""

    def __init__(self, name: str, schema: str = schemas.POSES):
        self.name, self.schema = name, schema

    def run(self, tasks: DataFrame) -> DataFrame:
        return tasks.select("clip_id", F.lit(True).alias("ok"), F.array().cast("array<string>").alias("kinds"), F.lit("").alias("message"), F.array().cast(f"array<struct<{inner(self.schema)}>>").alias("rows"))


def inner(schema: str) -> str:
    """Columns as a struct's fields."""
    return ", ".join(": ".join(c.split(" ", 1)) for c in schema.split(", "))


def result(schema: str) -> str:
    return f"clip_id string, ok boolean, kinds array<string>, message string, rows array<struct<{inner(schema)}>>"


#: The artifact of each pose operator; retargeting is given the hand poses.
POSE_ARTIFACTS = {"hamer": "hand_pose", "foundationpose": "object_pose", "dex_retarget": "mapping", "fast3r": "fast3r_pose"}
STUBS = {name: Stub(name) for name in POSE_ARTIFACTS}


def camera_results(results: DataFrame, tasks: DataFrame) -> DataFrame:
    """What reconstruction says of each clip: camera_poses, the place of a point cloud (empty where none was made), and
    what it was asked for."""
    cloud = F.coalesce(F.col("pointcloud_path"), F.lit("")) if "pointcloud_path" in results.columns else F.lit("")
    asked = tasks.select("clip_id", "video_path", "start_s", "end_s")
    return results.where("ok").select("clip_id", F.col("rows").alias("camera_poses"), cloud.alias("pointcloud_path")).join(asked, "clip_id")


class Thresholds:
    """A predictor that needs no model: thresholds the planes a task carries, in the precision of their values."""

    def __init__(self, side: int, threshold: float):
        self.side, self.threshold = side, float(threshold)

    def frames(self, task):
        plane = np.asarray(task["plane"])
        plane = (plane.astype(np.float64) if plane.dtype == object else plane).reshape(self.side, self.side)
        return [{"offset": 0, "planes": plane > self.threshold}]


def exploded(results: DataFrame) -> DataFrame:
    """Results that went well, a row per item."""
    return results.where("ok").select("clip_id", F.inline("rows"))


def empty(spark: SparkSession, artifact: str) -> DataFrame:
    return spark.createDataFrame([], f"clip_id string, {schemas.ARTIFACTS[artifact]}")
