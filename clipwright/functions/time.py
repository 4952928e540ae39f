"""Seconds and frames. Rounding is half to even throughout."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def frames_from_seconds(seconds: Column, fps: Column) -> Column:
    return F.when(fps <= 0, F.lit(0)).otherwise(F.rint(seconds * fps).cast("int"))


def seconds_from_frames(frame: Column, fps: Column) -> Column:
    return F.when(fps <= 0, F.lit(0.0)).otherwise(frame.cast("double") / fps)


def aligned(start_s: Column, end_s: Column, frame_start: Column, frame_end: Column, fps: Column, tolerance: float = 1e-6) -> Column:
    near = lambda s, f: F.abs(s - seconds_from_frames(f, fps)) < tolerance
    return near(start_s, frame_start) & near(end_s, frame_end)


def stride_of(interval_s: Column, fps: Column) -> Column:
    """Frames between prompts; a missing or zero rate counts as 30."""
    rate = F.when(F.coalesce(fps, F.lit(0.0)) == 0, F.lit(30.0)).otherwise(fps)
    return F.greatest(F.lit(1), F.rint(interval_s * rate).cast("int"))
