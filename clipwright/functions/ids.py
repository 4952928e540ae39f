"""Stable identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_id(video_id: Column, frame_start: Column, frame_end: Column) -> Column:
    """video-start-end-hash: frames in nine digits, then eight hex digits of the hash of all three."""
    video, start, end = (c.cast("string") for c in (video_id, frame_start, frame_end))
    return F.concat_ws("-", video, F.lpad(start, 9, "0"), F.lpad(end, 9, "0"), F.substring(F.sha2(F.concat_ws(":", video, start, end), 256), 1, 8))
