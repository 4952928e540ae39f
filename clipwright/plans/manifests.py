"""Building the two manifests from probed files and their cuts."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.functions.ids import clip_id
from clipwright.functions.time import aligned
from clipwright.operators import manifest
from clipwright.plans.config import SceneDetectConfig
from clipwright.sources import video


def probe_files(files: DataFrame) -> DataFrame:
    """path, probe: what ffprobe says of each file, run in the workers; a file it cannot read fails the build."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "probe": [json.dumps(video.probe(p)) for p in batch["path"]]})

    return files.select("path").mapInPandas(run, "path string, probe string")


def build(probes: DataFrame, cuts: DataFrame, split: str, scenes: SceneDetectConfig = SceneDetectConfig(), checksums: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(videos, clips) from probes (path, probe) and cuts (path, at_s).

    A video's id is 16 hex digits of the hash of its path. An invalid frame rate is an error. With a detection method
    other than `scenedetect` no scene is detected; videos without scenes are one clip each if `fallback_full_clip` allows, else
    none. Clips reach overlap_s over both ends, stay within the video and lie on frames.
    """
    read = manifest.probed(probes.select("path", "probe"))
    fps = F.when(F.col("valid"), F.col("fps")).otherwise(F.raise_error(F.concat(F.lit("invalid frame rate: "), F.col("path"))).cast("double"))
    videos = read.select(F.substring(F.sha2("path", 256), 1, 16).alias("video_id"), "path", "duration_s", fps.alias("fps"), "width", "height", "audio", F.lit(split).alias("split"))
    sums = videos.select("path", F.sha2("path", 256).alias("checksum")) if checksums is None else checksums
    videos = videos.join(sums, "path", "left").select("video_id", "path", "duration_s", "fps", "width", "height", "audio", "checksum", "split")
    keyed = cuts.select(F.substring(F.sha2("path", 256), 1, 16).alias("video_id"), F.col("at_s").cast("double"))
    if scenes.method != "scenedetect":
        keyed = keyed.limit(0)
    found = manifest.or_whole(videos, manifest.scenes_between(videos, keyed, scenes.min_scene_len_s), scenes.fallback_full_clip)
    on = manifest.expanded(manifest.with_videos(found, videos), scenes.overlap_s)
    clips = on.select(
        clip_id(F.col("video_id"), F.col("frame_start"), F.col("frame_end")).alias("clip_id"), "video_id", "start_s", "end_s", "frame_start", "frame_end",
        F.lit(scenes.overlap_s).alias("overlap_s"), "scenedetect_failed", F.lit("Pending").alias("status"), F.lit("").alias("last_error"), F.lit(0).alias("retry_count"),
    )
    return videos, clips


def unsound(videos: DataFrame, clips: DataFrame) -> DataFrame:
    """Clips that break a manifest's rules; none, in a sound one."""
    met = clips.join(videos.select("video_id", "fps", "duration_s"), "video_id", "left")
    fine = aligned(F.col("start_s"), F.col("end_s"), F.col("frame_start"), F.col("frame_end"), F.col("fps")) & (F.col("start_s") >= 0) & (F.col("start_s") <= F.col("end_s"))
    return met.where(~F.coalesce(fine, F.lit(False)))
