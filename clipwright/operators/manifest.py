"""Manifests: scenes to clips, clips joined to their videos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.functions.ids import clip_id
from clipwright.functions.time import aligned, frames_from_seconds, seconds_from_frames
from clipwright.scratch import materialize


def last_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of the rows with one key, the last. An aggregate: each task sends one row per key, however many it has."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__last")).select(key, "__last.*").select(*rows.columns)


def in_order(rows: DataFrame) -> DataFrame:
    """Adds __at, which orders rows as they stand: by the files they were read from, by name, and their place in them
    (see sources.manifests), or else as the table gives them."""
    at = "ordinal" if "ordinal" in rows.columns else F.struct(F.monotonically_increasing_id())
    return rows.withColumn("__at", F.col(at) if isinstance(at, str) else at).drop("ordinal")


def identified(clips: DataFrame) -> DataFrame:
    """clips; one without clip_id or video_id is an error."""
    bare = F.col("clip_id").isNull() | F.col("video_id").isNull()
    return clips.withColumn("clip_id", F.when(bare, F.raise_error(F.lit("clip without clip_id or video_id")).cast(clips.schema["clip_id"].dataType)).otherwise(F.col("clip_id")))


def with_videos(clips: DataFrame, videos: DataFrame) -> DataFrame:
    """clips with their video's path, fps and duration; a clip without a video, or a video without a path, is an error.

    The join is a left one and the check an expression on its result: no second pass. Videos may be too many to
    broadcast, so the strategy is left to the planner's statistics.
    """
    known = videos.select("video_id", "path", "fps", "duration_s", F.lit(True).alias("__known"))
    met = clips.join(known, "video_id", "left")
    lost = F.when(F.col("__known").isNull(), F.raise_error(F.concat(F.lit("clip refers to a missing video_id: "), F.col("video_id").cast("string"))))
    bare = lost.when(F.coalesce(F.col("path"), F.lit("")) == "", F.raise_error(F.concat(F.lit("video has an empty path: "), F.col("video_id").cast("string"))))
    return met.withColumn("path", bare.otherwise(F.col("path")).cast("string")).drop("__known")


def framed(clips: DataFrame) -> DataFrame:
    """Adds frame_start and frame_end, the seconds they stand for, and whether the clip's own seconds agree."""
    start, end = frames_from_seconds(F.col("start_s"), F.col("fps")), frames_from_seconds(F.col("end_s"), F.col("fps"))
    out = clips.withColumns({"frame_start": start, "frame_end": end})
    out = out.withColumns({"start_aligned_s": seconds_from_frames(F.col("frame_start"), F.col("fps")), "end_aligned_s": seconds_from_frames(F.col("frame_end"), F.col("fps"))})
    return out.withColumn("aligned", aligned(F.col("start_s"), F.col("end_s"), F.col("frame_start"), F.col("frame_end"), F.col("fps")))


def expanded(clips: DataFrame, overlap_s: float) -> DataFrame:
    """Both ends moved out by overlap_s, kept within the video, and put on frames."""
    moved = clips.withColumns({"start_s": F.greatest(F.lit(0.0), F.col("start_s") - overlap_s), "end_s": F.least(F.col("duration_s"), F.col("end_s") + overlap_s)})
    on = framed(moved)
    return on.withColumns({"start_s": F.col("start_aligned_s"), "end_s": F.col("end_aligned_s")})


def within(clips: DataFrame, start_s: float, end_s: float) -> DataFrame:
    """Of each clip the frames from start_s to end_s of its video, as from_frame and to_frame; clips without any go. All
    frames if neither bound is above zero."""
    if start_s <= 0 and end_s <= 0:
        return clips.withColumns({"from_frame": F.col("frame_start"), "to_frame": F.col("frame_end")})
    low, high = (frames_from_seconds(F.lit(max(0.0, s)), F.col("fps")) for s in (start_s, end_s))
    met = clips.where((F.col("frame_start") <= high) & (F.col("frame_end") >= low))
    return met.withColumns({"from_frame": F.greatest("frame_start", low), "to_frame": F.least("frame_end", high)})


def tasks(clips: DataFrame) -> DataFrame:
    """The typed work item of a clip."""
    flag = lambda name, default: F.coalesce(F.col(name), F.lit(default)) if name in clips.columns else F.lit(default)
    return clips.select(
        clip_id(F.col("video_id"), F.col("frame_start"), F.col("frame_end")).alias("clip_id"), "video_id", F.col("path").alias("video_path"),
        F.col("start_s").cast("double"), F.col("end_s").cast("double"), F.col("frame_start").cast("int"), F.col("frame_end").cast("int"),
        flag("scenedetect_failed", False).alias("scenedetect_failed"), flag("retry_count", 0).alias("retry_count"),
    )


def scenes_by_gap(points: DataFrame, key: str, at: str, gap_s: float) -> DataFrame:
    """Runs of points with gaps of at most gap_s: key, scene, start_s, end_s, points."""
    w = Window.partitionBy(key).orderBy(at)
    cut = F.coalesce((F.col(at) - F.lag(at).over(w) > gap_s).cast("int"), F.lit(0))
    run = points.withColumn("__cut", cut).withColumn("scene", F.sum("__cut").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(key, "scene").agg(F.min(at).alias("start_s"), F.max(at).alias("end_s"), F.count(F.lit(1)).alias("points"))


def spaced(cuts: Column, least_s: float) -> Column:
    """Of ascending cuts, those at least least_s after the last one taken."""
    take = lambda a, c: F.when((F.size(a) == 0) | (c - F.element_at(a, -1) >= least_s), F.concat(a, F.array(c))).otherwise(a)
    return F.aggregate(cuts, F.array().cast("array<double>"), lambda a, c: F.when(F.size(a) == 0, F.array(c)).otherwise(take(a, c)))


def or_whole(videos: DataFrame, scenes: DataFrame, fallback: bool = True) -> DataFrame:
    """scenes, and for videos without any, the whole video marked as not detected (or nothing)."""
    found = scenes.select("video_id", "start_s", "end_s", F.lit(False).alias("scenedetect_failed"))
    if not fallback:
        return found
    rest = videos.join(scenes.select("video_id"), "video_id", "left_anti")
    return found.unionByName(rest.select("video_id", F.lit(0.0).alias("start_s"), F.col("duration_s").alias("end_s"), F.lit(True).alias("scenedetect_failed")))


def probed(probe: DataFrame, text: str = "probe") -> DataFrame:
    """Adds fps, width, height, duration_s and valid from a probe document; a rate over zero is not valid."""
    schema = "streams array<struct<codec_type:string,r_frame_rate:string,width:int,height:int>>, format struct<duration:string>"
    doc = probe.withColumn("__p", F.from_json(text, schema))
    video = F.get(F.filter("__p.streams", lambda s: s["codec_type"] == "video"), F.lit(0))
    doc = doc.withColumn("__v", video)
    rate = F.split(F.col("__v.r_frame_rate"), "/")
    over, under = F.get(rate, F.lit(0)).try_cast("double"), F.coalesce(F.get(rate, F.lit(1)).try_cast("double"), F.lit(1.0))
    fps = F.when(under != 0, over / F.when(under != 0, under))
    doc = doc.select(*probe.columns, fps.alias("fps"), F.col("__v.width").alias("width"), F.col("__v.height").alias("height"), F.col("__p.format.duration").try_cast("double").alias("duration_s"), F.exists("__p.streams", lambda s: s["codec_type"] == "audio").alias("audio"))
    return doc.withColumn("valid", F.coalesce(F.col("fps") > 0, F.lit(False)))


def schedule(tasks: DataFrame, *ties: str) -> DataFrame:
    """Longest first, in a column `place` from 1 on; missing bounds count as zero, ties by the columns named.

    Places are counted within the ranges of a range-partitioned sort and added up, so no task sees all rows. The sorted
    rows are written once: a second sort might draw its ranges elsewhere.
    """
    length = F.coalesce(F.col("end_s"), F.lit(0.0)) - F.coalesce(F.col("start_s"), F.lit(0.0))
    ordered = tasks.withColumn("__length", length).orderBy(F.desc("__length"), *ties)
    ordered = materialize(ordered.withColumn("__at", F.monotonically_increasing_id()), "schedule")
    part, nth = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    rows = ordered.withColumns({"__part": part, "__nth": nth})
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    bases = sizes.withColumn("__base", before).select("__part", "__base")  # a row per range
    return rows.join(F.broadcast(bases), "__part").withColumn("place", F.col("__base") + F.col("__nth") + 1).drop("__length", "__at", "__part", "__nth", "__base")


def scenes_between(videos: DataFrame, cuts: DataFrame, least_s: float) -> DataFrame:
    """Scenes between cuts (video_id, at_s), none shorter than least_s from one cut to the next; videos without a cut
    have no scene. Cuts outside the video are ignored."""
    inside = cuts.join(videos.select("video_id", "duration_s"), "video_id").where((F.col("at_s") > 0) & (F.col("at_s") < F.col("duration_s")))
    per = inside.groupBy("video_id").agg(F.max("duration_s").alias("duration_s"), F.array_sort(F.collect_set("at_s")).alias("cuts"))
    taken = F.filter(spaced(F.concat(F.array(F.lit(0.0)), F.col("cuts")), least_s), lambda c: c > 0)
    edges = per.select("video_id", F.concat(F.array(F.lit(0.0)), taken, F.array("duration_s")).alias("e"))
    pairs = F.zip_with(F.slice("e", F.lit(1), F.size("e") - 1), F.slice("e", F.lit(2), F.size("e") - 1), lambda a, b: F.struct(a.alias("start_s"), b.alias("end_s")))
    return edges.select("video_id", F.inline(pairs))
