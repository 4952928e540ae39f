"""Time, manifests and scheduling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright import fixtures
from clipwright.fixtures import with_
from clipwright.functions.ids import clip_id
from clipwright.functions.time import seconds_from_frames
from clipwright.operators import manifest, state
from clipwright.plans.config import PipelineConfig

TIES = ("clip_id", "line", "part", "supp", "start_s", "end_s")


def framed_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.framed(manifest.with_videos(fixtures.clips(spark, sf_dir), fixtures.videos(spark, sf_dir)))


def frame_align(spark, sf_dir):
    return framed_clips(spark, sf_dir).select("video_id", "line", "start_s", "end_s", "frame_start", "frame_end", "start_aligned_s", "end_aligned_s", "aligned")


def clip_tasks(spark, sf_dir):
    return manifest.tasks(framed_clips(spark, sf_dir))


def clip_ids(spark, sf_dir):
    rows = framed_clips(spark, sf_dir)
    return rows.select("video_id", "frame_start", "frame_end", clip_id(F.col("video_id"), F.col("frame_start"), F.col("frame_end")).alias("clip_id"))


def video_dedupe_last(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return manifest.last_by_key(rows, "user_id", "event_id")


def run_manifest(spark, sf_dir):
    n = F.count(F.lit(1)).cast("string")
    row = PipelineConfig(model_versions={"sam2": "v1"}).run_manifest("20240101_000000", "2024-01-01T00:00:00Z", "config.json")
    rows = fixtures.table(spark, sf_dir, "orders").agg(F.sha2(F.concat(F.lit("orders:"), n), 256).alias("dataset_hash"))
    return rows.select(*[F.lit(v).alias(k) for k, v in row.items() if k != "dataset_hash"], "dataset_hash")


def scene_segments(spark, sf_dir):
    rows = fixtures.state_events(spark, sf_dir).select("clip_key", "updated_at")
    return manifest.scenes_by_gap(rows, "clip_key", "updated_at", 12 * 3600).withColumns({"start_s": F.round("start_s", 3), "end_s": F.round("end_s", 3)})


def overlap_clamp(spark, sf_dir):
    rows = manifest.with_videos(fixtures.clips(spark, sf_dir), fixtures.videos(spark, sf_dir))
    return manifest.expanded(rows, 1.0).select("video_id", "line", "start_s", "end_s", "frame_start", "frame_end", "aligned")


def fallback_full_clip(spark, sf_dir):
    scenes = fixtures.clips(spark, sf_dir).where("video_id % 3 <> 0").select("video_id", "start_s", "end_s")
    return manifest.or_whole(fixtures.videos(spark, sf_dir), scenes)


def min_scene_merge(spark, sf_dir):
    cuts = fixtures.state_events(spark, sf_dir).groupBy("clip_key").agg(F.array_sort(F.collect_list("updated_at")).alias("cuts"))
    kept = cuts.select("clip_key", F.posexplode(manifest.spaced(F.col("cuts"), 6 * 3600.0)).alias("nth", "cut"))
    return kept.select("clip_key", "nth", F.round("cut", 3).alias("cut_s"))


PROBE = ("30/1", "30000/1001", "0/0", "25/1", "x/y", "24")


def probe_fps_parse(spark, sf_dir):
    key = F.col("o_orderkey")
    rate = F.element_at(F.array(*map(F.lit, PROBE)), (key % len(PROBE)).cast("int") + 1)
    text = F.concat(F.lit('{"streams":[{"codec_type":"audio"},{"codec_type":"video","r_frame_rate":"'), rate, F.lit('","width":'), (key % 1000 + 320).cast("string"), F.lit(',"height":240}],"format":{"duration":"'), (key % 61).cast("string"), F.lit('.5"}}'))
    rows = fixtures.table(spark, sf_dir, "orders").select(key.alias("video_id"), text.alias("probe"))
    return manifest.probed(rows).select("video_id", F.round("fps", 6).alias("fps"), "width", "height", "duration_s", "audio", "valid")


def resume_schedule(spark, sf_dir):
    """State log to latest state, resumable clips, their work items, longest first."""
    log = fixtures.state_events(spark, sf_dir)
    todo = state.resumable(state.latest(log)).select("clip_key")
    users = log.agg(F.count_distinct("clip_key")).head()[0]
    clips = fixtures.clips(spark, sf_dir).withColumn("clip_key", F.try_mod(F.col("video_id"), F.lit(users)))
    clips = clips.join(todo, "clip_key", "left_semi")
    rows = manifest.framed(manifest.with_videos(clips, fixtures.videos(spark, sf_dir)))
    rows = rows.withColumn("clip_id", clip_id(F.col("video_id"), F.col("frame_start"), F.col("frame_end")))
    placed = manifest.schedule(rows, *TIES)
    return placed.select("place", "clip_id", "video_id", "path", "start_s", "end_s", "frame_start", "frame_end", "line", "part", "supp")


def clip_range_extract(spark, sf_dir):
    """The frames of clips that lie in a time range, as a predicate on frame numbers."""
    cut = manifest.within(framed_clips(spark, sf_dir), 10.0, 20.0)
    return cut.select("video_id", "line", "from_frame", "to_frame", seconds_from_frames(F.col("from_frame"), F.col("fps")).alias("from_s"))


def clip_range_whole(spark, sf_dir):
    """Without a bound above zero, all frames."""
    return manifest.within(framed_clips(spark, sf_dir), 0.0, -1.0).select("video_id", "line", "from_frame", "to_frame")


def manifest_invariants(spark, sf_dir):
    """Breaches of what every manifest row must satisfy."""
    rows = manifest.expanded(manifest.with_videos(fixtures.clips(spark, sf_dir), fixtures.videos(spark, sf_dir)), 1.0)
    return rows.agg(
        F.count(F.lit(1)).alias("rows_seen"), F.count_if(~F.col("aligned")).alias("off_frame"),
        F.count_if((F.col("start_s") < 0) | (F.col("start_s") > F.col("end_s")) | (F.col("end_s") > F.col("duration_s") + 1e-6)).alias("out_of_bounds"),
    )


def scene_intervals(spark, sf_dir):
    """Scenes between cuts at least 5 s apart."""
    at = (F.col("event_id") * 7 % 55 + 1).cast("double")
    cuts = fixtures.table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), at.alias("at_s"))
    return manifest.scenes_between(fixtures.videos(spark, sf_dir), cuts, 5.0)


QUERIES = {f.__name__: f for f in (scene_intervals, frame_align, clip_tasks, clip_ids, video_dedupe_last, run_manifest, scene_segments, overlap_clamp, fallback_full_clip, min_scene_merge, probe_fps_parse, resume_schedule, clip_range_extract, clip_range_whole, manifest_invariants)}

_FRAMES = "CASE WHEN fps <= 0 THEN 0 ELSE round_even({0} * fps, 0)::INT END"
_FRAMED = f"""framed AS (
  SELECT c.*, path, fps, duration_s, {_FRAMES.format('start_s')} AS frame_start, {_FRAMES.format('end_s')} AS frame_end
  FROM clips c JOIN videos v USING (video_id))"""
_ID = "video_id::VARCHAR || '-' || lpad(frame_start::VARCHAR, 9, '0') || '-' || lpad(frame_end::VARCHAR, 9, '0') || '-' || substr(sha256(video_id::VARCHAR || ':' || frame_start::VARCHAR || ':' || frame_end::VARCHAR), 1, 8)"
_EXPANDED = f"""moved AS (
  SELECT video_id, line, fps, duration_s, greatest(0.0, start_s - 1.0) AS s, least(duration_s, end_s + 1.0) AS e
  FROM clips JOIN videos USING (video_id)
), expanded AS (
  SELECT *, {_FRAMES.format('s')} AS frame_start, {_FRAMES.format('e')} AS frame_end FROM moved)"""
_MANIFEST = PipelineConfig(model_versions={"sam2": "v1"}).run_manifest("20240101_000000", "2024-01-01T00:00:00Z", "config.json")

SQL = {
    "scene_intervals": f"""{with_('videos', recursive=True)}, cuts AS (
  SELECT video_id, duration_s, at_s, row_number() OVER (PARTITION BY video_id ORDER BY at_s) AS k
  FROM (SELECT DISTINCT video_id, duration_s, (event_id * 7 % 55 + 1)::DOUBLE AS at_s FROM events JOIN videos ON video_id = user_id) WHERE at_s < duration_s
), walk(video_id, duration_s, k, last, taken) AS (
  SELECT video_id, duration_s, 0::BIGINT, 0.0::DOUBLE, true FROM (SELECT DISTINCT video_id, duration_s FROM cuts)
  UNION ALL
  SELECT w.video_id, w.duration_s, c.k, CASE WHEN c.at_s - w.last >= 5 THEN c.at_s ELSE w.last END, c.at_s - w.last >= 5
  FROM walk w JOIN cuts c ON c.video_id = w.video_id AND c.k = w.k + 1
)
SELECT video_id, last AS start_s, lead(last, 1, duration_s) OVER (PARTITION BY video_id ORDER BY k) AS end_s FROM walk WHERE taken""",
    "frame_align": f"""{with_('videos', 'clips')}, {_FRAMED}
SELECT video_id, line, start_s, end_s, frame_start, frame_end, frame_start::DOUBLE / fps AS start_aligned_s, frame_end::DOUBLE / fps AS end_aligned_s,
       abs(start_s - frame_start::DOUBLE / fps) < 1e-6 AND abs(end_s - frame_end::DOUBLE / fps) < 1e-6 AS aligned FROM framed""",
    "clip_tasks": f"""{with_('videos', 'clips')}, {_FRAMED}
SELECT {_ID} AS clip_id, video_id, path AS video_path, start_s, end_s, frame_start, frame_end, false AS scenedetect_failed, 0 AS retry_count FROM framed""",
    "clip_ids": f"""{with_('videos', 'clips')}, {_FRAMED}
SELECT video_id, frame_start, frame_end, {_ID} AS clip_id FROM framed""",
    "video_dedupe_last": """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
FROM events GROUP BY user_id""",
    "run_manifest": "SELECT " + ", ".join(f"'{v}' AS {k}" for k, v in _MANIFEST.items() if k != "dataset_hash") + ", sha256('orders:' || count(*)::VARCHAR) AS dataset_hash FROM orders",
    "scene_segments": f"""{with_('state_events')}, marked AS (
  SELECT clip_key, updated_at, coalesce((updated_at - lag(updated_at) OVER w > 43200)::INT, 0) AS cut FROM state_events WINDOW w AS (PARTITION BY clip_key ORDER BY updated_at)
), numbered AS (SELECT *, sum(cut) OVER (PARTITION BY clip_key ORDER BY updated_at ROWS UNBOUNDED PRECEDING)::BIGINT AS scene FROM marked)
SELECT clip_key, scene, round(min(updated_at), 3) AS start_s, round(max(updated_at), 3) AS end_s, count(*) AS points FROM numbered GROUP BY clip_key, scene""",
    "overlap_clamp": f"""{with_('videos', 'clips')}, {_EXPANDED}
SELECT video_id, line, frame_start::DOUBLE / fps AS start_s, frame_end::DOUBLE / fps AS end_s, frame_start, frame_end,
       abs(s - frame_start::DOUBLE / fps) < 1e-6 AND abs(e - frame_end::DOUBLE / fps) < 1e-6 AS aligned FROM expanded""",
    "fallback_full_clip": f"""{with_('videos', 'clips')}
SELECT video_id, start_s, end_s, false AS scenedetect_failed FROM clips WHERE video_id % 3 <> 0
UNION ALL
SELECT video_id, 0.0::DOUBLE, duration_s, true FROM videos WHERE video_id NOT IN (SELECT video_id FROM clips WHERE video_id % 3 <> 0)""",
    "min_scene_merge": f"""{with_('state_events', recursive=True)}, ordered AS (
  SELECT clip_key, updated_at, row_number() OVER (PARTITION BY clip_key ORDER BY updated_at) AS k FROM state_events
), walk(clip_key, k, cut, nth, taken) AS (
  SELECT clip_key, k, updated_at, 0, true FROM ordered WHERE k = 1
  UNION ALL
  SELECT w.clip_key, o.k, CASE WHEN o.updated_at - w.cut >= 21600 THEN o.updated_at ELSE w.cut END,
         CASE WHEN o.updated_at - w.cut >= 21600 THEN w.nth + 1 ELSE w.nth END, o.updated_at - w.cut >= 21600
  FROM walk w JOIN ordered o ON o.clip_key = w.clip_key AND o.k = w.k + 1
)
SELECT clip_key, nth, round(cut, 3) AS cut_s FROM walk WHERE taken""",
    "probe_fps_parse": """WITH rates AS (
  SELECT o_orderkey AS video_id, (['30/1', '30000/1001', '0/0', '25/1', 'x/y', '24'])[(o_orderkey % 6)::INT + 1] AS rate FROM orders
), parsed AS (
  SELECT video_id, try_cast(split_part(rate, '/', 1) AS DOUBLE) AS over, CASE WHEN contains(rate, '/') THEN coalesce(try_cast(split_part(rate, '/', 2) AS DOUBLE), 1.0) ELSE 1.0 END AS under FROM rates
), rated AS (SELECT video_id, CASE WHEN under <> 0 THEN over / under END AS fps FROM parsed)
SELECT video_id, round(fps, 6) AS fps, (video_id % 1000 + 320)::INT AS width, 240 AS height, (video_id % 61 + 0.5)::DOUBLE AS duration_s, true AS audio, coalesce(fps > 0, false) AS valid FROM rated""",
    "resume_schedule": f"""{with_('videos', 'clips', 'state_events')}, latest AS (
  SELECT clip_key, arg_max(status, seq) AS status FROM state_events GROUP BY clip_key
), todo AS (SELECT clip_key FROM latest WHERE status IN ('Pending', 'Failed', 'Writing', 'Running')), {_FRAMED}, keyed AS (
  SELECT *, {_ID} AS clip_id FROM framed WHERE video_id % (SELECT count(DISTINCT clip_key) FROM state_events) IN (SELECT clip_key FROM todo)
)
SELECT row_number() OVER (ORDER BY end_s - start_s DESC, clip_id, line, part, supp, start_s, end_s) AS place,
       clip_id, video_id, path, start_s, end_s, frame_start, frame_end, line, part, supp FROM keyed""",
    "clip_range_extract": f"""{with_('videos', 'clips')}, {_FRAMED}, ranged AS (
  SELECT *, round_even(10.0 * fps, 0)::INT AS low, round_even(20.0 * fps, 0)::INT AS high FROM framed)
SELECT video_id, line, greatest(frame_start, low) AS from_frame, least(frame_end, high) AS to_frame, greatest(frame_start, low)::DOUBLE / fps AS from_s
FROM ranged WHERE frame_start <= high AND frame_end >= low""",
    "clip_range_whole": f"""{with_('videos', 'clips')}, {_FRAMED} SELECT video_id, line, frame_start AS from_frame, frame_end AS to_frame FROM framed""",
    "manifest_invariants": f"""{with_('videos', 'clips')}, {_EXPANDED}, ended AS (
  SELECT *, frame_start::DOUBLE / fps AS s2, frame_end::DOUBLE / fps AS e2 FROM expanded)
SELECT count(*) AS rows_seen, count(*) FILTER (NOT (abs(s - s2) < 1e-6 AND abs(e - e2) < 1e-6)) AS off_frame,
       count(*) FILTER (s2 < 0 OR s2 > e2 OR e2 > duration_s + 1e-6) AS out_of_bounds FROM ended""",
}
