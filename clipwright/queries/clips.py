"""The run of clips from prompt frames to masks, with models that follow a rule."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from clipwright import fixtures
from clipwright.fixtures import with_
from clipwright.operators import clips as ops
from clipwright.operators.models import Detector, Segmenter
from clipwright.plans.config import PromptConfig
from clipwright.queries.geometry import _IOU, _OVER
from clipwright.scratch import materialize

PROMPT = PromptConfig(max_boxes_per_frame=3, min_box_area=2500.0, nms_iou=0.1)
SIDE = 4


class Listed:
    """Finds the boxes a task carries: the first prompt frame has those of even places, the second the others."""

    def detect(self, task):
        for k, frame in enumerate(task["prompt_frames"]):
            own = [b for b in task["found"] if b["ord"] % 2 == k]
            yield {"frame": int(frame), "height": 240, "width": 320, "boxes": [[b[c] for c in ("x1", "y1", "x2", "y2")] for b in own], "scores": [b["score"] for b in own], "phrases": []}


class Stripes:
    """A plane per object that depends on its id, its last box and the frame; nothing in the third frame."""

    def frames(self, task):
        last = {p["object"]: int(p["x1"]) for p in task["prompts"]}
        pixels = np.arange(SIDE * SIDE).reshape(SIDE, SIDE)
        for offset in (0, 1):
            yield {"offset": offset, "planes": np.array([(pixels + i + offset + x) % 5 == 0 for i, x in last.items()])}
        yield {"offset": 2, "planes": None}


def _tasks(spark, sf_dir):
    """Every video's first three seconds from the second one on, with what the detector will find."""
    box = F.struct("ord", "x1", "y1", "x2", "y2", "score")
    found = fixtures.boxes(spark, sf_dir).groupBy(F.col("frame_key").alias("video_id")).agg(F.sort_array(F.collect_list(box)).alias("found"))
    rows = fixtures.videos(spark, sf_dir).join(found, "video_id", "left").withColumn("found", F.coalesce("found", F.array().cast(found.schema["found"].dataType)))
    return rows.select(F.col("video_id").cast("string").alias("clip_id"), F.col("path").alias("video_path"), F.lit(2.0).alias("start_s"), F.lit(5.0).alias("end_s"), "fps", "duration_s", "found")


def _results(spark, sf_dir):
    tasks = materialize(_tasks(spark, sf_dir), "clip-tasks")
    keep = lambda rows: materialize(rows, "clip-results")
    return tasks, keep(ops.segmented(tasks, Detector(Listed), Segmenter(Stripes), PROMPT, keep))


def clip_run(spark, sf_dir):
    """Prompt frames, detections, filters, suppression, tracks, segmentation, unions, run lengths, frame numbers."""
    tasks, results = _results(spark, sf_dir)
    return ops.mask_rows(results, tasks)


def clip_quality(spark, sf_dir):
    return ops.mask_quality(_results(spark, sf_dir)[1]).withColumn("empty_mask_rate", F.round("empty_mask_rate", 9))


def clip_prompts(spark, sf_dir):
    """What the segmenter is asked about: frames, objects and boxes."""
    tasks = ops.with_prompt_frames(_tasks(spark, sf_dir), PROMPT.prompt_interval_s, PROMPT.max_prompts_per_clip)
    found = materialize(Detector(Listed).run(tasks), "clip-detections")
    given = ops.prompts(found.where("ok").select("clip_id", F.inline("rows")), PROMPT)
    return given.select("clip_id", F.inline("prompts"))


QUERIES = {f.__name__: f for f in (clip_run, clip_quality, clip_prompts)}

_TRACKS = f"""{with_('boxes', 'videos', recursive=True)}, placed AS (
  SELECT frame_key AS clip, ord % 2 AS f, row_number() OVER (PARTITION BY frame_key, ord % 2 ORDER BY score DESC, ord DESC) AS place, x1, y1, x2, y2 FROM boxes
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY clip, f ORDER BY (x2 - x1) * (y2 - y1) DESC, place DESC) AS r FROM placed WHERE place <= 3 AND (x2 - x1) * (y2 - y1) >= 2500.0
), walk(clip, f, r, kept) AS (
  SELECT clip, f, r, [{{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] FROM ranked WHERE r = 1
  UNION ALL
  SELECT w.clip, w.f, b.r,
    CASE WHEN len(list_filter(w.kept, lambda a: {_OVER} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_OVER} + 1e-6) >= 0.1)) > 0
         THEN w.kept ELSE list_append(w.kept, {{'x1': b.x1, 'y1': b.y1, 'x2': b.x2, 'y2': b.y2}}) END
  FROM walk w JOIN ranked b ON b.clip = w.clip AND b.f = w.f AND b.r = w.r + 1
), ended AS (SELECT clip, f, arg_max(kept, r) AS kept FROM walk GROUP BY clip, f
), line AS (
  SELECT clip, f, k.x1 AS x1, k.y1 AS y1, k.x2 AS x2, k.y2 AS y2, row_number() OVER (PARTITION BY clip ORDER BY f, n) AS ord
  FROM (SELECT clip, f, unnest(kept) AS k, unnest(range(1, len(kept) + 1)) AS n FROM ended)
), track(clip, ord, now, object) AS (
  SELECT clip, ord, [{{'id': 1, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}], 1 FROM line WHERE ord = 1
  UNION ALL
  SELECT clip, ord, CASE WHEN chosen > len(now) THEN list_append(now, {{'id': chosen, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}})
                         ELSE list_transform(now, lambda t: CASE WHEN t.id = chosen THEN {{'id': chosen, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ELSE t END) END, chosen
  FROM (
    SELECT w.clip, b.ord, w.now, b.x1, b.y1, b.x2, b.y2,
      coalesce(-(list_max(list_transform(list_filter(w.now, lambda a: {_IOU} >= 0.5), lambda a: {{'iou': {_IOU}, 'old': -a.id}})).old), len(w.now) + 1)::INT AS chosen
    FROM track w JOIN line b ON b.clip = w.clip AND b.ord = w.ord + 1)
)"""

SQL = {
    "clip_prompts": f"""{_TRACKS}
SELECT l.clip::VARCHAR AS clip_id, (f * round_even(2.0 * fps, 0))::INT AS frame, object, x1, y1, x2, y2 FROM line l JOIN track t ON t.clip = l.clip AND t.ord = l.ord JOIN videos ON video_id = l.clip""",
    "clip_run": f"""{_TRACKS}, objects AS (SELECT clip, unnest(arg_max(now, ord)) AS o FROM track GROUP BY clip
), pixels AS (
  SELECT clip, f, (p % 4) * 4 + p // 4 AS pos, bool_or((p + o.id + f + o.x1::INT) % 5 = 0)::INT AS bit FROM objects, range(0, 16) t(p), range(0, 2) u(f) GROUP BY clip, f, p
), cut AS (SELECT *, (bit <> lag(bit, 1, 0) OVER (PARTITION BY clip, f ORDER BY pos))::INT AS c FROM pixels
), numbered AS (SELECT *, sum(c) OVER (PARTITION BY clip, f ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM cut
), runs AS (SELECT clip, f, run, count(*) AS length FROM numbered GROUP BY clip, f, run
), texts AS (SELECT clip, f, string_agg(length::VARCHAR, ', ' ORDER BY run) AS counts, min(run) AS first FROM runs GROUP BY clip, f)
SELECT clip::VARCHAR AS clip_id, (f + round_even(2.0 * fps, 0))::BIGINT AS frame_index, (f + round_even(2.0 * fps, 0)) / fps AS timestamp_s,
       '{{"size": [4, 4], "counts": [' || CASE WHEN first = 1 THEN '0, ' ELSE '' END || counts || ']}}' AS mask_rle
FROM texts JOIN videos ON video_id = clip""",
    "clip_quality": f"""{_TRACKS}
SELECT video_id::VARCHAR AS clip_id, CASE WHEN video_id IN (SELECT clip FROM line) THEN 3 ELSE 0 END::BIGINT AS frames, CASE WHEN video_id IN (SELECT clip FROM line) THEN round(1 / 3, 9) ELSE 1.0 END::DOUBLE AS empty_mask_rate
FROM videos""",
}
