"""Boxes: areas, overlaps, top-k, formats, suppression, tracking."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwright import fixtures
from clipwright.fixtures import with_
from clipwright.functions.geometry import area, columns, iou
from clipwright.operators import boxes as ops


def box_area(spark, sf_dir):
    return fixtures.boxes(spark, sf_dir).select("frame_key", "ord", area(columns()).alias("area"))


def iou_pairs(spark, sf_dir):
    rows = fixtures.boxes(spark, sf_dir).select("frame_key", "ord", *columns())
    other = rows.select("frame_key", F.col("ord").alias("other"), *[F.col(c).alias(f"o{c}") for c in columns()])
    pairs = rows.join(other, "frame_key").where("ord < other").withColumn("iou", F.round(iou(columns(), columns("o")), 9))
    return pairs.where("iou > 0").select("frame_key", "ord", "other", "iou")


def area_filter(spark, sf_dir):
    return ops.large_enough(fixtures.boxes(spark, sf_dir), 2500.0).select("frame_key", "ord")


def topk_detections(spark, sf_dir):
    return ops.top_k(fixtures.boxes(spark, sf_dir), 3).select("frame_key", "ord", "score", "phrase", "place")


def _raw(spark, sf_dir):
    """Boxes as detectors may give them: by frame, corners in pixels, corners as shares, or centres and sizes as shares."""
    rows, kind = fixtures.boxes(spark, sf_dir), F.col("frame_key") % 3
    value = lambda c, share: F.when(kind == 0, F.col(c)).when(kind == 1, F.col(c) / 400).otherwise(share)
    return rows.withColumns({"x1": value("x1", 0.25 + F.col("x1") / 400), "y1": value("y1", 0.25 + F.col("y1") / 400), "x2": value("x2", F.lit(0.125)), "y2": value("y2", F.lit(0.25))})


def normalize_boxes(spark, sf_dir):
    rows = ops.normalized(_raw(spark, sf_dir), 320, 240)
    return rows.select("frame_key", "ord", *[F.round(F.col(c).cast("double"), 2).alias(c) for c in columns()])


def nms(spark, sf_dir):
    return ops.suppressed(fixtures.boxes(spark, sf_dir), 0.1).select("frame_key", "ord", *columns())


def track_ids(spark, sf_dir):
    rows = fixtures.boxes(spark, sf_dir).select(F.col("frame_key").alias("clip_key"), F.col("ord").cast("long").alias("frame"), "ord", *columns())
    return ops.tracked(rows, 0.3).select("clip_key", "ord", "object")


def best_match(spark, sf_dir):
    rows = fixtures.boxes(spark, sf_dir)
    found = ops.best_match(rows.where("ord > 2"), rows.where("ord <= 2"), 0.2)
    return found.withColumn("iou", F.round("iou", 9))


def zip_phrases(spark, sf_dir):
    """A detector's lists of scores and phrases, the latter too short, as rows."""
    in_order = F.array_sort(F.collect_list(F.struct("ord", "score", "phrase")))
    lists = fixtures.boxes(spark, sf_dir).groupBy("frame_key").agg(in_order.alias("b"))
    lists = lists.select("frame_key", F.transform("b", lambda x: x["score"]).alias("scores"), F.slice(F.transform("b", lambda x: x["phrase"]), F.lit(1), F.lit(2)).alias("phrases"))
    return ops.detections(lists)


QUERIES = {f.__name__: f for f in (zip_phrases, box_area, iou_pairs, area_filter, topk_detections, normalize_boxes, nms, track_ids, best_match)}

_AREA = "greatest(0.0, {0}x2 - {0}x1) * greatest(0.0, {0}y2 - {0}y1)"
_OVER = "greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"
_IOU = f"({_OVER}) / ({_AREA.format('a.')} + {_AREA.format('b.')} - ({_OVER}) + 1e-6)"

SQL = {
    "zip_phrases": f"{with_('boxes')} SELECT frame_key, ord - 1 AS ord, score, CASE WHEN ord <= 2 THEN phrase ELSE '' END AS phrase FROM boxes",
    "box_area": f"{with_('boxes')} SELECT frame_key, ord, {_AREA.format('')} AS area FROM boxes",
    "iou_pairs": f"""{with_('boxes')}
SELECT a.frame_key, a.ord, b.ord AS other, round({_IOU}, 9) AS iou FROM boxes a JOIN boxes b ON a.frame_key = b.frame_key AND a.ord < b.ord WHERE round({_IOU}, 9) > 0""",
    "area_filter": f"{with_('boxes')} SELECT frame_key, ord FROM boxes WHERE {_AREA.format('')} >= 2500.0",
    "topk_detections": f"""{with_('boxes')}, placed AS (SELECT *, row_number() OVER (PARTITION BY frame_key ORDER BY score DESC, ord DESC)::INT AS place FROM boxes)
SELECT frame_key, ord, score, phrase, place FROM placed WHERE place <= 3""",
    "normalize_boxes": f"""{with_('boxes')}, raw AS (
  SELECT frame_key, ord,
    (CASE frame_key % 3 WHEN 0 THEN x1 WHEN 1 THEN x1 / 400 ELSE 0.25 + x1 / 400 END)::FLOAT AS a, (CASE frame_key % 3 WHEN 0 THEN y1 WHEN 1 THEN y1 / 400 ELSE 0.25 + y1 / 400 END)::FLOAT AS b,
    (CASE frame_key % 3 WHEN 0 THEN x2 WHEN 1 THEN x2 / 400 ELSE 0.125 END)::FLOAT AS c, (CASE frame_key % 3 WHEN 0 THEN y2 WHEN 1 THEN y2 / 400 ELSE 0.25 END)::FLOAT AS d FROM boxes
), kinds AS (SELECT *, avg((c < a)::INT) OVER (PARTITION BY frame_key) > 0.5 AS centred FROM raw
), corners AS (
  SELECT frame_key, ord, CASE WHEN centred THEN a - c / 2::FLOAT ELSE a END AS x1, CASE WHEN centred THEN b - d / 2::FLOAT ELSE b END AS y1,
         CASE WHEN centred THEN a + c / 2::FLOAT ELSE c END AS x2, CASE WHEN centred THEN b + d / 2::FLOAT ELSE d END AS y2 FROM kinds
), scales AS (SELECT *, max(greatest(x1, y1, x2, y2)) OVER (PARTITION BY frame_key) <= 1.5 AS share FROM corners
), scaled AS (
  SELECT frame_key, ord, CASE WHEN share THEN x1 * 320::FLOAT ELSE x1 END AS x1, CASE WHEN share THEN y1 * 240::FLOAT ELSE y1 END AS y1,
         CASE WHEN share THEN x2 * 320::FLOAT ELSE x2 END AS x2, CASE WHEN share THEN y2 * 240::FLOAT ELSE y2 END AS y2 FROM scales)
SELECT frame_key, ord, round(least(greatest(x1, 0::FLOAT), 319::FLOAT)::DOUBLE, 2) AS x1, round(least(greatest(y1, 0::FLOAT), 239::FLOAT)::DOUBLE, 2) AS y1,
       round(least(greatest(x2, 0::FLOAT), 319::FLOAT)::DOUBLE, 2) AS x2, round(least(greatest(y2, 0::FLOAT), 239::FLOAT)::DOUBLE, 2) AS y2 FROM scaled""",
    "nms": f"""{with_('boxes', recursive=True)}, ranked AS (
  SELECT frame_key, ord, x1, y1, x2, y2, row_number() OVER (PARTITION BY frame_key ORDER BY (x2 - x1) * (y2 - y1) DESC, ord DESC) AS r FROM boxes
), walk(frame_key, r, kept) AS (
  SELECT frame_key, r, [{{'ord': ord, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] FROM ranked WHERE r = 1
  UNION ALL
  SELECT w.frame_key, b.r,
    CASE WHEN len(list_filter(w.kept, lambda a: {_OVER} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_OVER} + 1e-6) >= 0.1)) > 0
         THEN w.kept ELSE list_append(w.kept, {{'ord': b.ord, 'x1': b.x1, 'y1': b.y1, 'x2': b.x2, 'y2': b.y2}}) END
  FROM walk w JOIN ranked b ON b.frame_key = w.frame_key AND b.r = w.r + 1
), ended AS (SELECT frame_key, unnest(arg_max(kept, r)) AS k FROM walk GROUP BY frame_key)
SELECT frame_key, k.ord AS ord, k.x1 AS x1, k.y1 AS y1, k.x2 AS x2, k.y2 AS y2 FROM ended""",
    "track_ids": f"""{with_('boxes', recursive=True)}, walk(frame_key, ord, now, object) AS (
  SELECT frame_key, ord, [{{'id': 1, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}], 1 FROM boxes WHERE ord = 1
  UNION ALL
  SELECT frame_key, ord, CASE WHEN chosen > len(now) THEN list_append(now, {{'id': chosen, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}})
                              ELSE list_transform(now, lambda t: CASE WHEN t.id = chosen THEN {{'id': chosen, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ELSE t END) END, chosen
  FROM (
    SELECT w.frame_key, b.ord, w.now, b.x1, b.y1, b.x2, b.y2,
      coalesce(-(list_max(list_transform(list_filter(w.now, lambda a: {_IOU} >= 0.3), lambda a: {{'iou': {_IOU}, 'old': -a.id}})).old), len(w.now) + 1)::INT AS chosen
    FROM walk w JOIN boxes b ON b.frame_key = w.frame_key AND b.ord = w.ord + 1)
)
SELECT frame_key AS clip_key, ord, object FROM walk""",
    "best_match": f"""{with_('boxes')}, near AS (
  SELECT b.frame_key, b.ord, a.ord AS object, {_IOU} AS iou FROM boxes a JOIN boxes b ON a.frame_key = b.frame_key WHERE a.ord <= 2 AND b.ord > 2 AND {_IOU} >= 0.2
), best AS (SELECT *, row_number() OVER (PARTITION BY frame_key, ord ORDER BY iou DESC, object) AS r FROM near)
SELECT frame_key, ord, object, round(iou, 9) AS iou FROM best WHERE r = 1""",
}
