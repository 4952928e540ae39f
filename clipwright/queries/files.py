"""Manifests, artifacts and documents written and read back; files found and summed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clipwright import fixtures, schemas
from clipwright.fixtures import with_
from clipwright.functions.text import ascii_only
from clipwright.operators import manifest
from clipwright.plans.config import OPERATORS, PromptConfig, operator_configs
from clipwright.queries.manifest import framed_clips
from clipwright.queries.masks import _counts
from clipwright.functions.masks import rle_text
from clipwright.scratch import shared_dir
from clipwright.sources import manifests, sinks


def _place(spark) -> str:
    return f"{shared_dir(spark)}/query-{uuid.uuid4().hex}"


def _videos(spark, sf_dir):
    """The manifest's columns, for every order."""
    key = F.col("video_id")
    return fixtures.videos(spark, sf_dir).select(
        key.cast("string").alias("video_id"), "path", "duration_s", "fps", F.lit(320).alias("width"), F.lit(240).alias("height"), (key % 2 == 0).alias("audio"),
        F.sha2("path", 256).alias("checksum"), F.when(key % 5 == 0, F.lit(None)).otherwise(F.lit("train")).alias("split"),
    )


def manifest_lines(spark, sf_dir):
    path = f"{_place(spark)}.jsonl"
    sinks.write_json_lines(_videos(spark, sf_dir), path)
    return manifests.read_manifest(spark, path, schemas.VIDEOS)


def manifest_parquet(spark, sf_dir):
    path = f"{_place(spark)}.parquet"
    _videos(spark, sf_dir).write.parquet(path)
    return manifests.read_manifest(spark, path, schemas.VIDEOS)


def last_row_wins(spark, sf_dir):
    """Two files with a row for every video, the second much smaller and decisive, as files come by name, not by size."""
    path, rows = _place(spark), _videos(spark, sf_dir).select("video_id", "path", "duration_s", "fps")
    sinks.write_json_lines(rows.withColumn("path", F.concat("path", F.repeat(F.lit("x"), F.lit(300)))).coalesce(1), f"{path}/a")
    sinks.write_json_lines(rows.withColumn("duration_s", F.col("duration_s") + 1000).coalesce(1), f"{path}/b")
    found = manifests.read_manifest(spark, f"{path}/*", "video_id string, path string, duration_s double, fps double", ordinal=True)
    return manifest.last_by_key(manifest.in_order(found), "video_id", "__at").select("video_id", "path", "duration_s")


def _tasks(spark, sf_dir):
    return manifest.tasks(framed_clips(spark, sf_dir))


def meta_fields(spark, sf_dir):
    """What a clip's description says, read back from its JSON."""
    text = lambda path: F.get_json_object("meta", path)
    rows = sinks.meta_documents(_tasks(spark, sf_dir).select(*schemas.TASK), schemas.FIELDS)
    return rows.select(text("$.clip.clip_id").alias("clip_id"), text("$.clip.start_s").cast("double").alias("start_s"), text("$.clip.retry_count").cast("int").alias("retry_count"), text("$.mask_encoding").alias("mask_encoding"), text("$.time_base").alias("time_base"), text("$.field_specs.fps").alias("fps_spec"))


def artifact_roundtrip(spark, sf_dir):
    """Masks of every clip, written twice; the second time some clips have none."""
    root = _place(spark)
    rows = _counts(spark, sf_dir).select(F.lit("r").alias("run_id"), (F.col("clip") % 3).cast("string").alias("video_id"), F.col("clip").cast("string").alias("clip_id"), F.col("object").alias("frame_index"), (F.col("object") / 30).alias("timestamp_s"), rle_text(F.col("counts"), 8, 8).alias("mask_rle"))
    clips = rows.select(*sinks.KEYS).distinct()
    sinks.write_artifact(rows, clips, root, "masks")
    sinks.write_artifact(rows.where("clip_id % 4 <> 0"), clips, root, "masks")
    return sinks.read_artifact(spark, root, "masks", schemas.MASKS).select("video_id", "clip_id", "frame_index", "mask_rle")


def meta_files(spark, sf_dir):
    """A document per clip in its folder, read back with the folder's keys; nations for clips, their regions for videos."""
    root, key = _place(spark), F.col("n_nationkey")
    rows = fixtures.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("c"), key).alias("clip_id"), F.col("n_regionkey").cast("string").alias("video_id"), F.lit("/é.mp4").alias("video_path"), F.lit(0.0).alias("start_s"), F.lit(1.0).alias("end_s"),
        (key * 30).cast("int").alias("frame_start"), (key * 30 + 30).cast("int").alias("frame_end"), F.lit(False).alias("scenedetect_failed"), F.lit(0).alias("retry_count"),
    )
    sinks.write_meta(rows, rows.select(F.lit("r").alias("run_id"), "video_id", "clip_id"), root)
    back = spark.read.schema("value string, run_id string, video_id string, clip_id string").text(f"{root}/meta")
    said = lambda path: F.get_json_object("value", path)
    return back.select("run_id", "video_id", "clip_id", said("$.clip.frame_start").cast("int").alias("frame_start"), said("$.clip.video_path").alias("video_path"), (F.octet_length("value") == F.length("value")).alias("ascii"))


def _written(spark, sf_dir) -> str:
    """A file for each region, in a folder for each, holding its name."""
    root = _place(spark)
    fixtures.table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("value")).repartition(1).write.partitionBy("r_regionkey").text(root)
    return root


def file_checksums(spark, sf_dir):
    found = manifests.checksums(spark, _written(spark, sf_dir), "**/*.txt")
    return found.select(F.regexp_extract("path", "r_regionkey=([0-9]+)", 1).cast("int").alias("r_regionkey"), "checksum")


def file_discovery(spark, sf_dir):
    """Globs speak of paths from the root, not of names alone."""
    found = manifests.discover(spark, _written(spark, sf_dir), "r_regionkey=[1-3]/*.txt")
    return found.select(F.regexp_extract("path", "r_regionkey=([0-9]+)", 1).cast("int").alias("r_regionkey"), "length")


def json_ascii(spark, sf_dir):
    text = F.concat(F.col("c_name"), F.lit("-é\n𝔘\""))
    return fixtures.table(spark, sf_dir, "customer").select("c_custkey", ascii_only(F.to_json(F.struct(text.alias("a")))).alias("json"))


def config_gates(spark, sf_dir):
    """Which operators run where a configuration names a region's, with the prompting it asks for."""
    out = []
    for key, name in fixtures.table(spark, sf_dir, "region").select("r_regionkey", "r_name").collect():  # five rows
        given = operator_configs({OPERATORS[key % len(OPERATORS)]: {"enabled": key % 2 == 0, "params": {"prompting": {"nms_iou": str(key), "prompt_text": name}}}, "unknown": {"enabled": True}})
        prompt = PromptConfig.load(given[OPERATORS[key % len(OPERATORS)]].params["prompting"])
        out += [(key, o, c.enabled, prompt.nms_iou, prompt.prompt_text, prompt.max_prompts_per_clip) for o, c in given.items()]
    return spark.createDataFrame(out, "r_regionkey int, operator string, enabled boolean, nms_iou double, prompt_text string, max_prompts int")


QUERIES = {f.__name__: f for f in (manifest_lines, manifest_parquet, last_row_wins, meta_fields, artifact_roundtrip, meta_files, file_checksums, file_discovery, json_ascii, config_gates)}

_FRAMED = """framed AS (
  SELECT video_id, start_s, round_even(start_s * fps, 0)::INT AS frame_start, round_even(end_s * fps, 0)::INT AS frame_end FROM clips JOIN videos USING (video_id)
), keyed AS (
  SELECT *, video_id::VARCHAR || '-' || lpad(frame_start::VARCHAR, 9, '0') || '-' || lpad(frame_end::VARCHAR, 9, '0') || '-' || substr(sha256(video_id::VARCHAR || ':' || frame_start::VARCHAR || ':' || frame_end::VARCHAR), 1, 8) AS clip_id FROM framed)"""
_VIDEOS = """SELECT video_id::VARCHAR AS video_id, path, duration_s, fps, 320 AS width, 240 AS height, video_id % 2 = 0 AS audio, sha256(path) AS checksum,
  CASE WHEN video_id % 5 = 0 THEN NULL ELSE 'train' END AS split FROM videos"""

SQL = {
    "manifest_lines": f"{with_('videos')} {_VIDEOS}",
    "manifest_parquet": f"{with_('videos')} {_VIDEOS}",
    "last_row_wins": f"{with_('videos')} SELECT video_id::VARCHAR AS video_id, path, duration_s + 1000 AS duration_s FROM videos",
    "meta_fields": f"""{with_('videos', 'clips')}, {_FRAMED} SELECT clip_id, start_s, 0 AS retry_count, 'rle' AS mask_encoding, 'seconds' AS time_base, '{schemas.FIELDS["fps"]}' AS fps_spec FROM keyed""",
    "artifact_roundtrip": f"""{with_('logits')}, pixels AS (
  SELECT object, clip, ((p - 1) % 8) * 8 + (p - 1) // 8 AS pos, (plane[p] > 0.15)::INT AS bit FROM logits, range(1, 65) t(p) WHERE clip % 4 <> 0
), cut AS (SELECT *, (bit <> lag(bit, 1, 0) OVER (PARTITION BY object ORDER BY pos))::INT AS c FROM pixels
), numbered AS (SELECT *, sum(c) OVER (PARTITION BY object ORDER BY pos ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM cut
), runs AS (SELECT object, clip, run, count(*) AS length FROM numbered GROUP BY object, clip, run
), texts AS (SELECT object, clip, string_agg(length::VARCHAR, ', ' ORDER BY run) AS counts, min(run) AS first FROM runs GROUP BY object, clip)
SELECT (clip % 3)::VARCHAR AS video_id, clip::VARCHAR AS clip_id, object AS frame_index, '{{"size": [8, 8], "counts": [' || CASE WHEN first = 1 THEN '0, ' ELSE '' END || counts || ']}}' AS mask_rle FROM texts""",
    "meta_files": "SELECT 'r' AS run_id, n_regionkey::VARCHAR AS video_id, 'c' || n_nationkey::VARCHAR AS clip_id, (n_nationkey * 30)::INT AS frame_start, '/é.mp4' AS video_path, true AS ascii FROM nation",
    "file_checksums": "SELECT r_regionkey::INT AS r_regionkey, sha256(r_name || chr(10)) AS checksum FROM region",
    "file_discovery": "SELECT r_regionkey::INT AS r_regionkey, (length(r_name) + 1)::BIGINT AS length FROM region WHERE r_regionkey BETWEEN 1 AND 3",
    "json_ascii": """SELECT c_custkey, '{"a":"' || c_name || '-\\u00e9\\n\\ud835\\udd18\\""}' AS json FROM customer""",
    "config_gates": """SELECT r_regionkey::INT AS r_regionkey, operator, CASE WHEN pos = r_regionkey % 5 THEN r_regionkey % 2 = 0 ELSE pos = 0 END AS enabled, r_regionkey::DOUBLE AS nms_iou, r_name AS prompt_text, 60 AS max_prompts
FROM region, (VALUES ('sam2', 0), ('hamer', 1), ('foundationpose', 2), ('dex_retarget', 3), ('fast3r', 4)) t(operator, pos)""",
}
