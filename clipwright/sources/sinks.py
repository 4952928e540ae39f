"""Writing artifacts: one partitioned table per kind, rewritten per clip, empty results included."""

from __future__ import annotations

import json
import time
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright import schemas
from clipwright.functions.text import ascii_only
from clipwright.plans.config import CoordinateSpec, ParquetConfig

KEYS = ("run_id", "video_id", "clip_id")


def _same(a: str, b: str):
    """Keys alike in two tables, by their aliases; nulls are a key like any other."""
    return reduce(and_, (F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in KEYS))


def write_artifact(rows: DataFrame, clips: DataFrame, root: str, name: str, parquet: ParquetConfig = ParquetConfig()) -> None:
    """Replace what the table `name` holds of the clips (run_id, video_id, clip_id) by rows; other clips stay.

    A clip that now has no rows keeps its old files, as an overwrite of partitions only touches those it writes. The
    table artifact_index says how many rows each clip had when last written, and readers go by that.
    """
    counts = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    index = clips.select(*KEYS).distinct().alias("c").join(counts.alias("r"), _same("c", "r"), "left").select(*(f"c.{k}" for k in KEYS), F.lit(name).alias("artifact"), F.coalesce("n", F.lit(0)).cast("long").alias("row_count"), F.lit(time.time()).alias("written_at"))
    rows.write.mode("overwrite").options(**parquet.options()).option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(f"{root}/{name}")
    index.write.mode("append").parquet(f"{root}/artifact_index")


def read_artifact(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The table as last written, with its keys as strings."""
    keys = ", ".join(f"{k} string" for k in KEYS)
    index = spark.read.schema(f"{keys}, artifact string, row_count long, written_at double").parquet(f"{root}/artifact_index").where(F.col("artifact") == name)
    last = index.groupBy(*KEYS).agg(F.max_by("row_count", "written_at").alias("n")).where("n = 0")
    return spark.read.schema(f"{schema}, {keys}").parquet(f"{root}/{name}").alias("a").join(last.alias("i"), _same("a", "i"), "left_anti")


def write_json(spark: SparkSession, path: str, payload: dict) -> None:
    """One small document, ASCII, indented by two, put in place by a rename."""
    jvm = spark.sparkContext._jvm
    target, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, path + ".tmp"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(payload, ensure_ascii=True, indent=2).encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(new, target)


def write_json_lines(rows: DataFrame, path: str) -> None:
    """Null columns are written, as they are in memory; all is ASCII."""
    rows.select(ascii_only(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).alias("value")).write.mode("overwrite").text(path)


def meta_documents(tasks: DataFrame, fields: dict[str, str], mask_encoding: str = "rle", time_base: str = "seconds") -> DataFrame:
    """clip_id and the JSON text that describes a clip's artifacts."""
    about = F.struct(F.struct(*tasks.columns).alias("clip"), F.create_map(*[F.lit(x) for kv in fields.items() for x in kv]).alias("field_specs"), F.lit(mask_encoding).alias("mask_encoding"), F.lit(time_base).alias("time_base"))
    return tasks.select("clip_id", ascii_only(F.to_json(about, {"ignoreNullFields": "false"})).alias("meta"))


def write_meta(tasks: DataFrame, clips: DataFrame, root: str, coordinates: CoordinateSpec = CoordinateSpec(), files: int = 8) -> None:
    """A JSON document for each clip, below its folder of the table `meta`; other clips stay."""
    rows = meta_documents(tasks, schemas.FIELDS, coordinates.mask_encoding, coordinates.time_base).join(clips, "clip_id")
    rows.select(*KEYS, F.col("meta").alias("value")).repartition(files, "clip_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).text(f"{root}/meta")
