"""Domain tables as views over the driver's star schema: videos, clips, boxes, state events, mask planes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FPS = (24.0, 25.0, 30.0, 60.0)
STATUSES = {"signup": "Pending", "view": "Running", "click": "Writing", "purchase": "Done", "error": "Failed"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("video_id"),
        F.concat(F.lit("/data/"), key.cast("string"), F.lit(".mp4")).alias("path"),
        F.element_at(F.array(*map(F.lit, FPS)), F.pmod(key, F.lit(4)).cast("int") + 1).alias("fps"),
        (F.lit(60.0) + F.pmod(key, F.lit(61))).cast("double").alias("duration_s"),
    )


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_quantity").cast("double")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("video_id"), start.alias("start_s"), (start + F.col("l_linenumber") * 1.5).alias("end_s"),
        F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """frame_key, ord (a total order within the frame), x1..y2, score, phrase."""
    from pyspark.sql.window import Window

    x1, y1 = (F.col("l_partkey") % 200).cast("double"), (F.col("l_suppkey") % 100).cast("double")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_key"), x1.alias("x1"), y1.alias("y1"), (x1 + 20 + F.col("l_quantity")).alias("x2"), (y1 + 20 + F.col("l_quantity")).alias("y2"),
        (F.col("l_discount") + 0.0).alias("score"), F.col("l_returnflag").alias("phrase"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    )
    order = Window.partitionBy("frame_key").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "score", "phrase")
    return rows.withColumn("ord", F.row_number().over(order)).select("frame_key", "ord", "x1", "y1", "x2", "y2", "score", "phrase")


def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, clip_key, video_id, status, last_error, retry_count, updated_at (seconds)."""
    kind = F.col("event_type")
    status = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in STATUSES.items()])
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("clip_key"), (F.col("event_id") % 97).alias("video_id"), status.alias("status"),
        F.when(kind == "error", F.concat(F.lit("e"), F.col("event_id").cast("string"))).otherwise(F.lit("")).alias("last_error"),
        (F.col("event_id") % 5).cast("int").alias("retry_count"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("updated_at"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clip, object, plane: 8 x 8 values, row by row."""
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("clip"), F.col("vec_id").alias("object"), F.col("embedding").alias("plane"))


#: The same tables for DuckDB, as common table expressions.
SQL = {
    "videos": """videos AS (
  SELECT o_orderkey AS video_id, '/data/' || o_orderkey::VARCHAR || '.mp4' AS path,
         (CASE o_orderkey % 4 WHEN 0 THEN 24.0 WHEN 1 THEN 25.0 WHEN 2 THEN 30.0 ELSE 60.0 END)::DOUBLE AS fps,
         (60 + o_orderkey % 61)::DOUBLE AS duration_s FROM orders)""",
    "clips": """clips AS (
  SELECT l_orderkey AS video_id, l_quantity::DOUBLE AS start_s, l_quantity + l_linenumber * 1.5::DOUBLE AS end_s,
         l_linenumber AS line, l_partkey AS part, l_suppkey AS supp FROM lineitem)""",
    "boxes": """boxes AS (
  SELECT l_orderkey AS frame_key, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount + 0.0, l_returnflag)::INT AS ord,
         (l_partkey % 200)::DOUBLE AS x1, (l_suppkey % 100)::DOUBLE AS y1, (l_partkey % 200) + 20 + l_quantity AS x2, (l_suppkey % 100) + 20 + l_quantity AS y2,
         l_discount + 0.0 AS score, l_returnflag AS phrase FROM lineitem)""",
    "state_events": """state_events AS (
  SELECT event_id AS seq, user_id AS clip_key, event_id % 97 AS video_id,
         CASE event_type WHEN 'signup' THEN 'Pending' WHEN 'view' THEN 'Running' WHEN 'click' THEN 'Writing' WHEN 'purchase' THEN 'Done' WHEN 'error' THEN 'Failed' END AS status,
         CASE WHEN event_type = 'error' THEN 'e' || event_id::VARCHAR ELSE '' END AS last_error,
         (event_id % 5)::INT AS retry_count, epoch_us(ts) / 1e6 AS updated_at FROM events)""",
    "logits": "logits AS (SELECT label::BIGINT AS clip, vec_id AS object, embedding AS plane FROM embeddings)",
}


def with_(*names: str, recursive: bool = False) -> str:
    return "WITH " + ("RECURSIVE " if recursive else "") + ",\n".join(SQL[n] for n in names)
