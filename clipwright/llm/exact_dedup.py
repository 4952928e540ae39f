"""Exact duplicates by skew-safe combining: local, salted, then global, full texts compared at every stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.llm.shared import materialize, row_hash, set_aside, skew_safe_lookup


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def combined(rows: DataFrame, salts: int) -> DataFrame:
    """One row per distinct (digest, text): the largest doc_id and the number of rows.

    Spark's map-side aggregation drops copies within each task; groups then merge under a salt taken from the task, so
    one text meets in at most `salts` places with one row per task, and the salts' winners combine last.
    """
    salted = rows.withColumn("salt", F.spark_partition_id() % salts)
    merged = salted.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return merged.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, salts: int = 16) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when all their characters are; null counts as the empty text. Of a group, the rows with the largest
    doc_id stay (null ids rank below all others); rows that repeat both id and text are one document and share the
    verdict. An empty table gives an empty result; columns other than the two named are never looked at.
    `digest` only deals rows out: texts that share a digest by chance are told apart by their content.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    groups = materialize(combined(rows, salts).select("digest", "keep_id", "group_size"), "exact-groups")
    clashes = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    light = rows.select("doc_id", "digest", sha256(F.col("text")).alias("text_sha256"))
    if clashes.head(1):  # distinct texts under one digest: these few are grouped by their text alone
        clashes = materialize(clashes, "exact-clashes")
        mixed = rows.join(clashes, "digest", "left_semi")
        by_text = combined(mixed, salts).drop("digest")
        apart = mixed.select("doc_id", "text", sha256(F.col("text")).alias("text_sha256")).join(by_text, "text").drop("text")
        light, groups = light.join(clashes, "digest", "left_anti"), groups.join(clashes, "digest", "left_anti")
        found = skew_safe_lookup(light, groups, "digest", "group_size").drop("digest").unionByName(apart)
    else:
        found = skew_safe_lookup(light, groups, "digest", "group_size")
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """docs with one row left of each group of equal texts, the one with the largest doc_id; all columns as they came,
    whatever their names.

    Null counts as the empty text, and null ids rank below all others. Of rows alike in doc_id and text one stays,
    chosen by a hash of all columns. An empty table gives an empty one.
    """
    doc_id, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), sha256(text).alias("digest"))
    stay = materialize(combined(rows, salts).select(F.col("digest").alias("stay"), F.col("keep_id").alias("stay_id")), "exact-stay")
    plan = set_aside(docs, id=doc_id, digest=sha256(text), order=row_hash(docs))
    met = plan.join(stay, (F.col("digest") == F.col("stay")) & F.col("id").eqNullSafe(F.col("stay_id")), "left_semi")
    once = F.row_number().over(Window.partitionBy("id", "digest").orderBy("order"))
    met = met.withColumn("nth", once).where("nth = 1")
    return met.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
