"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes a finished query's shuffle files; on while an intermediate table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """A folder of the application's own under spark.checkpoint.dir.

    Where that is unset a local one is named, which only a local master can use; any other master is an error, as each
    executor would write to a disk of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share")
        found = f"file://{tempfile.mkdtemp(prefix='clipwright-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/clipwright/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and a lost executor costs no recomputation.

    The tables stay until `discard` or until the application's folder is removed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, was) if was is not None else spark.conf.unset(CLEANUP)
    found = spark.read.schema(df.schema).parquet(path)
    found._scratch_path = path
    return found


def discard(*tables: DataFrame) -> None:
    """Remove materialised tables that no later query reads."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
