"""Reading manifests and finding video files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file held at a time.
CHUNK = 1 << 20


def read_manifest(spark: SparkSession, path: str, schema: str, ordinal: bool = False) -> DataFrame:
    """Parquet by its suffix, otherwise JSON lines; blank lines are skipped, a malformed one is an error.

    ordinal adds a column of that name that orders rows as they stand: by file name, then place in the file. Spark packs
    files into tasks by size, so the order of its tasks says nothing.
    """
    if path.rstrip("/").endswith(".parquet"):
        found = spark.read.schema(schema).parquet(path)
    else:
        found = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if not ordinal:
        return found
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return found.select("*", place.alias("ordinal"))


def glob_pattern(glob: str) -> str:
    """A path glob as a regular expression: ** stands for any number of folders, * and ? for what lies within a name."""
    parts = re.split(r"(\*\*/|\*\*|\*|\?|\[[^\]]+\])", glob)
    plain = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    return "^" + "".join(plain.get(p) or (p.replace("[!", "[^", 1) if p.startswith("[") and p.endswith("]") and len(p) > 2 else re.escape(p)) for p in parts) + "$"


def discover(spark: SparkSession, root: str, glob: str = "**/*.mp4") -> DataFrame:
    """Files below root whose path from there matches the glob: path, length; contents aren't read. In no order: sort
    where order matters."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(root)
    base = place.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")  # noqa: E731  file:///x and file:/x are one
    below = F.expr("substring(p, length(b) + 1)")
    rows = found.select("path", "length", plain(F.col("path")).alias("p"), plain(F.lit(base)).alias("b"))
    return rows.where(below.rlike(glob_pattern(glob))).select("path", "length")


def checksums(spark: SparkSession, root: str, glob: str = "**/*.mp4") -> DataFrame:
    """path, checksum: the SHA-256 of each file, read in pieces by the workers, whatever its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            sums = []
            for uri in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
                digest = hashlib.sha256()
                with store.open_input_stream(path) as stream:
                    while piece := stream.read(CHUNK):
                        digest.update(piece)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.string())], ["path", "checksum"])

    return discover(spark, root, glob).select("path").mapInArrow(run, "path string, checksum string")
