"""What the operators share: word rules and lookups that skewed keys do not slow; tables in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.scratch import discard, materialize, shared_dir

__all__ = ["WORD", "discard", "distribute", "materialize", "per_tile", "row_hash", "set_aside", "shared_dir", "skew_safe_lookup", "word_count"]

#: A word is a longest run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def set_aside(docs: DataFrame, **columns: Column) -> DataFrame:
    """docs with its columns renamed c0, c1 ... and further ones added, so that no name of docs can clash with them."""
    return docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)], *[v.alias(n) for n, v in columns.items()])


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that can be hashed: rows that tie in it are alike, so reruns choose alike."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])


def skew_safe_lookup(rows: DataFrame, table: DataFrame, key: str, size: str, share: int = 1000) -> DataFrame:
    """Inner join of rows with table (unique, non-null key), where table[size] counts the rows of each key.

    Keys with more than one `share`-th of all rows number fewer than `share`, so that part of the table is broadcast
    under a proven bound; all other keys go through an ordinary shuffled join, where none can fill a task.
    """
    total = table.agg(F.sum(size)).head()[0] or 0
    hot, cold = table.where(F.col(size) * share > total), table.where(F.col(size) * share <= total)
    marked = rows.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), key, "left")
    found = marked.where("__hot").drop("__hot")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return found.unionByName(rest)


def distribute(spark: SparkSession, pieces: Iterable[bytes], kind: str) -> str:
    """Write one file, piece by piece, to the shared folder and have Spark hand it to the executors, each of which keeps a
    copy on its disk; returns its name there, for SparkFiles.get."""
    name, jvm = f"{uuid.uuid4().hex}.{kind}", spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/files/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    for piece in pieces:
        for k in range(0, len(piece), 1 << 24):
            out.write(bytearray(piece[k : k + (1 << 24)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def per_tile(rows: DataFrame, tile: str, tiles: int, work: Callable[[list[dict]], pa.RecordBatch | None], schema: str, each: int = 8) -> DataFrame:
    """work's results over the rows of each tile; tiles are numbered from 0 and dealt to tasks by number, about `each` to
    a task, so that no task gets many more than another. Tiles are of bounded size, as are the rows of one task."""
    parts = max(rows.sparkSession.sparkContext.defaultParallelism * 2, min(20_000, tiles // each))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(c)[k].as_py() for c, name in enumerate(batch.schema.names)}
                if held and held[0][tile] != row[tile]:
                    done = work(held)
                    if done is not None:
                        yield done
                    held = []
                held.append(row)
        if held:
            done = work(held)
            if done is not None:
                yield done

    return rows.repartitionById(parts, F.pmod(F.col(tile), F.lit(parts)).cast("int")).sortWithinPartitions(tile).mapInArrow(run, schema)
