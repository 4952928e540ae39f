"""Token shards in training order: a keyed permutation gives every sequence its global slot, ranges of slots are shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.permute import permute, round_keys
from clipwright.llm.shared import materialize
from clipwright.llm.tokens import END, encode, vocabulary_path

#: Bytes of text whose sequences one task puts in order, up to 65,536 tasks.
SEGMENT = 1 << 24

SHARD = "shard long, first_slot long, sequences long, stride int, payload binary, payload_crc32 long, doc_ids array<long>, parts array<int>, lengths array<int>"


def sequences(docs: DataFrame, id_col: str, text_col: str, length: int, vocabulary: str, width: int) -> DataFrame:
    """(doc_id, digest of the text, part, n, ids) of every row: its ids cut into sequences of `length`, the last padded
    with END, as little-endian unsigned integers of `width` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, digest, part, n, ids = [], [], [], [], []

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(digest, pa.int64()), pa.array(part, pa.int32()), pa.array(n, pa.int32()), pa.array(ids, pa.binary())], ["doc_id", "digest", "part", "n", "ids"])

            for doc_id, text, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                whole = encode(text.as_py(), vocabulary)
                if int(whole.max()) >> (8 * width):
                    raise ValueError(f"id {whole.max()} needs more than {width} bytes")
                padded = np.full(-(-len(whole) // length) * length, END, f"<u{width}")
                padded[: len(whole)] = whole
                for k in range(0, len(whole), length):
                    doc.append(doc_id)
                    digest.append(key)
                    part.append(k // length)
                    n.append(min(length, len(whole) - k))
                    ids.append(padded[k : k + length].tobytes())
                if len(doc) >= 4096:
                    yield out()
                    doc, digest, part, n, ids = [], [], [], [], []
            if doc:
                yield out()

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("digest")).mapInArrow(run, "doc_id long, digest long, part int, n int, ids binary")


def shards(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 512, vocabulary: str | None = None, width: int = 2, shard_rows: int = 2048, shards_per_task: int = 8, seed: int = 5) -> DataFrame:
    """One row per shard of `shard_rows` slots (the last may hold fewer), in training order: shard, first_slot,
    sequences, stride (bytes of a sequence), payload (the sequences end to end), payload_crc32, and for each slot
    doc_ids, parts (which sequence of the document) and lengths (its ids before the padding).

    Slot s lies in shard s div shard_rows at byte (s mod shard_rows) * stride: reads are sequential, and may resume at
    any slot. Slots are a Feistel permutation, keyed by `seed`, of the sequences' places in an order of doc_id, text and
    part alone: the same rows give the same shards, however they are scanned. Null is the empty
    text, and the empty text one sequence; rows that repeat a doc_id are sequences of their own; an empty table gives no
    shard. width 2 holds ids below 65,536 and a larger id is an error; give 4 for larger vocabularies.
    """
    spark = docs.sparkSession
    cut = sequences(docs, id_col, text_col, length, vocabulary or vocabulary_path(), width)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).head()[0] or 0
    segments = min(1 << 16, max(8, size // SEGMENT))
    dealt = cut.withColumn("segment", F.pmod(F.xxhash64("doc_id", "digest", "part"), F.lit(segments)).cast("int"))
    ordered = dealt.repartitionById(segments, F.col("segment")).sortWithinPartitions("segment", "doc_id", "digest", "part", "ids")
    stored = materialize(ordered.withColumn("place", F.monotonically_increasing_id()), "token-sequences")
    nth = F.col("place").bitwiseAND((1 << 33) - 1)
    counts = sorted(stored.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.max(nth).alias("last")).collect())  # a row per segment
    if any(r["last"] != r["n"] - 1 for r in counts):
        raise RuntimeError("a task wrote more than one segment")
    bases = list(zip((r["segment"] for r in counts), np.cumsum([0, *(r["n"] for r in counts)]).tolist()))
    total = sum(r["n"] for r in counts)
    based = spark.createDataFrame(bases or [(0, 0)], "segment int, base long")
    keys = round_keys(seed)

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = permute(batch.column(0).to_numpy(), total, keys)
            yield pa.RecordBatch.from_arrays([pa.array(slots), *batch.columns[1:]], ["slot", *batch.schema.names[1:]])

    indexed = stored.join(F.broadcast(based), "segment").select((F.col("base") + nth).alias("index"), "doc_id", "part", "n", "ids")
    placed = indexed.mapInArrow(slot, "slot long, doc_id long, part int, n int, ids binary")
    run = shard_rows * shards_per_task
    ranged = placed.repartitionById(max(1, -(-total // run)), F.floor(F.col("slot") / run).cast("int")).sortWithinPartitions("slot")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        schema = pa.schema([("shard", pa.int64()), ("first_slot", pa.int64()), ("sequences", pa.int64()), ("stride", pa.int32()), ("payload", pa.binary()), ("payload_crc32", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32()))])

        def shard(table: pa.Table) -> pa.RecordBatch:
            first = table.column("slot")[0].as_py()
            payload = b"".join(table.column("ids").to_pylist())
            row = [first // shard_rows, first, len(table), length * width, payload, zlib.crc32(payload), *(table.column(c).to_pylist() for c in ("doc_id", "part", "n"))]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while len(held):
                n = int(np.searchsorted(held.column("slot").to_numpy() // shard_rows, held.column("slot")[0].as_py() // shard_rows, side="right"))
                if n == len(held):
                    break
                yield shard(held[:n])
                held = held[n:]
        if held is not None and len(held):
            yield shard(held)

    return ranged.mapInArrow(write, SHARD)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shards to a folder, one file for each run of shards, in any store Spark can write."""
    shards(docs, **options).write.option("compression", "zstd").parquet(path)


def read_from(found: DataFrame, slot: int = 0, *, shard_rows: int = 2048) -> DataFrame:
    """(slot, doc_id, part, length, ids) of the sequences from a slot on, in training order; earlier shards aren't read."""
    rows = found.where(F.col("shard") >= slot // shard_rows)
    at = rows.select("*", F.posexplode(F.arrays_zip("doc_ids", "parts", "lengths")).alias("k", "s"))
    ids = F.substring("payload", F.col("k") * F.col("stride") + 1, F.col("stride"))
    return at.select((F.col("first_slot") + F.col("k")).alias("slot"), F.col("s.doc_ids").alias("doc_id"), F.col("s.parts").alias("part"), F.col("s.lengths").alias("length"), ids.alias("ids")).where(F.col("slot") >= slot).orderBy("slot")
