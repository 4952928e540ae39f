"""Best-fit packing by a configuration linear program over the length histogram.

A configuration is a multiset of lengths that fits one sequence. The program covers the histogram with as few
configurations as it can; multiplicative weights solve it, an unbounded-knapsack dynamic program being the pricing, and
the solution is rounded down and its rest placed by best fit, all on counts of lengths: the work depends on the number
of lengths (at most the capacity), never on the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.llm.shared import materialize
from clipwright.llm.tokens import crc, encode, vocabulary_path


def knapsack(prices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: the most that lengths summing to c or less are worth; take[c]: a length in such a choice (0: none)."""
    capacity = len(prices) - 1
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    backward = np.zeros(capacity + 1)  # backward[capacity - c] = best[c]
    for c in range(1, capacity + 1):
        worth = prices[1 : c + 1] + backward[capacity - c + 1 :][:c]
        k = int(worth.argmax())
        if worth[k] > 0:
            best[c], take[c] = worth[k], k + 1
        backward[capacity - c] = best[c]
    return best, take


def fractional(counts: np.ndarray, rounds: int, slack: float, pace: float) -> dict[tuple[int, ...], float]:
    """Configurations and how often to use each, covering counts about evenly."""
    capacity = len(counts) - 1
    support = np.nonzero(counts)[0]
    demand = counts[support].astype(float)
    covered, use = np.zeros(len(support)), {}
    at = np.full(capacity + 1, -1)
    at[support] = np.arange(len(support))
    for _ in range(rounds):
        prices = np.full(capacity + 1, -1.0)
        prices[support] = np.exp(-pace * (covered - covered.min())) * support  # a token is worth more where less is covered
        best, take = knapsack(prices)
        good = [l for l in support.tolist() if prices[l] + best[capacity - l] >= (1 - slack) * best[capacity]]
        columns = {}
        for l in good:
            chosen, room = [l], capacity - l
            while room and take[room]:
                chosen.append(int(take[room]))
                room -= chosen[-1]
            columns[tuple(sorted(chosen, reverse=True))] = 0.0
        added = np.zeros(len(support))
        for c in columns:
            lengths, times = np.unique(np.array(c), return_counts=True)
            columns[c] = float((demand[at[lengths]] / times).min())
            added[at[lengths]] += columns[c] * times
        step = 1 / (pace * float((added / demand).max()))
        covered += step * added / demand
        for c, x in columns.items():
            use[c] = use.get(c, 0.0) + step * x
    scale = 1 / float(np.average(covered, weights=demand * support))
    return {c: x * scale for c, x in use.items()}


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: bins of equal content are one entry."""
    capacity = len(counts) - 1
    bins: dict[int, dict[tuple[int, ...], int]] = {}  # by room left
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = next((r for r in range(length, capacity) if bins.get(r)), capacity)
            if room == capacity:  # open as many bins as are needed when each takes as many as fit
                each = min(capacity // length, left)
                content, n = (length,) * each, left // each
                left -= n * each
            else:
                old, there = next(iter(bins[room].items()))
                each = min(room // length, left)
                n = min(there, left // each)
                content = (*old, *(length,) * each)
                left -= n * each
                if there == n:
                    del bins[room][old]
                else:
                    bins[room][old] = there - n
            entry = bins.setdefault(capacity - sum(content), {})
            entry[content] = entry.get(content, 0) + n
    return [(content, n) for entry in bins.values() for content, n in entry.items()]


def plan(counts: np.ndarray, rounds: int = 150, slack: float = 0.02, pace: float = 12.0) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and how many sequences hold each; every length l occurs counts[l] times in all.

    Each round prices one best configuration around every length, so there are at most rounds * capacity of them.
    """
    left = np.asarray(counts, np.int64).copy()
    if not left.any():
        return []
    chosen = []
    solution = fractional(left, rounds, slack, pace)
    for content, x in sorted(solution.items(), key=lambda i: (-sum(i[0]), -i[1], i[0])):
        lengths, times = np.unique(np.array(content), return_counts=True)
        n = int(min(np.floor(x + 0.5), (left[lengths] // times).min()))
        if n:
            left[lengths] -= n * times
            chosen.append((content, n))
    return chosen + best_fit(left)


def places(chosen: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset), sorted: where the pieces of each length go by rank."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for content, n in chosen:
        offset = 0
        for length in content:
            rows.append((length, rank.get(length, 0), base, offset))
            rank[length] = rank.get(length, 0) + n
            offset += length
        base += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, the first piece taking the remainder."""
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], len(ids)])]


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, vocabulary: str, keep_ids: bool) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row, tokenised once, in no order."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py(), vocabulary)
                for k, (start, length) in enumerate(cut(ids, capacity)):
                    part = ids[start : start + length]
                    rows.append((doc_id, k, start, length, crc(part)) + (part.tobytes(),) * keep_ids)
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ddl)


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with keep_ids).

    Each document's ids end with id 2; null text is empty and gives that id alone. Only documents beyond `capacity` ids
    are cut. Within a sequence the pieces lie without gaps from 0 on. Rows that repeat a doc_id are packed one by one;
    an empty table gives an empty result. Sequence ids run from 0 without gaps.
    """
    spark = docs.sparkSession
    cutup = pieces(docs, id_col, text_col, capacity, vocabulary or vocabulary_path(), keep_ids)
    stored = materialize(cutup.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in stored.groupBy("length").count().collect():  # a row per length
        counts[length] = n
    table = spark.sparkContext.broadcast(places(plan(counts)))  # bounded by the rounds and the number of lengths, some 200,000 rows

    segments = max(256, int(counts.sum()) // 100_000)
    dealt = stored.withColumn("segment", F.pmod(F.xxhash64("uid"), F.lit(segments)))
    inner = Window.partitionBy("length", "segment").orderBy("uid")
    outer = Window.partitionBy("length").orderBy("segment").rowsBetween(Window.unboundedPreceding, 0)
    bases = dealt.groupBy("length", "segment").agg(F.count(F.lit(1)).alias("n")).select("length", "segment", (F.sum("n").over(outer) - F.col("n")).alias("base"))
    ranked = dealt.withColumn("nth", F.row_number().over(inner) - 1).join(bases, ["length", "segment"]).withColumn("rank", F.col("base") + F.col("nth"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = stored.select(*columns).schema.add("sequence_id", "long").add("offset", "long")

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = table.value
        span = int(rows[:, 1].max()) + 1 if len(rows) else 1
        keys = rows[:, 0] * span + rows[:, 1]
        for batch in batches:
            rank = batch["rank"].to_numpy()
            k = np.searchsorted(keys, batch["length"].to_numpy() * span + np.minimum(rank, span - 1), side="right") - 1
            out = batch[columns].copy()
            out["sequence_id"], out["offset"] = rows[k, 2] + rank - rows[k, 1], rows[k, 3]
            yield out

    return ranked.select(*columns, "rank").mapInPandas(settle, schema)
