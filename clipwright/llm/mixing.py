"""Mixing sources to target weights: fixed-length blocks of words, drawn per output shard, found by permuted index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.llm.permute import permute, round_keys
from clipwright.llm.shared import WORD, materialize, set_aside, word_count

#: Weights of the sources by code point, null last; they repeat.
WEIGHTS = (3, 1, 2)
#: Words of the whole mix for each word of the input.
SHARE = 1.5
#: No source and no document is taken more often than this.
REPEATS = 2
#: Slots that one row of the plan stands for before they are expanded, and that one task expands.
CHUNK, TASK = 1 << 16, 1 << 18
#: Words of the shortest and the longest block, and about how many blocks a source has in between.
LEAST, MOST, BLOCKS = 32, 4096, 1 << 14
#: Rows that one task places in order.
SEGMENT = 50_000
#: Segments that the rows of a very frequent doc_id and size are dealt to.
SALTS = 256


def targets(sizes: list[tuple[str | None, int]], weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> dict[str | None, float]:
    """Words to take of each source: by weight, at most `repeats` times its size, the excess shared out again."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {name: weights[k % len(weights)] for k, (name, _) in enumerate(order)}
    size, found = dict(order), {}
    left, free = share * sum(size.values()), list(size)
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > repeats * size[s]]
        if not full:
            return found | {s: unit * weight[s] for s in free}
        for s in full:
            found[s] = float(repeats * size[s])
            left -= found[s]
        free = [s for s in free if s not in found]
    return found


def draw(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Slots of each source (columns) in each shard (rows): multinomial draws by what is left of the quotas.

    A draw beyond a quota is cut and drawn again, so the columns sum to the quotas and no source is overdrawn.
    """
    left, out = quotas.astype(np.int64).copy(), np.zeros((shards, len(quotas)), np.int64)
    for j in range(shards):
        need = -(-int(left.sum()) // (shards - j))
        rng = np.random.default_rng([seed, j])
        while need:
            got = np.minimum(rng.multinomial(need, left / left.sum()), left)
            out[j] += got
            left -= got
            need -= int(got.sum())
    return out


def block_size(size: int) -> int:
    """Words of a block of a source: a power of two, so that a small source comes near its target and a large one has
    no more rows to draw than it needs."""
    return min(MOST, max(LEAST, 1 << max(0, (size // BLOCKS).bit_length() - 1)))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, uid: str | None = None) -> DataFrame:
    """(uid, doc_id, source, size), one row per input row."""
    key = F.col(uid) if uid else F.monotonically_increasing_id()
    return materialize(docs.select(key.alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")), "mix-sizes")


def mix(rows: DataFrame, *, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, block_words: int | None = None, shards: int = 64, seed: int = 17, hot_rows: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """rows: (uid, doc_id, source, size), reread often. Returns (sources, pieces).

    sources: source, source_size, target. pieces: shard, slot, source_index, block, repeat, uid, start, words: the run
    of `words` words from `start` on of row uid, in the order of the mix. A source's rows follow one another in
    an order of their doc_id and size alone and are cut into blocks of block_words words, by default those that
    block_size gives for the source (the last may be shorter). Slot k of a source holds block permutation(k mod blocks)
    of its (k div blocks)-th pass, so within a pass no block comes twice, and a block's use differs by at most one from
    any other's. Empty sources and texts take nothing. Rows alike in source, doc_id and size, of which there are over
    `hot_rows` and a thousandth of all, are placed by several tasks.
    """
    spark = rows.sparkSession
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()  # a row per source
    wanted = targets([(r["source"], r["size"]) for r in totals], weights, share, repeats)
    order = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    schema = "source_index int, source string, source_size long, target double, block_words int"
    lengths = [block_words or block_size(r["size"]) for r in order]
    sources = spark.createDataFrame([(k, r["source"], r["size"], float(wanted[r["source"]]), lengths[k]) for k, r in enumerate(order)], schema)

    blocks = np.array([-(-r["size"] // n) for r, n in zip(order, lengths)], np.int64)
    quotas = np.array([round(wanted[r["source"]] * b / r["size"]) if b else 0 for r, b in zip(order, blocks)], np.int64)
    drawn = draw(quotas, shards, seed)
    first = np.cumsum(drawn, axis=0) - drawn
    slot0 = np.cumsum(drawn, axis=1) - drawn
    plan = [(j, k, int(first[j, k]), int(drawn[j, k]), int(slot0[j, k]), int(blocks[k])) for j in range(shards) for k in range(len(order)) if drawn[j, k]]
    plan = spark.createDataFrame(plan, "shard int, source_index int, first long, n long, slot0 long, blocks long")
    plan = plan.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(CHUNK).cast("long"))))

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                k = np.arange(r.at, min(r.n, r.at + CHUNK))
                turn, place = np.divmod(r.first + k, r.blocks)
                block = np.empty_like(place)
                for t in np.unique(turn):
                    block[turn == t] = permute(place[turn == t], int(r.blocks), round_keys(seed, r.source_index, int(t)))
                yield pd.DataFrame({"shard": r.shard, "slot": r.slot0 + k, "source_index": r.source_index, "block": block, "repeat": turn})

    slots = plan.repartition(max(spark.sparkContext.defaultParallelism * 2, int(drawn.sum()) // TASK)).mapInPandas(expand, "shard int, slot long, source_index int, block long, repeat long")

    some = sum(r["n"] for r in totals)
    segments = max(256, some // SEGMENT)
    segment = F.pmod(F.xxhash64("doc_id", "size"), F.lit(segments))
    placed = rows.where("size > 0").join(sources.select("source_index", "block_words", F.col("source").alias("__s")), F.col("source").eqNullSafe(F.col("__s")))
    placed = placed.select("source_index", "block_words", segment.alias("segment"), "uid", "doc_id", "size")
    bound, key = max(hot_rows, some // 1000), ["source_index", "doc_id", "size"]
    full = placed.groupBy("source_index", "segment").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound).drop("n")  # under 1000 rows
    hot = placed.join(F.broadcast(full), ["source_index", "segment"]).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound).collect()
    if hot:  # segments of their own, after the others; the rows of one key stay together, so their places do not depend on the salt
        hot = sorted(hot, key=lambda r: (r["source_index"], r["doc_id"] is None, r["doc_id"] or 0, r["size"]))
        named = spark.createDataFrame([(r["source_index"], r["doc_id"], r["size"], segments + k * SALTS) for k, r in enumerate(hot)], "s int, d long, z long, own long")
        met = (F.col("source_index") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z"))
        own = F.coalesce(F.col("own") + F.pmod(F.xxhash64("uid"), F.lit(SALTS)), F.col("segment"))
        placed = placed.join(F.broadcast(named), met, "left").withColumn("segment", own).drop("s", "d", "z", "own")
    inner = Window.partitionBy("source_index", "segment").orderBy("doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy("source_index").orderBy("segment").rowsBetween(Window.unboundedPreceding, 0)
    bases = placed.groupBy("source_index", "segment").agg(F.sum("size").alias("n")).withColumn("base", F.sum("n").over(outer) - F.col("n"))
    run = placed.withColumn("before", F.sum("size").over(inner) - F.col("size")).join(bases, ["source_index", "segment"]).withColumn("from", F.col("base") + F.col("before"))
    cut = F.sequence(F.expr("`from` div block_words"), F.expr("(`from` + size - 1) div block_words"))
    cut = run.select("source_index", "block_words", "uid", "from", "size", F.explode(cut).alias("block"))
    low = F.greatest(F.col("from"), F.col("block") * F.col("block_words"))
    high = F.least(F.col("from") + F.col("size"), (F.col("block") + 1) * F.col("block_words"))
    cut = cut.select("source_index", "block", "uid", (low - F.col("from")).alias("start"), (high - low).alias("words"))
    pieces = slots.join(cut.hint("merge"), ["source_index", "block"]).select("shard", "slot", "source_index", "block", "repeat", "uid", "start", "words")
    return sources.drop("source_index", "block_words"), pieces


def mix_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target (its source's), taken: words the mix takes of it.

    Null texts have no words; a null source is a source of its own, last in order. Rows that repeat a doc_id are rows
    of their own. An empty table gives an empty result, and one without words takes nothing.
    """
    rows = sized(docs, id_col, text_col, source_col)
    sources, pieces = mix(rows, **options)
    taken = pieces.groupBy("uid").agg(F.sum("words").alias("taken"))
    whole = rows.join(sources.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).join(taken.hint("merge"), "uid", "left")
    return whole.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as documents, with docs' columns: a row for each pass that takes words of a row of docs.

    Its text is the words taken in that pass, in their order, joined by one space; a text taken whole stays as it was.
    A column n_chars, if there is one, is the new text's length. Rows of which nothing is taken are left out, as are
    null and wordless texts. A null source is a source of its own; rows that repeat a doc_id are rows of their own; an
    empty table gives an empty one. Other columns come back as they were, whatever their names.
    """
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    text = names[text_col]
    keyed = materialize(set_aside(docs, uid=F.monotonically_increasing_id()), "mix-documents")
    rows = sized(keyed, names[id_col], text, names[source_col], "uid")
    _, pieces = mix(rows, **options)
    runs = pieces.groupBy("uid", "repeat").agg(F.sort_array(F.collect_list(F.struct("start", "words"))).alias("runs"), F.sum("words").alias("taken"))
    met = keyed.join(runs, "uid").join(rows.select("uid", "size"), "uid")
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    part = F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(words, r["start"].cast("int") + 1, r["words"].cast("int")))), " ")
    met = met.withColumn(text, F.when(F.col("taken") < F.col("size"), part).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        met = met.withColumn(names["n_chars"], F.length(text).cast(docs.schema["n_chars"].dataType))
    return met.select(*[F.col(n).alias(c) for c, n in names.items()])
