"""SimHash near-duplicates: fingerprints of 64 bits or a multiple compared exactly, tile against tile."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.llm.components import connected_components, merge_labels
from clipwright.llm.permute import mix64
from clipwright.llm.shared import materialize, per_tile, row_hash, set_aside, skew_safe_lookup

#: Cells of one exclusive-or matrix held at a time.
CELLS = 1 << 21
#: Pairs that one task compares at least, in small tiles.
TASK = 1 << 26
#: Shingles hashed at a time.
BLOCK = 1 << 16


def shingles(text: str | None, shingle_words: int) -> Iterator[np.ndarray]:
    """XXH64 of the text's shingles, block by block; a text of fewer words is one shingle, one without words none."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both touch ASCII only
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, BLOCK):
        yield np.array([digest(line[s:e], 42) for s, e in zip(starts[k : k + BLOCK], ends[k : k + BLOCK])], "<u8")


def vote(parts: Iterable[np.ndarray], width: int) -> np.ndarray:
    """SimHash of hashed shingles: the first word takes its votes from the hashes, further words from rehashes of them."""
    over, n = np.zeros((width, 64), np.int64), 0
    for part in parts:
        n += len(part)
        for w in range(width):
            votes = mix64(part + np.uint64(w)) if w else part
            over[w] += np.unpackbits(votes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(over * 2 > n, axis=1, bitorder="little").view("<u8")[:, 0]


def fingerprint(text: str | None, shingle_words: int = 3, width: int = 1) -> np.ndarray:
    """SimHash of a text as `width` unsigned 64-bit words; no words: zeros."""
    return vote(shingles(text, shingle_words), width)


def shingle_set(text: str | None, shingle_words: int) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted."""
    return np.unique(np.concatenate([*shingles(text, shingle_words), np.zeros(0, "<u8")]))


def shingle_sets(docs: DataFrame, *, shingle_words: int, width: int, whole: bool) -> DataFrame:
    """docs (doc_id, text, others) to (the others, doc_id, key: a digest of the set of shingles, fp and ones: the set's
    fingerprint and population count, size of the set, hashes: the set if `whole`, else null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets = [shingle_set(t.as_py(), shingle_words) for t in part.column("text")]
                fps = [vote([s], width) for s in sets]
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                ones = [int(np.bitwise_count(f).sum()) for f in fps]
                rest = [part.column(c) for c in others]
                yield pa.RecordBatch.from_arrays([*rest, part.column("doc_id"), pa.array(keys, pa.binary()), pa.array([f.astype(">u8").tobytes() for f in fps], pa.binary()), pa.array(ones, pa.int32()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() if whole else None for s in sets], pa.binary())], names)

    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    names = [*others, "doc_id", "key", "fp", "ones", "size", "hashes"]
    schema = docs.select(*others, "doc_id").schema.add("key", "binary").add("fp", "binary").add("ones", "integer").add("size", "long").add("hashes", "binary")
    return docs.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, width: int = 1) -> DataFrame:
    """(doc_id, fp: the fingerprint's words, big-endian, ones: its population count), one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words, width) for t in batch.column(1)]
            ones = [int(np.bitwise_count(f).sum()) for f in fps]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.astype(">u8").tobytes() for f in fps], pa.binary()), pa.array(ones, pa.int32())], ["doc_id", "fp", "ones"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp binary, ones int")


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int, first: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a, into b) of fingerprints (rows of words) that differ in at most `radius` bits, and at most
    `first` of them in the first word; same: a is b, each pair once."""
    step = max(1, CELLS // max(1, len(b)))
    lead = np.ascontiguousarray(b[:, 0])
    for k in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[k : k + step, :1] ^ lead) <= first)
        i += k
        if same:
            i, j = i[i < j], j[i < j]
        if a.shape[1] > 1 or first > radius:
            near = np.bitwise_count(a[i] ^ b[j]).sum(axis=1) <= radius
            i, j = i[near], j[near]
        if len(i):
            yield i, j


def counted(bits: list[int]) -> Column:
    """The population counts of a 64-bit fingerprint's sections, of so many bits each from the lowest up, as one number."""
    word, low, weight, code = F.conv(F.hex("fp"), 16, -10).cast("long"), 0, 1, F.lit(0)
    for n in bits:
        code = code + F.bit_count(F.shiftrightunsigned(F.shiftleft(word, 64 - low - n), 64 - n)) * weight
        low, weight = low + n, weight * (n + 1)
    return code.cast("int")


def sections(distinct: int) -> list[int]:
    """Bits of each section whose population count makes a cell: more sections leave fewer pairs, about 0.46, 0.22 and
    0.1 of all at a radius of 3, but more cells to fill."""
    return [64] if distinct < 1 << 15 else [32, 32] if distinct < 1 << 21 else [22, 21, 21]


def near_counts(codes: np.ndarray, bits: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in codes (ascending) whose sections' counts differ by at most `radius` in sum, a cell with itself
    included: fingerprints of other cells differ in more bits."""
    sizes = np.array(bits) + 1
    weights = np.concatenate(([1], np.cumprod(sizes[:-1])))
    counts = codes[:, None] // weights % sizes
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=len(bits)) if sum(map(abs, s)) <= radius and s >= (0,) * len(bits)]
    found = []
    for step in steps:  # one of each step and its opposite
        moved = counts + step
        at = np.nonzero(((moved >= 0) & (moved < sizes)).all(axis=1))[0]
        other = moved[at] @ weights
        place = np.minimum(np.searchsorted(codes, other), len(codes) - 1)
        met = codes[place] == other
        found.append((at[met], place[met]))
    return tuple(np.concatenate(f) for f in zip(*found))


def near_bands(codes: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in codes (ascending) at most `reach` apart, a cell with itself included."""
    return np.nonzero(np.triu(np.abs(codes[:, None] - codes) <= reach))


def linked(nodes: DataFrame, radius: int, tile_rows: int, near: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int = 1, first: int | None = None) -> DataFrame:
    """nodes (fp unique, cell, rep) to edges (a, b) between reps: a spanning forest of every compared pair of tiles' links.

    A tile holds fingerprints of one cell: population counts, or a band of them. near says which cells can hold
    fingerprints within the radius, and only their tiles meet; the pairs of tiles are dealt out by number, so that every
    task compares as many.
    """
    spark = nodes.sparkSession
    sizes = sorted(map(tuple, nodes.groupBy("cell").count().collect()))  # a row per cell, of which there are few thousand
    codes, counts = np.array([c for c, _ in sizes], np.int64), np.array([k for _, k in sizes], np.int64)
    n = -(-counts // max(tile_rows, min(1 << 16, int(counts.sum()) // 512)))
    a, b = near(codes)
    met = np.where(a == b, n[a] * (n[a] + 1) // 2, n[a] * n[b])
    start = np.cumsum(met) - met
    both = a != b
    roles = [(a[both], b[both], start[both], 0), (b[both], a[both], start[both], 1), (a[~both], a[~both], start[~both], 2)]
    meet = pa.table({"cell": np.concatenate([codes[own] for own, *_ in roles]), "others": np.concatenate([n[other] for _, other, *_ in roles]), "start": np.concatenate([s for *_, s, _ in roles]), "role": np.concatenate([np.full(len(own), r) for own, *_, r in roles])})
    cells = pa.table({"cell": codes, "tiles": n, "base": np.cumsum(n) - n})
    placed = nodes.join(F.broadcast(spark.createDataFrame(cells)), "cell").withColumn("nth", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    dealt = placed.select((F.col("base") + F.col("nth")).alias("tile"), F.col("cell").cast("long").alias("cell"), "nth", "tiles", "fp", "rep")

    def pack(tile: pa.Table) -> pa.Table:
        fps = b"".join(tile.column("fp").to_pylist())
        return pa.table({**{c: tile.column(c)[:1] for c in ("cell", "nth", "tiles")}, "fps": pa.array([fps], pa.binary()), "reps": pa.array([tile.column("rep").to_numpy().tobytes()], pa.binary())})

    packed = dealt.groupBy("tile").applyInArrow(pack, "cell long, nth long, tiles long, fps binary, reps binary")
    sides = packed.join(F.broadcast(spark.createDataFrame(meet)), "cell").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    low, high = F.least("nth", "other"), F.greatest("nth", "other")
    place = F.when(F.col("role") == 0, F.col("nth") * F.col("others") + F.col("other")).when(F.col("role") == 1, F.col("other") * F.col("tiles") + F.col("nth")).otherwise(low * F.col("tiles") - F.expr("least(nth, other) * (least(nth, other) - 1) div 2") + high - low)
    sides = sides.select((F.col("start") + place).alias("pair"), ((F.col("role") == 2) & (F.col("nth") == F.col("other"))).alias("same"), "fps", "reps")

    def links(sides: list[dict]) -> pa.RecordBatch | None:
        same = sides[0]["same"]
        if len(sides) < 2 and not same:
            return None  # the other tile holds nothing
        prints = [np.frombuffer(s["fps"], ">u8").astype(np.uint64).reshape(-1, width) for s in sides]
        reps = np.concatenate([np.frombuffer(s["reps"], "<i8") for s in sides])
        labels, shift = np.arange(len(reps)), 0 if same else len(prints[0])
        for i, j in near_pairs(prints[0], prints[-1], radius, radius if first is None else first, same):
            merge_labels(labels, i, j + shift)
        tied = np.nonzero(labels != np.arange(len(labels)))[0]
        return pa.RecordBatch.from_arrays([pa.array(reps[tied], pa.int64()), pa.array(reps[labels[tied]], pa.int64())], ["a", "b"])

    work = (counts[a].astype(float) * counts[b]).sum() / max(1, int(met.sum()))
    return per_tile(sides, "pair", int(met.sum()), links, "a long, b long", max(8, int(TASK // max(1.0, work))))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, radius: int = 3, width: int = 1, first: int | None = None, tile_rows: int = 4096) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits for each of `width` words), component_id.

    Fingerprints link at `radius` or fewer differing bits (and `first` or fewer in the first word, if given);
    component_id is the smallest doc_id reachable, the row's own included. Null and wordless texts have fingerprint zero
    and link like any other. A row without doc_id takes part, and names no component; rows that repeat a doc_id are each
    fingerprinted, and one vertex. An empty table gives an empty result; other columns are not looked at. Equal
    fingerprints are one node, so groups of copies cost one comparison. The comparison is exact and grows with the square of the number of distinct
    fingerprints.
    """
    prints = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, width=width), "fingerprints")
    nodes = materialize(prints.groupBy("fp", "ones").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "fingerprint-nodes")
    if width == 1:
        bits = sections(nodes.count())
        cell, near = counted(bits), lambda codes: near_counts(codes, bits, radius)
    else:
        cell, near = F.col("ones"), lambda codes: near_bands(codes, radius)
    found = connected_components(linked(nodes.where("rep is not null").select("fp", cell.alias("cell"), "rep"), radius, tile_rows, near, width, first))
    named = nodes.join(found, nodes["rep"] == found["node"], "left").select("fp", "n", F.coalesce("component", "rep").alias("component_id"))
    whole = skew_safe_lookup(prints, materialize(named, "fingerprint-names"), "fp", "n")
    return whole.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def similar(sets: DataFrame, similarity: float, radius: int, first: int, width: int, block_rows: int = 1024, block_size: int = 1 << 19, pivots: int = 8) -> DataFrame:
    """sets (component, node, fp, size, hashes) to edges (a, b) between nodes that connect whatever pairs of sets have a
    Jaccard similarity of `similarity` or more, of those of one component whose fingerprints are near.

    Small components share a tile. Large ones are dealt to blocks, each compared within itself and with some of the
    component's sets, the pivots, which tie the blocks of a group of copies together. What is not tied to the
    component's largest group after that, the strays, meets all blocks; sets already connected are not compared.
    """
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / block_rows, F.sum("size") / block_size, F.lit(1.0))).cast("int")
    sizes = materialize(sets.groupBy("component").agg(blocks.alias("blocks"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("volume")), "near-sizes")
    n, volume = sizes.where("blocks = 1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("volume"), F.lit(0))).head()
    shared = max(1, 2 * n // block_rows, 2 * volume // block_size)
    dealt = sets.join(sizes.select("component", "blocks"), "component").withColumns({"block": F.pmod(F.xxhash64("node"), "blocks").cast("int"), "big": F.col("blocks") > 1})
    columns = ["big", "tile", "x", "y", "side", "label", "node", "fp", "hashes"]

    def compare(key: tuple, part: pa.Table) -> pa.Table:
        ids, label = part.column("node").to_numpy(), part.column("label").to_numpy()
        prints = np.frombuffer(b"".join(part.column("fp").to_pylist()), ">u8").astype(np.uint64).reshape(-1, width)
        hashes = [np.frombuffer(h, "<u8") for h in part.column("hashes").to_pylist()]
        side = part.column("side").to_numpy()
        same = not side.any()
        a, b = (np.arange(len(ids)),) * 2 if same else (np.nonzero(side == 0)[0], np.nonzero(side)[0])

        def alike(i: int, j: int) -> bool:
            p, q = hashes[i], hashes[j]
            if min(len(p), len(q)) < similarity * max(len(p), len(q)) - 1e-6:
                return False
            common = len(np.intersect1d(p, q, assume_unique=True))
            return common / max(1, len(p) + len(q) - common) >= similarity

        _, start, known = np.unique(label, return_index=True, return_inverse=True)
        labels = start[known]  # connected already: one group
        begun = labels.copy()
        for i, j in near_pairs(prints[a], prints[b], radius, first, same):
            i, j = a[i], b[j]
            apart = labels[i] != labels[j]
            i, j = i[apart], j[apart]
            nearest = np.argsort(np.bitwise_count(prints[i] ^ prints[j]).sum(axis=1), kind="stable")
            i, j = i[nearest], j[nearest]
            while len(i):  # what is connected already is not compared again
                step = max(64, len(i) // 16)
                good = np.fromiter(map(alike, i[:step].tolist(), j[:step].tolist()), bool, len(i[:step]))
                merge_labels(labels, i[:step][good], j[:step][good])
                i, j = i[step:], j[step:]
                apart = labels[i] != labels[j]
                i, j = i[apart], j[apart]
        tied = np.nonzero(labels != begun)[0]
        return pa.table({"a": pa.array(ids[tied]), "b": pa.array(ids[labels[tied]])})

    def edges(rows: DataFrame, name: str) -> DataFrame:
        return materialize(rows.select(*columns).groupBy("big", "tile", "x", "y").applyInArrow(compare, "a long, b long"), name)

    own = {"tile": F.when(F.col("big"), F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(shared))), "x": F.col("block"), "y": F.lit(0), "side": F.lit(0), "label": F.col("node")}
    large = dealt.where("big")
    nth = F.row_number().over(Window.partitionBy("component").orderBy(F.xxhash64("node"), "node"))
    pivot = large.withColumn("nth", nth).where(F.col("nth") <= pivots).withColumn("home", F.col("block"))
    pivot = pivot.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block <> home")
    found = edges(dealt.withColumns(own).unionByName(pivot.withColumns(own).select(*dealt.columns, *own)), "near-links")
    if not sizes.where("blocks > 1").head(1):
        return found
    group = connected_components(found)
    held = materialize(large.select("component", "node").join(group.withColumnRenamed("component", "label"), "node", "left").select("component", "node", F.coalesce("label", "node").alias("label")), "near-groups")
    main = held.groupBy("component", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("component").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("all"))
    main = main.select("component", F.col("main.label").alias("main"), (F.col("all") - F.col("main.n")).alias("strays")).where("strays > 0")
    main = materialize(main.withColumn("stray_blocks", F.ceil(F.col("strays") / block_rows).cast("int")), "near-strays")
    open_ = large.join(main, "component").join(held.select("node", "label"), "node")
    every = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    place = F.pmod(F.xxhash64("node"), "stray_blocks").cast("int")
    left = open_.withColumns({"tile": F.col("component"), "x": F.col("block"), "y": every("stray_blocks"), "side": F.lit(0)})
    right = open_.where("label <> main").withColumns({"tile": F.col("component"), "x": every("blocks"), "y": place, "side": F.lit(1)})
    return found.unionByName(edges(left.select(*columns).unionByName(right.select(*columns)), "near-crossings"))


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8, width: int = 4) -> DataFrame:
    """docs with one row left of each component, the one with its smallest doc_id (ties: by the text's digest), all
    columns as they came, whatever their names.

    Texts link when the Jaccard similarity of their sets of shingles is `similarity` or more, computed exactly. The
    pairs to compute it for come from SimHash: sets of similarity J lie at an angle of arccos(2 J / (1 + J)), of which
    the fingerprints show the share of half a turn as differing bits; the filter leaves 4.5 deviations in the first word
    and four or more in all words, counted from 3/16, the most that small sets of similarity 0.8 (4 of 5) differ by.
    Tiles hold sets of about one population count, their number of shingles, of which neither can be under `similarity`
    of the other; others are skipped. Only texts with a neighbour are read again.

    Null, empty and wordless texts have the same, empty set: one row of them stays. Rows are compared each by itself,
    also those that share a doc_id; a null doc_id ranks last. Of rows alike in doc_id and text one stays, chosen by a
    hash of all columns. An empty table gives an empty one.
    """
    share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    small, bits, bands = max(share, 3 / 16), 64 * width, 4
    radius, first = int(np.ceil(bits * small + 4 * np.sqrt(bits * small * (1 - small)))), int(np.ceil(64 * share + 4.5 * np.sqrt(64 * share * (1 - share))))
    text, doc_id = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    plain = docs.select(doc_id.alias("doc_id"), text.alias("text"), digest.alias("digest"))
    prints = shingle_sets(plain, shingle_words=shingle_words, width=width, whole=False)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("best")
    band = F.when(F.col("size") > 0, 1 + F.floor(F.log("size") * (bands / np.log(1 / similarity)))).otherwise(0).cast("int")
    nodes = prints.groupBy("key").agg(F.min("fp").alias("fp"), F.min("size").alias("size"), best)
    nodes = materialize(nodes.select("fp", band.alias("cell"), "best", F.monotonically_increasing_id().alias("node")), "shingle-sets")
    near = connected_components(linked(nodes.select("fp", "cell", F.col("node").alias("rep")), radius, 4096, lambda codes: near_bands(codes, bands), width, first))
    near = near.unionByName(near.select(F.col("component").alias("node"), "component")).distinct()  # the smallest has no row
    wanted = nodes.join(near, "node").select("component", "node", F.col("best.doc_id").alias("wanted_id"), F.col("best.digest").alias("wanted"))
    texts = plain.join(wanted, (F.col("digest") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    sets = shingle_sets(texts.select("component", "node", "doc_id", "text"), shingle_words=shingle_words, width=width, whole=True)
    sets = materialize(sets.groupBy("component", "node").agg(*[F.any_value(c).alias(c) for c in ("fp", "size", "hashes")]), "near-sets")
    found = connected_components(similar(sets, similarity, radius, first, width))
    named = nodes.join(found, "node", "left").groupBy(F.coalesce("component", "node")).agg(F.min("best").alias("best"))
    stay = materialize(named.select(F.col("best.doc_id").alias("stay_id"), F.col("best.digest").alias("stay")), "near-stay")
    rows = set_aside(docs, id=doc_id, digest=digest, order=row_hash(docs))
    kept = rows.join(stay, (F.col("digest") == F.col("stay")) & F.col("id").eqNullSafe(F.col("stay_id")), "left_semi")
    once = F.row_number().over(Window.partitionBy("id", "digest").orderBy("order"))
    kept = kept.withColumn("nth", once).where("nth = 1")
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
