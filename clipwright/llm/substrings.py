"""Repeated passages: a count-min sketch first, then exact groups of the windows it estimates to be repeated.

Three scans of the texts. The first sketches each chunk of documents; the chunks' sketches merge into one, which never
counts too low. What it counts are not the windows themselves but their anchors: of a window's runs of `gram` words the
one with the least hash. Windows of equal words have equal anchors at equal offsets, so the places where a window's
anchor was chosen are at least as many as the window's own: an overestimate of its count from a tenth of the entries.
The second scan sends on only the windows estimated at two or more and groups these exactly, by 128 bits from two
families of hashes that share nothing. The third takes the answers and removes words. A chunk is a run of rows within
one scan partition, so docs must scan the same way each time, as files do; answers carry checksums, and a scan that
differs raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.permute import mix64
from clipwright.llm.shared import discard, distribute, materialize

#: Bytes of text hashed at a time.
SPAN = 1 << 18
#: Cells of the sketch in one message, as a power of two, unless the sketch is very large.
SLICE = 21
#: The sketch's rows.
DEPTH = 2
#: Partial sketches of a slice that one task merges, in later rounds.
FAN = 64

BLANK = np.zeros(256, bool)
BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
#: Two families of hashes: a number for each byte, odd multipliers for bytes within a word and for words within a window.
FAMILIES = tuple((np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1), of_bytes, of_words) for seed, of_bytes, of_words in ((35, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (53, 0xBF58476D1CE4E5B9, 0xA0761D6478BD642F)))
#: Low bits that hold a place where the least hash is sought; texts have fewer words than that.
PLACE = np.uint64((1 << 30) - 1)

_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 ... base**(n-1), or their inverses, modulo 2**64."""
    held = _powers.get((base, inverse))
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 12), pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        held[0] = 1
        held = np.cumprod(held)
        if n <= 4 * SPAN:
            _powers[base, inverse] = held
    return held[:n]


def spans(values: np.ndarray, base: int, *ends: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """For each pair (starts, ends), the polynomial hashes of values[s:e], wherever they lie."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers(base, len(values)))))
    back = powers(base, len(values), True)
    return [(sums[e] - sums[s]) * back[s] for s, e in ends]


def words(data: np.ndarray, families: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Starts of the words of a text's bytes, and their hashes in the first `families` families."""
    starts, hashes, at = [], [[] for _ in range(families)], 0
    while at < len(data):
        stop = min(len(data), at + SPAN)
        if stop < len(data):  # cut between words
            blanks = np.nonzero(BLANK[data[at:stop]])[0]
            if len(blanks):
                stop = at + int(blanks[-1]) + 1
            else:
                later = np.nonzero(BLANK[data[stop:]])[0]
                stop = stop + int(later[0]) if len(later) else len(data)
        part = data[at:stop]
        solid = ~BLANK[part]
        s = np.nonzero(solid & np.concatenate(([True], ~solid[:-1])))[0]
        e = np.nonzero(solid & np.concatenate((~solid[1:], [True])))[0] + 1
        if len(s):
            for found, (letters, base, _) in zip(hashes, FAMILIES):
                found.append(mix64(spans(letters[part], base, (s, e))[0] + (e - s).astype(np.uint64)))
            starts.append(s + at)
        at = stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(starts, np.int64), [join(h, np.uint64) for h in hashes]


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    held, span = values, 1
    while span * 2 <= width:
        held, span = np.minimum(held[:-span], held[span:]), span * 2
    return np.minimum(held[: len(held) - (width - span)], held[width - span :]) if span < width else held


def windows(hashes: list[np.ndarray], width: int, gram: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the windows of `width` words: the hashes of all runs of `gram` words, the place of each window's anchor among
    them (the first of the least), and each window's hashes in the families given."""
    n = len(hashes[0]) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), [np.zeros(0, np.uint64) for _ in hashes]
    s, g = np.arange(n), np.arange(len(hashes[0]) - gram + 1)
    runs, one = map(mix64, spans(hashes[0], FAMILIES[0][2], (g, g + gram), (s, s + width)))
    places = least((runs & ~PLACE) | g.astype(np.uint64), width - gram + 1) & PLACE
    return runs, places.astype(np.int64), [one] + [mix64(spans(h, FAMILIES[k][2], (s, s + width))[0]) for k, h in enumerate(hashes) if k]


def text_bytes(text) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


def hashed(texts: list[bytes], width: int, gram: int, families: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Each text's numbers of windows and words, the anchors of the texts, and for all windows, one text after the
    other, which of the anchors is theirs and their hashes.

    The texts are hashed together, a blank between them; windows across a border are dropped.
    """
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, hashes = words(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), families)
    owner = np.searchsorted(ends, starts, side="right")
    runs, places, found = windows(hashes, width, gram)
    within = owner[: len(places)] == owner[width - 1 :] if len(places) else np.zeros(0, bool)
    places = places[within]
    new = np.diff(places, prepend=-1) > 0  # places never step back
    n_words = np.bincount(owner, minlength=len(texts))
    anchors = mix64(runs[places[new]])  # mixed again, as the least of many hashes is a small number
    return np.maximum(n_words - width + 1, 0), n_words, anchors, np.cumsum(new) - 1, [f[within] for f in found]


def cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each key in each row of a sketch of 2**bits cells a row."""
    return [((keys if r == 0 else mix64(keys + np.uint64(r))) >> np.uint64(64 - bits)).astype(np.int64) for r in range(DEPTH)]


def packed(sorted_cells: np.ndarray, size: int = 0) -> bytes:
    """Ascending numbers below `size` as byte planes of their differences, which compress well, or as bits if that is
    shorter."""
    if size and len(sorted_cells) > size // 8:
        on = np.zeros(size, bool)
        on[sorted_cells] = True
        return b"\0" + np.packbits(on, bitorder="little").tobytes()
    steps = np.diff(sorted_cells, prepend=0)
    kind = "<u2" if len(steps) == 0 or steps.max() < 1 << 16 else "<u4"
    return bytes([int(kind[-1])]) + steps.astype(kind).view(np.uint8).reshape(-1, int(kind[-1])).T.tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    size = blob[0]
    if not size:
        return np.nonzero(np.unpackbits(np.frombuffer(blob, np.uint8, offset=1), bitorder="little"))[0]
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(size, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(f"<u{size}")[:, 0].astype(np.int64))


@dataclass
class Sketch:
    """For each row, a bit for every cell counted twice or more: 2**bits cells a row, in memory or mapped from a file."""

    bits: int
    rows: list[np.ndarray]

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """Whether the least count among each key's cells, the estimate, is two or more."""
        out = np.ones(len(keys), bool)
        for row, at in zip(self.rows, cells(keys, self.bits)):
            out &= (row[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


@dataclass
class Chunk:
    """Consecutive rows of a scan partition: numbers of windows and words by row, the anchors, and for all windows, row
    after row, which anchor is theirs and their hashes in each family."""

    key: int
    lengths: np.ndarray
    words: np.ndarray
    anchors: np.ndarray
    anchor_of: np.ndarray
    hashes: list[np.ndarray]


def chunk_of(key: int, texts: list[bytes], width: int, gram: int, families: int = 2) -> Chunk:
    """Hashes texts, about SPAN bytes at a time."""
    parts, at = [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SPAN):
            size += len(texts[end])
            end += 1
        parts.append(hashed(texts[at:end], width, gram, families))
        at = end
    lengths, n_words, anchors, anchor_of, hashes = zip(*parts)
    shift = np.cumsum([0, *map(len, anchors)])
    return Chunk(key, *map(np.concatenate, (lengths, n_words, anchors, [a + k for a, k in zip(anchor_of, shift)])), [np.concatenate(h) for h in zip(*hashes)])


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, list, list[bytes]]]:
    """Rows (doc_id, text) in chunks of about `most` words: key, ids, texts. How they are cut depends on the rows alone."""
    part, seq, held, ids, texts = TaskContext.get().partitionId(), 0, 0, [], []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text_bytes(text))
            held += len(texts[-1])
            if held >= most * 6:
                yield part << 32 | seq, ids, texts
                seq, held, ids, texts = seq + 1, 0, [], []
        batch = text = None  # noqa: F841  frees the batch before the next one comes
        pa.default_memory_pool().release_unused()
    if ids:
        yield part << 32 | seq, ids, texts


def opened(bits: int, rows: list[np.ndarray | str]) -> Sketch:
    """A sketch as it came to a worker: its rows themselves, or the names of files that hold them."""
    return Sketch(bits, [np.memmap(SparkFiles.get(r), np.uint8, "r") if isinstance(r, str) else r for r in rows])


def sketch(texts: DataFrame, width: int, gram: int, bits: int, most: int, salts: int, held_bits: int = 28) -> tuple[int, list[np.ndarray | str]]:
    """The merged sketch of all anchors: local ones per chunk and slice of cells, merged FAN salts at a time. Returns
    what `opened` takes; rows of more than 2**held_bits cells are files on the executors' disks.

    A merged slice is no larger than its cells, so no task holds more than FAN of them, whatever the input.
    """
    cut = max(SLICE, bits - 10)  # at most 1,024 slices a row
    parts, size = 1 << max(0, bits - cut), 1 << min(bits, cut)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, bodies in chunks(batches, most):
            chunk = chunk_of(key, bodies, width, gram, 1)
            keys, counts = np.unique(chunk.anchors, return_counts=True)
            rows = []
            for r, at in enumerate(cells(keys, bits)):
                order = np.argsort(at, kind="stable")
                at, many = at[order], (counts > 1)[order]
                cell, first = np.unique(at, return_index=True)
                many = np.logical_or.reduceat(many, first) | (np.diff(first, append=len(at)) > 1) if len(at) else many
                bounds = np.searchsorted(cell, np.arange(parts + 1) * size)
                for p in range(parts):
                    c, m = cell[bounds[p] : bounds[p + 1]] - p * size, many[bounds[p] : bounds[p + 1]]
                    if len(c):
                        rows.append((r * parts + p, ((chunk.key >> 32) * 7 + (chunk.key & 0xFFFFFFFF)) % salts, packed(c[~m], size), packed(c[m], size)))
            yield from whole(rows)

    def whole(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "salt", "once", "more"])

    def merged(table: pa.Table) -> pa.Table:
        state = np.zeros(size, np.uint8)
        for once, more in zip(table.column("once"), table.column("more")):
            at = unpacked(once.as_py())
            now = state[at]
            now += now < 2
            state[at] = now
            state[unpacked(more.as_py())] = 2
        return pa.table({"part": table.column("part")[:1], "salt": table.column("salt")[:1], "once": pa.array([packed(np.nonzero(state == 1)[0], size)]), "more": pa.array([packed(np.nonzero(state == 2)[0], size)])})

    def bitmap(table: pa.Table) -> pa.Table:
        more = unpacked(merged(table).column("more")[0].as_py())
        state = np.zeros(size, bool)
        state[more] = True
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([np.packbits(state, bitorder="little").tobytes()])})

    ddl = "part int, salt int, once binary, more binary"
    salted = texts.mapInArrow(local, ddl).groupBy("part", "salt").applyInArrow(merged, ddl)
    while salts > FAN:
        salts = -(-salts // FAN)
        salted = salted.withColumn("salt", F.col("salt") % salts).groupBy("part", "salt").applyInArrow(merged, ddl)
    found = salted.groupBy("part").applyInArrow(bitmap, "part int, bits binary")
    if bits > held_bits:
        found = materialize(found, "substring-sketch")

        def pieces(row: int) -> Iterator[bytes]:
            """A row's slices in order, those without a count included; one at a time passes through the driver."""
            at = 0
            for part, blob in found.where((F.col("part") >= row * parts) & (F.col("part") < (row + 1) * parts)).orderBy("part").toLocalIterator():
                yield from (bytes(size >> 3) for _ in range(part - row * parts - at))
                yield blob
                at = part - row * parts + 1
            yield from (bytes(size >> 3) for _ in range(parts - at))

        names = [distribute(texts.sparkSession, pieces(row), "sketch") for row in range(DEPTH)]
        discard(found)
        return bits, names
    rows = [np.zeros((1 << bits) >> 3, np.uint8) for _ in range(DEPTH)]
    for part, blob in found.toLocalIterator():  # together no more than 2**held_bits cells a row
        row, p = divmod(part, parts)
        rows[row][p * size >> 3 : (p + 1) * size >> 3] = np.frombuffer(blob, np.uint8)
    return bits, rows


def runs_of(bucket: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the entries by all three, which distinct entry each is, and where the distinct ones begin in order."""
    order = np.lexsort((two, one, bucket))
    new = np.ones(len(order), bool)
    for part in (bucket[order], one[order], two[order]):
        new[1:] &= part[1:] == part[:-1]
    new[1:] = ~new[1:]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order, which, np.nonzero(new)[0]


def suspects(chunk: Chunk, counted: Sketch, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk's windows that the sketch calls repeated: where they are, which distinct one each is, and the
    distinct ones' bucket and hashes (two columns) in ascending order, with the number of each."""
    at = np.nonzero(counted.repeated(chunk.anchors)[chunk.anchor_of])[0]
    one, two = (h[at] for h in chunk.hashes)
    bucket = (mix64(one) % np.uint64(buckets)).astype(np.int64)
    order, which, first = runs_of(bucket, one, two)
    pick = order[first]
    return at, which, bucket[pick], np.stack((one[pick], two[pick]), axis=1), np.diff(first, append=len(order))


def checksum(keys: np.ndarray) -> int:
    return int(keys.sum(dtype=np.uint64).view(np.int64))


def answered(texts: DataFrame, width: int, gram: int, counted, buckets: int, most: int) -> DataFrame:
    """(chunk, bucket, n, sum, mask): which of a chunk's suspects in a bucket occur twice or more in all the texts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = opened(*counted.value)
        for chunk_key, _, bodies in chunks(batches, most):
            chunk = chunk_of(chunk_key, bodies, width, gram)
            _, _, bucket, keys, n = suspects(chunk, seen, buckets)
            used, first = np.unique(bucket, return_index=True)
            ends = np.append(first[1:], len(bucket))
            if len(used):
                yield pa.RecordBatch.from_arrays([
                    pa.array(used.astype(np.int32)), pa.array(np.full(len(used), chunk.key)),
                    pa.array([keys[s:e].astype("<u8").tobytes() for s, e in zip(first, ends)], pa.binary()),
                    pa.array([np.packbits(n[s:e] > 1).tobytes() for s, e in zip(first, ends)], pa.binary()),
                ], ["bucket", "chunk", "keys", "more"])

    def group(table: pa.Table) -> pa.Table:
        asked = [np.frombuffer(k.as_py(), "<u8").reshape(-1, 2) for k in table.column("keys")]
        more = [np.unpackbits(np.frombuffer(m.as_py(), np.uint8), count=len(k)).astype(bool) for m, k in zip(table.column("more"), asked)]
        whole = np.concatenate(asked)
        _, which, first = runs_of(np.zeros(len(whole), np.int64), whole[:, 0], whole[:, 1])
        twice = np.bincount(which, minlength=len(first)) > 1
        twice |= np.bincount(which, np.concatenate(more), len(first)) > 0
        ends = np.cumsum([len(k) for k in asked])
        yes = [twice[which[e - len(k) : e]] for k, e in zip(asked, ends)]
        return pa.table({
            "chunk": table.column("chunk"), "bucket": table.column("bucket"), "n": pa.array([len(k) for k in asked], pa.int64()),
            "sum": pa.array([checksum(k) for k in asked], pa.int64()), "mask": pa.array([np.packbits(y).tobytes() for y in yes], pa.binary()),
        })

    asked = texts.mapInArrow(ask, "bucket int, chunk long, keys binary, more binary")
    return asked.groupBy("bucket").applyInArrow(group, "chunk long, bucket int, n long, sum long, mask binary")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 35, gram: int = 16, most_bits: int = 34, held_bits: int = 28, chunk_words: int = 1 << 19) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text.

    Removes every word in a window of `width` words whose word sequence also starts anywhere else in docs, in the same
    row included; windows are judged on the input. kept_text is the other words joined by one space. Null is the empty
    text; shorter texts than a window keep all their words; rows that repeat a doc_id are rows of their own, and copies
    of each other. An empty table gives an empty result; other columns are not looked at. Anchors are runs of `gram`
    words (at most `width`). The sketch grows with the input: up to 2**held_bits cells a row it is broadcast, beyond it
    lies on the executors' disks, memory-mapped. `most_bits` bounds it: beyond that more windows take the exact pass, and
    none is lost. docs must be a plain scan of files (see the module); materialise anything else first.
    """
    spark, gram = docs.sparkSession, min(gram, width)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    anchors = size // 6 * 2 // (width - gram + 2)  # a random order has so many
    bits = min(most_bits, max(16, int(anchors * 8).bit_length()))
    buckets = max(8, size // 6 // (1 << 21))
    salts = max(16, size // 6 // (FAN * chunk_words))
    # plain arrays of bounded size, or names: workers need no copy of this package
    counted = spark.sparkContext.broadcast(sketch(texts, width, gram, bits, chunk_words, salts, held_bits))
    replies = materialize(answered(texts, width, gram, counted, buckets, chunk_words), "substring-replies")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, ids, bodies in chunks(batches, chunk_words):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), key)), pa.array(np.arange(len(ids))), pa.array(ids, pa.int64()), pa.array(bodies, pa.binary())], ["chunk", "nth", "doc_id", "text"])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("nth")
        texts = left.column("text").to_pylist()
        chunk = chunk_of(0, texts, width, gram)
        at, which, bucket, keys, _ = suspects(chunk, opened(*counted.value), buckets)
        used, first = np.unique(bucket, return_index=True)
        found = {r["bucket"]: r for r in right.to_pylist()}
        yes = np.zeros(len(keys), bool)
        if sorted(found) != used.tolist():
            raise RuntimeError("the texts were not scanned the same way twice")
        for b, s, e in zip(used.tolist(), first, np.append(first[1:], len(bucket))):
            if found[b]["n"] != e - s or found[b]["sum"] != checksum(keys[s:e]):
                raise RuntimeError("the texts were not scanned the same way twice")
            yes[s:e] = np.unpackbits(np.frombuffer(found[b]["mask"], np.uint8), count=e - s)
        repeated = np.zeros(len(chunk.anchor_of), bool)
        repeated[at] = yes[which]
        n_removed, kept, end = [], [], 0
        for text, total, n in zip(texts, chunk.words.tolist(), chunk.lengths.tolist()):
            begin, end = end, end + n
            pieces, hit = text.split(), np.nonzero(repeated[begin:end])[0]
            removed = 0
            if len(hit):
                edge = np.zeros(total + 1, np.int64)
                edge[hit] += 1
                edge[hit + width] -= 1
                stays = np.cumsum(edge[:-1]) == 0
                removed = total - int(stays.sum())
                pieces = list(compress(pieces, stays.tolist()))
            n_removed.append(removed)
            kept.append(b" ".join(pieces).decode("utf-8", "surrogatepass"))
        return pa.table({"doc_id": left.column("doc_id"), "n_words": pa.array(chunk.words.astype(np.int64)), "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.string())})

    labelled = texts.mapInArrow(label, "chunk long, nth long, doc_id long, text binary")
    return labelled.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(finish, "doc_id long, n_words long, n_removed long, kept_text string")
