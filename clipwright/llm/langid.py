"""Language identification: bit-sliced Bloom filters of character n-grams, a bit of each cell for each language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipwright.llm.permute import mix64
from clipwright.llm.shared import materialize

#: Verdict for texts that are null or have no letter.
UNKNOWN = "und"
#: Code points looked at at a time.
SPAN = 1 << 18

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def keys_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the letters in points (without its two ends), and for each the 64-bit key of the trigram around it;
    non-letters are one sign."""
    part = points.astype(np.uint64)
    part[~letters()[points]] = 0
    middle = np.nonzero(part[1:-1])[0]
    return middle, (part[middle] << np.uint64(42)) | (part[middle + 1] << np.uint64(21)) | part[middle + 2]


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Keys of the text's trigrams whose middle is a letter, block by block; case is folded."""
    points = np.frombuffer(("\0" + (text or "").lower() + "\0").encode("utf-32-le", "surrogatepass"), "<u4")
    for k in range(0, len(points) - 2, SPAN):
        yield keys_of(points[k : k + SPAN + 2])[1]


def gathered(texts: Iterator[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """All texts in order, about SPAN code points at a time: the first one's number, the keys of each one's trigrams end
    to end, and how many each has. A longer text comes alone and in several parts."""
    held, size, first = [], 0, 0

    def together() -> tuple[int, np.ndarray, np.ndarray]:
        ends = np.cumsum([len(t) + 1 for t in held])
        middle, keys = keys_of(np.frombuffer(("\0" + "\0".join(held) + "\0").encode("utf-32-le", "surrogatepass"), "<u4"))
        return first, keys, np.bincount(np.searchsorted(ends, middle, side="right"), minlength=len(held))

    n = 0
    for text in texts:
        if len(text or "") > SPAN:
            if held:
                yield together()
            for keys in grams(text):
                yield n, keys, np.array([len(keys)])
            held, size, first = [], 0, n + 1
        else:
            held.append((text or "").lower())
            size += len(held[-1])
            if size > SPAN:
                yield together()
                held, size, first = [], 0, n + 1
        n += 1
    if held:
        yield together()


@dataclass
class Filters:
    """One Bloom filter per language, sliced by bit: row p holds, for every language, whether its filter has bit p set."""

    languages: list[str]
    cells: np.ndarray  # (positions: a power of two, words of 64 languages), unsigned 64-bit
    hashes: int
    cover: np.ndarray | None = None  # for each language, the share of its own n-grams it would find in a text not learned from

    def positions(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        one = mix64(keys)
        two = mix64(keys ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        for h in range(self.hashes):
            yield ((one + np.uint64(h) * two) & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def add(self, language: int, keys: np.ndarray) -> None:
        bit = np.uint64(1 << (language % 64))
        for at in self.positions(keys):
            self.cells[at, language // 64] |= bit

    def having(self, keys: np.ndarray) -> np.ndarray:
        """Bitmasks of the languages whose filters contain each key: all languages by one lookup per hash."""
        out = None
        for at in self.positions(keys):
            out = self.cells[at] if out is None else out & self.cells[at]
        return out

    def popcounts(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many of the keys each language's filter contains: a row for each of the runs of keys that sizes are of."""
        masks, out = self.having(keys), np.zeros((len(sizes), len(self.languages)), np.int64)
        some = np.nonzero(sizes)[0]
        if len(some):
            starts = np.cumsum(sizes)[some] - sizes[some]
            for k in range(len(self.languages)):
                out[some, k] = np.add.reduceat(masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1), starts)
        return out

    def false_positives(self) -> np.ndarray:
        """Each filter's chance of containing a key that was never added."""
        bits = np.unpackbits(np.ascontiguousarray(self.cells).view(np.uint8), axis=1, bitorder="little")
        return (bits.mean(axis=0) ** self.hashes)[: len(self.languages)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(labelled: DataFrame, *, fit_rows: int = 20_000, per_language: int = 20_000, share: float = 0.1, positions: int = 1 << 18, hashes: int = 4) -> Filters | None:
    """Filters from labelled (key, text, lang), nulls left out; None without any.

    Learns from a sample of about `fit_rows` whole texts of each language, chosen by a hash of their key, and all texts
    of rarer languages: the bound on the fit, as is `per_language`, the most frequent n-grams a language keeps. An n-gram belongs to a language if it is seen there
    twice or more, and at least `share` times as often, per n-gram read, as in the language where it is most frequent.
    """
    rows = labelled.where("lang is not null and text is not null")
    sizes = rows.groupBy("lang").count().collect()  # a row per language
    if not sizes:
        return None
    shares = [(lang, max(1, int((1 << 30) * min(1.0, fit_rows / n)))) for lang, n in sizes]
    shares = rows.sparkSession.createDataFrame(shares, "lang string, below long")
    part = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.col("below"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                by.setdefault(lang, []).extend(grams(text.as_py()))
            for lang, found in by.items():
                keys, times = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(times.astype(np.int64))], ["lang", "gram", "n"])

    seen = part.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    seen = materialize(seen, "langid-grams")
    totals = dict(seen.groupBy("lang").agg(F.sum("n")).collect())  # a row per language
    if not totals:
        return None
    rate = seen.where("n > 1").join(F.broadcast(seen.sparkSession.createDataFrame(list(totals.items()), "lang string, total long")), "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = F.max("rate").over(Window.partitionBy("gram"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = rate.withColumn("top", top).where(F.col("rate") >= share * F.col("top")).withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "gram", "n").toPandas()
    languages = sorted(totals)
    filters = Filters(languages, np.zeros((positions, -(-len(languages) // 64)), np.uint64), hashes, np.zeros(len(languages)))
    for k, lang in enumerate(languages):
        own = kept[kept["lang"] == lang]
        filters.add(k, own["gram"].to_numpy(np.int64).view(np.uint64))
        filters.cover[k] = own.loc[own["n"] > 2, "n"].sum() / totals[lang]  # seen twice or more elsewhere, too
    return filters


def predict(docs: DataFrame, filters: Filters | None, *, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score added.

    A language's popcount c over n n-grams is corrected for its filter's false-positive rate f to (c - f n) / (1 - f);
    the language with the most is predicted (ties: the first by name) and score is its corrected share of n, 0 to 1.
    Texts that are null or have no letter get `und` and 0, as do all texts if nothing was learned.
    """
    # plain arrays, bounded by the parameters of learn(): workers need no copy of this package
    sent = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.cells, filters.hashes, filters.false_positives()) if filters else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, cells, hashes, wrong = sent.value or ([UNKNOWN], np.zeros((1, 1), np.uint64), 1, np.zeros(1))
        known = Filters(languages, cells, hashes)
        for batch in batches:
            n, counts = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, len(languages)), np.int64)
            for first, keys, sizes in gathered(text.as_py() for text in batch.column(0)):
                n[first : first + len(sizes)] += sizes
                counts[first : first + len(sizes)] += known.popcounts(keys, sizes)
            right = np.clip((counts - wrong * n[:, None]) / (1 - wrong), 0, n[:, None])
            best = right.argmax(axis=1)
            judged = (n > 0) & (sent.value is not None)
            langs = pa.array([languages[b] if j else UNKNOWN for b, j in zip(best.tolist(), judged.tolist())], pa.string())
            scores = pa.array(np.where(judged, right[np.arange(len(n)), best] / np.maximum(n, 1), 0.0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], langs, scores], [*batch.schema.names[1:], "lang_pred", "score"])

    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    whole = docs.select(F.col(text_col).cast("string").alias("__text"), *rest)
    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")
    return whole.mapInArrow(run, schema)


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from the rows with a language that are not held out (crc32 of the id as text, modulo 3, is 1; a null id is
    neither held out nor learned from) and judges every row by its text alone. An empty table gives an empty result.
    """
    key = F.col(id_col)
    labelled = docs.where(key.isNotNull() & ~held_out(key)).select(key.alias("key"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = docs.select(key.cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(text_col).cast("string").alias("__body"))
    return predict(rows, learn(labelled, **options), text_col="__body").select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.5, **options) -> DataFrame:
    """docs without the rows in no learned language: `und`, or a score under `least` of the share of n-grams that the
    predicted language finds in texts of its own, so that neither rare languages nor those of many n-grams fall short.

    Rows whose text is null or has no letter go, as do all rows if nothing could be learned; rows without an id are
    judged but not learned from; repeated rows are judged alike. An empty table gives an empty one. All columns come
    back as they were, whatever their names.
    """
    key = F.col(id_col)
    labelled = docs.where(key.isNotNull() & ~held_out(key)).select(key.alias("key"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    plain = docs.select(*[F.col(c).alias(f"__{k}") for k, c in enumerate(docs.columns)])
    filters = learn(labelled, **options)
    judged = predict(plain, filters, text_col=f"__{docs.columns.index(text_col)}")
    bars = [(lang, float(least * c)) for lang, c in zip(filters.languages, filters.cover)] if filters else []
    bars = docs.sparkSession.createDataFrame(bars, "lang_pred string, __bar double")  # a row per language
    judged = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).join(F.broadcast(bars), "lang_pred").where(F.col("score") >= F.col("__bar"))
    return judged.select(*[F.col(f"__{k}").alias(c) for k, c in enumerate(docs.columns)])
