"""URL filters: a sorted array of 64-bit digests, memory-mapped, probed by binary search, confirmed by the strings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.llm.shared import discard, distribute, materialize

#: (host, path, verdict); a rule holds for the host, its subdomains, and paths that start with its path.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ?, # or the end, A-Z lower-cased; without ://, or null: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*+)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*+([^?#]*+)", 1), F.lit(""))


def digests(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def layout(found: np.ndarray, keys: list[bytes], values: np.ndarray) -> bytes:
    """A shard of the index: the number of entries, their digests in ascending order, their values, where each one's
    string ends, and the strings."""
    order = np.argsort(found, kind="stable")
    keys = [keys[k] for k in order]
    arrays = [np.array([len(keys)], "<u8"), found[order].astype("<u8"), values[order].astype("<i8"), np.cumsum([0, *map(len, keys)]).astype("<i8")]
    return b"".join([a.tobytes() for a in arrays] + keys)


class Shard:
    """A layout's file, mapped into memory: the system loads the pages that probes touch, once for all workers."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        n = int(data[:8].view("<u8")[0])
        at = lambda k, count: data[8 + 8 * k : 8 + 8 * (k + count)]
        self.digests, self.values, self.ends, self.text = at(0, n).view("<u8"), at(n, n).view("<i8"), at(2 * n, n + 1).view("<i8"), data[8 * (3 * n + 2) :]

    def find(self, keys: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Each key's value, -1 where it isn't in the shard. Equal digests lie together; the strings decide."""
        out = np.full(len(keys), -1, np.int64)
        at = np.searchsorted(self.digests, hashes)
        open_ = np.nonzero(at < len(self.digests))[0]
        while len(open_):
            open_ = open_[self.digests[at[open_]] == hashes[open_]]
            for k in open_:
                if self.text[self.ends[at[k]] : self.ends[at[k] + 1]].tobytes() == keys[k]:
                    out[k] = self.values[at[k]]
            at[open_] += 1
            open_ = open_[(out[open_] < 0) & (at[open_] < len(self.digests))]
        return out


class Index:
    """Shards by range of digests; a shard is opened when a key falls into its range."""

    def __init__(self, firsts: np.ndarray, names: list[str], path: Callable[[str], str]):
        self.firsts, self.names, self.path, self.open = firsts, names, path, {}

    def find(self, keys: list[bytes]) -> np.ndarray:
        hashes, out = digests(keys), np.full(len(keys), -1, np.int64)
        where = np.searchsorted(self.firsts, hashes, side="right") - 1
        for k in np.unique(where[where >= 0]).tolist():
            if k not in self.open:
                self.open[k] = Shard(self.path(self.names[k]))
            at = np.nonzero(where == k)[0]
            out[at] = self.open[k].find([keys[i] for i in at], hashes[at])
        return out


def publish(entries: DataFrame, shard_bytes: int = 1 << 24) -> tuple[np.ndarray, list[str]]:
    """Index entries (key: binary, value: long; of equal keys the least value) and have Spark hand the index to every
    executor: the first digest of each shard, and the shards' file names there.

    Spark digests, ranges and sorts the entries; the finished shards pass through the driver one at a time into the
    shared folder, and the driver keeps their names and first digests.
    """
    spark = entries.sparkSession
    once = entries.groupBy("key").agg(F.min("value").alias("value"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = digests(batch.column(0).to_pylist()) ^ np.uint64(1 << 63)  # in order as signed numbers
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], ["key", "value", "digest"])

    stored = materialize(once.mapInArrow(digest, "key binary, value long, digest long"), "url-entries")
    size = stored.agg(F.sum(F.octet_length("key") + 24)).head()[0] or 0

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [b for b in batches if b.num_rows]
        if whole:
            table = pa.Table.from_batches(whole)
            found = table.column("digest").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
            content = layout(found, table.column("key").to_pylist(), table.column("value").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

    ranged = stored.repartitionByRange(max(1, size // shard_bytes), "digest")
    built = materialize(ranged.mapInArrow(shard, "content binary"), "url-shards")
    shards = deliver(spark, (row["content"] for row in built.toLocalIterator()))
    discard(stored, built)
    return shards


def deliver(spark: SparkSession, contents: Iterable[bytes]) -> tuple[np.ndarray, list[str]]:
    """Hand each shard to the executors: first digests and file names."""
    firsts, names = [], []
    for content in contents:
        names.append(distribute(spark, [content], "index"))
        firsts.append(np.frombuffer(content, "<u8", 1, 8))
    order = np.argsort(np.concatenate([*firsts, np.zeros(0, "<u8")]), kind="stable").tolist()
    return np.array([firsts[k][0] for k in order], np.uint64), [names[k] for k in order]


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[tuple[str, str]]:
    """What rules may be named that fit: the host and its parents by label, with the path's beginnings of known lengths."""
    at = 0
    while True:
        for n in lengths:
            if n <= len(path):
                yield host[at:], path[:n]
        at = host.find(".", at) + 1
        if not at:
            return


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES, blocked: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """One row per input row: page_id, host, path, rule (host and path of the one that decides, or null), verdict.

    A rule fits its host and all subdomains if the url's path starts with the rule's; of those that fit, the longest
    wins (ties: the longer host). Where none fits, the verdict is `block` for urls in `blocked`, a table whose first
    column holds whole urls as they stand (nulls and repeats don't matter), and `default` for all others. Rules and list
    are one index on disk, whose size bounds nothing but the executors' disks. Null urls and those without :// have
    empty host and path, which no rule with a path fits; a null url is in no list; repeated rows are judged alike; an
    empty table gives an empty result; other columns are not looked at.
    """
    spark = pages.sparkSession
    keys = [f"r{h}\0{p}".encode() for h, p, _ in rules]
    listed = blocked is not None
    if listed:
        entries = spark.createDataFrame(list(zip(keys, range(len(keys)))), "key binary, value long")
        url = F.col(f"`{blocked.columns[0]}`").cast("string")
        entries = entries.unionByName(blocked.where(url.isNotNull()).select(F.encode(F.concat(F.lit("u"), url), "utf-8").alias("key"), F.lit(len(rules)).cast("long").alias("value")))
        firsts, names = publish(entries)
    else:
        firsts, names = deliver(spark, [layout(digests(keys), keys, np.arange(len(keys)))] if keys else [])
    lengths = sorted({len(p) for _, p, _ in rules})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(firsts, names, SparkFiles.get)
        for batch in batches:
            host, path, url = (batch.column(k).to_pylist() for k in (1, 2, 3))
            keys, owner = [], []
            for k, (h, p) in enumerate(zip(host, path)):
                for a, b in candidates(h, p, lengths):
                    keys.append(f"r{a}\0{b}".encode("utf-8", "surrogatepass"))
                    owner.append(k)
            best: dict[int, tuple] = {}
            for k, value in zip(owner, index.find(keys).tolist()):
                if value >= 0:
                    h, p, _ = rules[value]
                    best[k] = max(best.get(k, (-1,)), (len(h) + len(p), len(h), value))
            hit = index.find([b"-" if u is None else b"u" + u.encode("utf-8", "surrogatepass") for u in url]) >= 0 if listed else np.zeros(len(url), bool)
            chosen = [rules[best[k][2]] if k in best else None for k in range(len(url))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array([c and c[0] + c[1] for c in chosen], pa.string()),
                pa.array([c[2] if c else "block" if h else default for c, h in zip(chosen, hit)], pa.string()),
            ], ["page_id", "host", "path", "rule", "verdict"])

    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), url.alias("url"))
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
