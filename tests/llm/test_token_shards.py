import zlib
from collections import Counter

import numpy as np
import pytest

from clipwright.llm.permute import permute, round_keys
from clipwright.llm.token_shards import read_from, shards, write_shards
from clipwright.llm.tokens import encode, vocabulary_path


def documents(spark):
    texts = [(i, f"text {i} " * (i % 60)) for i in range(300)] + [(900, None), (901, ""), (902, "very long " * 30_000), (7, "again"), (None, "no id")]
    return spark.createDataFrame([(i, t, 0, "x") for i, t in texts], "doc_id long, text string, slot int, ids string").repartition(4), texts


def test_round_trip(spark, tmp_path):
    df, texts = documents(spark)
    write_shards(df, f"{tmp_path}/out", length=64, shard_rows=32, shards_per_task=3)
    stored = spark.read.parquet(f"{tmp_path}/out")
    rows = stored.orderBy("shard").collect()
    assert [r.shard for r in rows] == list(range(len(rows))) and all(r.first_slot == 32 * r.shard and r.sequences == 32 for r in rows[:-1])
    assert all(zlib.crc32(r.payload) == r.payload_crc32 and len(r.payload) == r.sequences * r.stride == r.sequences * 128 for r in rows)
    read = read_from(stored, shard_rows=32).collect()
    assert [r.slot for r in read] == list(range(len(read)))
    found = Counter()
    for r in read:
        ids = np.frombuffer(r.ids, "<u2")
        assert (ids[r.length :] == 2).all()
        found[r.doc_id, r.part, tuple(ids[: r.length].tolist())] += 1
    want = Counter()
    for i, t in texts:
        ids = encode(t, vocabulary_path()).tolist()
        want.update((i, k // 64, tuple(ids[k : k + 64])) for k in range(0, len(ids), 64))
    assert found == want
    places = [(-1 if r.doc_id is None else r.doc_id, r.part) for r in read]
    assert abs(np.corrcoef(range(len(places)), [p[1] for p in places if True])[0, 1]) < 0.1
    later = read_from(stored, 1000, shard_rows=32).collect()
    assert later == read[1000:]


def test_seed_decides_the_order(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string").coalesce(1)
    order = lambda seed: [r.doc_id for r in read_from(shards(df, length=8, seed=seed)).collect()]
    one = order(1)
    assert one == order(1) and one != order(2) and sorted(one) == list(range(100)) and one != list(range(100))


def test_same_shards_from_any_partitioning(spark):
    df, _ = documents(spark)
    df = df.unionByName(df.where("doc_id < 40"))
    found = [list(map(tuple, shards(df.repartition(n), length=64, shard_rows=32).orderBy("shard").collect())) for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) > 10


def test_slots_are_the_permutation_of_a_plain_order(spark):
    df, texts = documents(spark)
    keyed = spark.createDataFrame([(i, t or "", k) for i, t in texts for k in range(-(-len(encode(t, vocabulary_path())) // 64))], "doc_id long, text string, part int")
    keyed = keyed.selectExpr("doc_id", "xxhash64(text) as digest", "part").selectExpr("pmod(xxhash64(doc_id, digest, part), 8)", "doc_id", "digest", "part").collect()
    plain = sorted(map(tuple, keyed), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3]))
    slots = permute(np.arange(len(plain)), len(plain), round_keys(5))
    want = {int(s): (r[1], r[3]) for s, r in zip(slots, plain)}
    got = {r.slot: (r.doc_id, r.part) for r in read_from(shards(df, length=64, shard_rows=32), shard_rows=32).collect()}
    assert got == want


def test_ids_too_large_for_the_width(spark):
    df = spark.createDataFrame([(1, "some text with large ids")], "doc_id long, text string")
    with pytest.raises(Exception, match="needs more than 1 bytes"):
        shards(df, width=1).collect()
    row = shards(df, width=4, length=8).head()
    assert np.frombuffer(row.payload, "<u4")[: row.lengths[0]].tolist() == encode("some text with large ids", vocabulary_path()).tolist()[:8]


def test_empty(spark):
    assert shards(spark.createDataFrame([], "doc_id long, text string")).collect() == []
