import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from clipwright.llm.mixing import block_size, draw, mix, mix_report, mixed_documents, sized, targets
from clipwright.llm.permute import permute, round_keys

SCHEMA = "doc_id long, text string, source string, n_chars long, block int, words string"


def documents(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(i % 40)), f"s{i % 5}" if i % 3 else "hot", 0, 1, "x") for i in range(900)]
    rows += [(5000, None, "s0", None, 1, "x"), (5001, "a  b\tc d", None, 1, 1, "x"), (5001, "a  b\tc d", None, 1, 1, "x"), (5002, "", "empty", 0, 1, "x"), (5003, "w " * 30_000, "s1", 0, 1, "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    keys = round_keys(3, n)
    image = permute(np.arange(n), n, keys)
    assert sorted(image.tolist()) == list(range(n)) and (n < 60 or (image != np.arange(n)).mean() > 0.9)


def test_targets_and_draws():
    assert targets([("b", 100), ("a", 100), (None, 100)]) == {"a": 200.0, "b": pytest.approx(250 / 3), None: pytest.approx(500 / 3)}
    assert targets([]) == {} and targets([("a", 0)]) == {"a": 0.0}
    quotas = np.array([1000, 0, 3, 50_000])
    got = draw(quotas, 64, 1)
    assert (got.sum(axis=0) == quotas).all() and (got >= 0).all() and got.sum(axis=1).max() - got.sum(axis=1).min() <= 1


def test_report(spark):
    df, rows = documents(spark)
    got = mix_report(df, block_words=16, shards=8).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], size(r[1])) for r in rows)
    per = defaultdict(int)
    for r in rows:
        per[r[2]] += size(r[1])
    wanted, taken = targets(list(per.items())), defaultdict(int)
    source = {r[0]: r[2] for r in rows}
    for r in got:
        assert r.taken <= 2 * r["size"] and r.source_size == per[source[r.doc_id]] and r.target == pytest.approx(wanted[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - wanted[s]) <= 32 for s in per)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mix_report(df, block_words=16, shards=8).collect()))


def plainly_taken(spark, rows, block_words, shards, seed=17):
    """Words taken of each (source, doc_id, size), by walking through the slots one by one."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = [(r[0], r[2], size(r[1])) for r in rows]
    per = defaultdict(int)
    for _, s, n in sizes:
        per[s] += n
    wanted, order = targets(list(per.items())), sorted(per, key=lambda s: (s is None, s or ""))
    blocks = np.array([-(-per[s] // block_words) for s in order])
    quotas = np.array([round(wanted[s] * b / per[s]) if b else 0 for s, b in zip(order, blocks)])
    drawn, taken = draw(quotas, shards, seed), Counter()
    hashed = spark.createDataFrame([(k, d, n) for k, (d, _, n) in enumerate(sizes)], "k long, doc_id long, size long").selectExpr("k", "pmod(xxhash64(doc_id, size), 256)").collect()
    hashed = dict(map(tuple, hashed))
    for k, s in enumerate(order):
        line = sorted((i for i, x in enumerate(sizes) if x[1] == s and x[2]), key=lambda i: (hashed[i], sizes[i][0] is not None, sizes[i][0] or 0, sizes[i][2]))
        whose = [sizes[i] for i in line for _ in range(sizes[i][2])]
        for slot in range(int(drawn[:, k].sum())):
            turn, place = divmod(slot, int(blocks[k]))
            block = int(permute(np.array([place]), int(blocks[k]), round_keys(seed, k, turn))[0])
            taken.update(whose[block * block_words : (block + 1) * block_words])
    return taken


def test_taken_is_what_a_plain_walk_takes(spark):
    df, rows = documents(spark)
    taken = Counter()
    source = {r[0]: r[2] for r in rows}
    for r in mix_report(df, block_words=16, shards=8).collect():
        taken[r.doc_id, source[r.doc_id], r["size"]] += r.taken
    assert +taken == +plainly_taken(spark, rows, 16, 8)


def test_block_sizes():
    assert [block_size(n) for n in (0, 1, 10**5, 32 << 14, 64 << 14, 10**7, 10**12)] == [32, 32, 32, 32, 64, 512, 4096]


def test_rows_alike_are_placed_by_several_tasks_and_reruns_agree(spark):
    rows = [(None if i % 3 else i, "same four words here" if i % 3 else f"w{i} " * (i % 9), "s" if i % 4 else None, 0, 1, "x") for i in range(1200)]
    df = spark.createDataFrame(rows, SCHEMA)
    runs = [sorted(map(repr, mix_report(df.repartition(n), block_words=16, shards=4, hot_rows=h).collect())) for n, h in ((1, 100), (6, 100))]
    got = mix_report(df.repartition(3), block_words=16, shards=4, hot_rows=100).collect()
    assert runs[0] == runs[1] and len(got) == 1200 and all(r.taken <= 2 * r["size"] for r in got)
    per = defaultdict(lambda: [0, 0.0])
    for r in got:
        per[r.source_size][0] += r.taken
        per[r.source_size][1] = r.target
    assert all(abs(n - t) <= 32 for n, t in per.values())


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c", "s", "keep", 5), (2, None, None, "no", 6)], "doc_id long, text string, source string, uid string, size int").selectExpr("*", "uid as c0", "uid as taken", "size as runs")
    out = mixed_documents(df).collect()
    assert out and out[0].__fields__ == df.columns and {(r.doc_id, r.uid, r["size"], r.c0, r.taken, r.runs) for r in out} == {(1, "keep", 5, "keep", "keep", 5)}


def test_slots_hold_whole_blocks(spark):
    df, _ = documents(spark)
    _, pieces = mix(sized(df, "doc_id", "text", "source"), block_words=16, shards=8)
    rows = pieces.collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard, r.slot].append(r)
    for shard in range(8):
        held = sorted(s for j, s in slots if j == shard)
        assert held == list(range(len(held)))
    assert max(sum(p.words for p in s) for s in slots.values()) == 16
    assert sum(sum(p.words for p in s) < 16 for s in slots.values()) <= 2 * 8


def test_documents_hold_what_was_taken(spark):
    df, rows = documents(spark)
    taken = {(r.doc_id, r["size"]): r.taken for r in mix_report(df, block_words=16, shards=8).where("doc_id <> 5001").collect()}
    out = mixed_documents(df, block_words=16, shards=8).collect()
    assert out[0].__fields__ == df.columns
    got, text = Counter(), {r[0]: r[1] for r in rows}
    for r in out:
        got[r.doc_id] += len(r.text.split())
        assert set(r.text.split()) <= set(text[r.doc_id].split()) and r.n_chars == len(r.text)
    assert {k: v for k, v in got.items() if k != 5001} == {d: n for (d, _), n in taken.items() if n}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mix_report(df).collect() == [] and mixed_documents(df).collect() == []
