import random
import re

import numpy as np
import pytest
import xxhash

from clipwright.llm.components import connected_components
from clipwright.llm.simhash import counted, drop_near_copies, fingerprint, linked, near_bands, near_counts, near_duplicates, similar, vote


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    prints = [plain(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, f"{prints[i]:016x}", low[root(i)]) for i, (d, _) in enumerate(rows))


def test_fingerprint_is_the_plain_one():
    for t in (None, "", " \t\n", "One", "one TWO", "Ähnlich ÄPFEL x a\u0085b c", "a b c d e " * 50, "w" * 300_000):
        assert int(fingerprint(t)[0]) == plain(t) == int(fingerprint(t, width=3)[0])
    long = " ".join(map(str, range(70_000)))
    assert int(fingerprint(long)[0]) == plain(long)


def test_components_match_brute_force(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(150):
        base = [rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 5, 60, 200]))]
        rows.append((i * 3, " ".join(base)))
        for j in range(rnd.choice([0, 0, 1, 6])):
            near = list(base)
            if near:
                near[rnd.randrange(len(near))] = "changed"
            rows.append((1000 + len(rows), " ".join(near)))
    rows.append((7777, None))
    df = spark.createDataFrame([(d, t, 0, 1) for d, t in rows], "doc_id long, text string, fp int, n int").repartition(3)
    got = near_duplicates(df, tile_rows=16).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_counts_of_sections(spark):
    prints = [0, (1 << 64) - 1, 1 << 63, 0x8000000180000001, *np.random.default_rng(2).integers(0, 1 << 63, 40).tolist()]
    df = spark.createDataFrame([(k, int(p).to_bytes(8, "big")) for k, p in enumerate(prints)], "k int, fp binary")
    for bits in ([64], [32, 32], [22, 21, 21]):
        got = dict(map(tuple, df.select("k", counted(bits)).collect()))
        for k, p in enumerate(prints):
            want, weight = 0, 1
            for n in bits:
                want, weight, p = want + (p & ((1 << n) - 1)).bit_count() * weight, weight * (n + 1), p >> n
            assert got[k] == want
        codes = np.unique(list(got.values()))
        split = [[c // int(np.prod([b + 1 for b in bits[:i]])) % (bits[i] + 1) for i in range(len(bits))] for c in codes.tolist()]
        pairs = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in near_counts(codes, bits, 5)))}
        assert pairs == {(i, j) for j in range(len(codes)) for i in range(j + 1) if sum(abs(x - y) for x, y in zip(split[i], split[j])) <= 5}
    assert {tuple(p) for p in np.transpose(near_bands(np.array([0, 3, 4, 9]), 4))} == {(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2), (3, 3)}


@pytest.mark.parametrize("bits,rows", [([64], 16), ([32, 32], 4), ([22, 21, 21], 2)])
def test_tiles_lose_no_link(spark, bits, rows):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    prints = np.unique(np.concatenate([seeds, seeds ^ np.uint64(7), seeds ^ np.uint64(1 << 40), rng.integers(0, 1 << 63, 200, dtype=np.uint64)]))
    nodes = spark.createDataFrame([(int(p).to_bytes(8, "big"), i) for i, p in enumerate(prints)], "fp binary, rep long")
    nodes = nodes.select("fp", counted(bits).alias("cell"), "rep")
    got = {tuple(r) for r in connected_components(linked(nodes, 3, rows, lambda codes: near_counts(codes, bits, 3))).collect()}
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    reach = near
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    low = reach.argmax(axis=1)
    assert {(n, c) for n, c in got if n != c} == {(i, int(m)) for i, m in enumerate(low) if i != m}


def test_stage_drops_near_copies_and_keeps_the_rest(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows, clean, near = [], [], []
    for i in range(120):
        base = rnd.choices(words, k=rnd.choice([30, 120, 600]))
        rows.append((i, " ".join(base), 0, "x"))
        clean.append(i)
        if i % 4 == 0:
            for k in range(3):
                copy = list(base)
                copy[k if k < 2 else len(copy) - 1] = "changed"  # at most 2 of 26 shingles: similarity 0.85 and more
                rows.append((1000 + 10 * i + k, " ".join(copy), 0, "x"))
                near.append(rows[-1][0])
        half = base[: len(base) // 2] + rnd.choices(words, k=len(base) // 2)
        rows.append((5000 + i, " ".join(half), 0, "x"))
        clean.append(5000 + i)
    rows += [(9000, None, 0, "x"), (9001, " ", 0, "x"), (None, "w1 w2", 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id string").repartition(3)
    out = drop_near_copies(df)
    left = {r.doc_id for r in out.collect()}
    assert out.columns == df.columns and left >= {*clean, 9000, None} and 9001 not in left
    assert len(left & set(near)) <= 0.03 * len(near)


def test_stage_links_at_exact_similarity(spark):
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(60):
        base = rnd.choices(words, k=rnd.choice([9, 60, 150, 300])) + ["and so on"] * rnd.choice([0, 0, 40])
        rows.append((i, " ".join(base)))
        for k in range(3):  # each change takes about 5 shingles on both sides: similarities of 0.7 to 0.9
            copy = list(base)
            for at in rnd.sample(range(len(base)), max(1, int(len(base) * rnd.uniform(0.01, 0.036)))):
                copy[at] = "changed"
            rows.append((1000 + 3 * i + k, " ".join(copy if k else base[:-1])))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for _, t in rows]
    label, band = list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            likeness = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            band += 0.75 <= likeness <= 0.85
            if likeness >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    want = {min(d for (d, _), y in zip(rows, label) if y == x) for x in set(label)}
    left = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert band > 20 and sorted(r.doc_id for r in left) == sorted(want)


def altered(base, similarity, rnd):
    """A copy with single words changed, far apart, to a 5-word Jaccard similarity just above the given one."""
    n, step = len(base) - 4, 5
    copy = list(base)
    for k in range(0, len(base) - 10, 10):
        copy[k + step] = f"changed{rnd.random()}"
        gone = 5 * (k // 10 + 1)
        if (n - gone - 5) / (n + gone + 5) < similarity:
            break
    return copy


def test_recall_by_band(spark):
    """Of pairs in each band of exact similarity, the share of which only one document stays; below 0.8 both stay."""
    rnd = random.Random(21)
    rows, pairs = [], []
    for i in range(700):
        base = [f"w{rnd.randrange(10**9)}" for _ in range(rnd.choice([110, 250, 900]))]
        copy = altered(base, rnd.uniform(0.7, 0.97), rnd)
        a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (base, copy))
        pairs.append((len(a & b) / len(a | b), 2 * i, 2 * i + 1))
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    left = {r.doc_id for r in drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 1.01)):
        some = [(a, b) for s, a, b in pairs if low <= s < high]
        assert len(some) > 40 and sum(a in left and b not in left for a, b in some) >= 0.99 * len(some)
    assert all(a in left and b in left for s, a, b in pairs if s < 0.8)


def test_rows_that_share_a_doc_id_are_compared_each_by_itself(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(40))
    rows = [(1, text("a"), "x"), (1, text("b"), "y"), (1, text("b"), "y"), (None, text("c"), "z"), (None, text("d"), "z"), (None, text("b") + " more", "z"), (2, text("a") + " more", "z"), (3, None, "n"), (4, "", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string").withColumnsRenamed({"id": "digest"})
    out = drop_near_copies(df.selectExpr("doc_id", "text", "digest", "digest as node", "map('k', digest) as order"))
    assert out.columns == ["doc_id", "text", "digest", "node", "order"]
    assert sorted(((r.doc_id, (r.text or "")[:2], r.node) for r in out.collect()), key=repr) == sorted([(1, "aw", "x"), (1, "bw", "y"), (None, "cw", "z"), (None, "dw", "z"), (3, "", "n")], key=repr)


def test_blocks_of_a_large_component(spark):
    """A group far larger than a block: copies of one text, a chain that leaves it link by link, and strangers near it."""
    rng, rnd = np.random.default_rng(6), random.Random(6)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = []
    for k in range(120):
        sets.append(np.concatenate((base[:190], rng.integers(0, 1 << 63, 10, dtype=np.uint64))))
    for k in range(40):
        sets.append(np.concatenate((base[: 180 - k], rng.integers(0, 1 << 63, 20 + k, dtype=np.uint64))))
    chain = base
    for k in range(30):
        chain = np.concatenate((chain[10:], rng.integers(0, 1 << 63, 10, dtype=np.uint64)))
        sets.append(chain)
    sets = [np.unique(s) for s in sets]
    rnd.shuffle(sets)
    rows = [(7, i, vote([s], 4).astype(">u8").tobytes(), len(s), s.astype("<u8").tobytes()) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "component long, node long, fp binary, size long, hashes binary").repartition(3)
    found = dict(map(tuple, connected_components(similar(df, 0.8, 256, 64, 4, block_rows=16, pivots=2)).collect()))
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if common / (len(sets[i]) + len(sets[j]) - common) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert 10 < len(set(label)) < 60 and [found.get(i, i) for i in range(len(sets))] == [label.index(x) for x in label]


def test_components_of_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {n: got.get(n, n) for n in list(range(301)) + list(range(1000, 1400))} == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1400)}}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).collect() == [] and drop_near_copies(df).collect() == []
