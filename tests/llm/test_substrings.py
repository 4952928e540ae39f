import random
import re
from collections import Counter

import numpy as np
import pytest

from clipwright.llm.shared import materialize
from clipwright.llm.substrings import chunk_of, least, opened, packed, remove_repeats, unpacked, words


def brute(rows, width):
    seen = Counter()
    cut = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for w in cut:
        seen.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    want = []
    for (d, _), w in zip(rows, cut):
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        want.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(want, key=repr)


def rows():
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["ñandú", "日本", "a\u0085b", " ", "𝔘"]
    common = rnd.choices(vocabulary, k=50)
    out = []
    for i in range(240):
        w = rnd.choices(vocabulary, k=rnd.choice([0, 3, 7, 8, 30, 150]))
        if i % 5 == 0:
            at = rnd.randrange(len(w) + 1)
            w[at:at] = common[rnd.randrange(20) : 20 + rnd.randrange(30)]
        if i % 17 == 0:
            w = w + ["again"] * rnd.randrange(40)
        out.append((i, rnd.choice([" ", "  ", "\n", "\t\x0b"]).join(w)))
    return out + [(900, out[5][1]), (900, out[5][1]), (901, None), (902, ""), (903, " \n "), (None, " ".join(common)), (904, " ".join(map(str, range(70_000))) + " " + " ".join(common)), (905, "x" * 3_000_000 + " " + " ".join(common))]


@pytest.mark.parametrize("bits,chunk,parts,gram", [(28, 1 << 21, 3, 4), (8, 200, 5, 2), (16, 50, 1, 16), (4, 50, 4, 1)])
def test_matches_brute_force(spark, bits, chunk, parts, gram):
    data = rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in data], "doc_id long, text string, chunk int, kept_text string").repartition(parts)
    got = remove_repeats(materialize(df, "test"), width=8, gram=gram, most_bits=bits, chunk_words=chunk)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data, 8)


def test_a_sketch_on_disk_is_the_one_in_memory(spark, monkeypatch):
    from clipwright.llm import substrings

    monkeypatch.setattr(substrings, "SLICE", 9)
    data = rows()
    df = materialize(spark.createDataFrame(data, "doc_id long, text string").repartition(3), "test")
    held, mapped = (opened(*substrings.sketch(df, 8, 3, 16, 500, 4, held_bits=h)) for h in (28, 15))
    assert isinstance(mapped.rows[0], np.memmap) and all(np.array_equal(a, b) and a.any() for a, b in zip(held.rows, mapped.rows))
    few = materialize(spark.createDataFrame([(1, "a b c d e f g h i"), (2, "a b c d e f g h j")], "doc_id long, text string"), "test")
    held, mapped = (opened(*substrings.sketch(few, 8, 3, 16, 500, 4, held_bits=h)) for h in (28, 15))
    assert all(np.array_equal(a, b) and a.any() and len(a) == 1 << 13 for a, b in zip(held.rows, mapped.rows))
    got = remove_repeats(df, width=8, gram=3, held_bits=4, chunk_words=300)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data, 8)


def test_empty(spark):
    assert remove_repeats(materialize(spark.createDataFrame([], "doc_id long, text string"), "test")).collect() == []


def test_words_and_packing():
    text = "  abé c\x0b\x0cdd  " + "y" * 2_000_000 + " z" * 900_000
    starts, hashes = words(np.frombuffer(text.encode(), np.uint8), 2)
    want = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text.encode())]
    assert starts.tolist() == want and all(len(set(h[-900_000:].tolist())) == 1 for h in hashes) and hashes[0][0] != hashes[1][0]
    for a in ([], [0], [5, 9, 70_000], [1, 2, 3, 4_000_000]):
        assert unpacked(packed(np.array(a, np.int64))).tolist() == a == unpacked(packed(np.array(a, np.int64), 1 << 22)).tolist()
    assert unpacked(packed(np.arange(1, 64, 2), 64)).tolist() == list(range(1, 64, 2))


def test_least():
    values = np.random.default_rng(1).integers(0, 99, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 16, 20, 200):
        assert least(values, width).tolist() == [min(values[i : i + width]) for i in range(201 - width)]


def test_sketch_merges_in_rounds_and_never_counts_low(spark, monkeypatch):
    from clipwright.llm import substrings

    monkeypatch.setattr(substrings, "FAN", 2)
    data = [(i, " ".join(str(k % 97) for k in range(i, i + 60))) for i in range(40)]
    df = materialize(spark.createDataFrame(data, "doc_id long, text string").repartition(6), "test")
    merged = opened(*substrings.sketch(df, 8, 3, 12, 50, 9))
    seen = Counter(tuple(t.split()[i : i + 8]) for _, t in data for i in range(53))
    for _, t in data:
        found = chunk_of(0, [t.encode()], 8, 3)
        estimated = merged.repeated(found.anchors)[found.anchor_of]
        assert all(estimated[i] for i in range(53) if seen[tuple(t.split()[i : i + 8])] > 1)


def test_equal_windows_have_anchors_of_their_own():
    text = " ".join(["a b"] * 30 + [str(i) for i in range(40)] + ["a b"] * 20).encode()
    found = chunk_of(0, [text, b"", b"1 2", text], 8, 3)
    counts, seen = Counter(found.anchors.tolist()), Counter(found.hashes[1].tolist())
    assert len(found.anchor_of) == found.lengths.sum() == 2 * 133 and found.words.tolist() == [140, 0, 2, 140]
    assert all(counts[int(found.anchors[a])] >= n for a, n in ((a, seen[h]) for a, h in zip(found.anchor_of, found.hashes[1].tolist())) if n > 1)


def test_few_unique_windows_pass_a_small_sketch(spark):
    from clipwright.llm import substrings

    rnd = random.Random(4)
    texts = [" ".join(str(rnd.randrange(1 << 40)) for _ in range(4000)) for _ in range(10)]
    df = materialize(spark.createDataFrame(enumerate(texts), "doc_id long, text string"), "test")
    merged = opened(*substrings.sketch(df, 35, 16, 15, 20_000, 4))  # fewer cells a row than there are windows
    found = [chunk_of(0, [t.encode()], 35, 16) for t in texts]
    passed = sum(int(merged.repeated(f.anchors)[f.anchor_of].sum()) for f in found)
    assert 39_000 < sum(len(f.anchor_of) for f in found) and passed < 0.05 * 39_000
