import random
import zlib
from collections import Counter

import numpy as np

from clipwright.llm.langid import SPAN, Filters, gathered, grams, identify, keep_identified

SYLLABLES = {"aa": ["ka", "to", "mi", "ren", "sol"], "bb": ["ble", "shu", "ing", "or", "wex"], "cc": ["жи", "ша", "ров", "на", "ко"]}
SCHEMA = "doc_id long, text string, lang string, lang_pred int, score string, source string"


def sentence(lang, n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 4))) for _ in range(n))


def documents(spark):
    rows = [(i, sentence(lang, 30 + i % 50, i), lang, 1, "x", "s") for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(900, None, "aa", 1, "x", "s"), (901, "12 ! 34", "aa", 1, "x", "s"), (902, "", None, 1, "x", None), (903, "zq " * 500, None, None, "x", "s"), (None, sentence("bb", 40, 5), "aa", 1, "x", "s"), (904, sentence("cc", 90_000, 4), None, 1, "x", "s")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


def test_grams_are_those_of_a_plain_loop():
    for text in ("", "Ab c", "ñÑ 1x", "a" * 300_000 + "B", "𝔘b", "İx"):
        low = "".join(c if c.isalpha() else "\0" for c in text.lower())
        want = [tuple(map(ord, ("\0" + low + "\0")[i : i + 3])) for i in range(len(low)) if low[i] != "\0"]
        found = np.concatenate([*grams(text), np.zeros(0, np.uint64)])
        assert [(int(g) >> 42, int(g) >> 21 & 0x1FFFFF, int(g) & 0x1FFFFF) for g in found] == want


def test_texts_read_together_give_what_each_gives():
    texts = ["Ab c", None, "ΑΣ", "Σ" * 3, "", "x" * (SPAN + 9), "İx 1", "12", "n" * SPAN, "ñu"]
    found = {}
    for first, keys, sizes in gathered(iter(texts)):
        for k, part in enumerate(np.split(keys, np.cumsum(sizes)[:-1])):
            found.setdefault(first + k, []).append(part)
    assert sorted(found) == list(range(len(texts)))
    for k, text in enumerate(texts):
        assert np.array_equal(np.concatenate(found[k]), np.concatenate([*grams(text), np.zeros(0, np.uint64)]))


def test_labels_and_scores_are_those_of_plain_sets(spark):
    """With filters too large for a false positive, every score is a share of the text's trigrams."""
    df, rows = documents(spark)
    labelled = [(str(r[0]), r[1], r[2]) for r in rows if r[0] is not None and r[1] is not None and r[2] and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    seen = {lang: Counter() for lang in SYLLABLES}
    for _, text, lang in labelled:
        seen[lang].update(np.concatenate([*grams(text), np.zeros(0, np.uint64)]).tolist())
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items() if n > 1} for lang, c in seen.items()}
    top = {g: max(r.get(g, 0) for r in rate.values()) for r in rate.values() for g in r}
    own = {lang: {g for g, x in r.items() if x >= 0.1 * top[g]} for lang, r in rate.items()}
    got = {r.doc_id: r for r in identify(df, positions=1 << 20).collect()}
    for doc_id, text, *_ in rows:
        keys = np.concatenate([*grams(text), np.zeros(0, np.uint64)]).tolist()
        shares = [(sum(k in own[lang] for k in keys) / len(keys), lang) for lang in sorted(own)] if keys else [(0.0, "und")]
        best = max(shares, key=lambda x: x[0])
        assert got[doc_id].lang_pred == best[1] and abs(got[doc_id].score - best[0]) < 1e-3


def test_filters_return_every_language_of_a_key():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 1 << 62, 500, dtype=np.uint64) for _ in range(70)]
    f = Filters([str(k) for k in range(70)], np.zeros((1 << 14, 2), np.uint64), 4)
    for k, s in enumerate(sets):
        f.add(k, s)
    for k in (0, 63, 64, 69):
        assert (f.having(sets[k])[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).all()
        assert f.popcounts(np.concatenate((sets[k], sets[1])), np.array([0, 500, 0, 500]))[:, k].tolist()[:3] == [0, 500, 0]
    other = rng.integers(0, 1 << 62, 20_000, dtype=np.uint64)
    assert np.allclose(f.popcounts(other, np.array([20_000]))[0] / 20_000, f.false_positives(), atol=0.01)


def test_held_out_accuracy(spark):
    df, rows = documents(spark)
    got = {r.doc_id: r for r in identify(df, positions=1 << 14).collect()}
    assert len(got) == len(rows)
    for doc_id, _, lang, *_ in rows[:180]:
        r = got[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1) and r.lang_pred == lang and 0.5 < r.score <= 1
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[903].score < 0.5 and got[904].lang_pred == "cc" and got[None].lang_pred == "bb" and got[None].held_out is False


def test_stage_keeps_clean_rows_whole(spark):
    df, rows = documents(spark)
    kept = keep_identified(df, positions=1 << 14)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([r for r in rows if r[0] not in (900, 901, 902, 903)], key=repr)


def test_rare_language_is_learned_and_kept(spark):
    many = spark.range(200_000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 6), k -> element_at(array('kato', 'miren', 'solka', 'tomi'), cast(pmod(xxhash64(id, k), 4) + 1 AS int)))) AS text", "'aa' AS lang")
    few = [d for d in range(300_000, 300_100) if zlib.crc32(str(d).encode()) % 3 != 1][:2]  # 1 in 100,000, not held out
    few = spark.createDataFrame([(d, sentence("cc", 60, d), "cc") for d in few], "doc_id long, text string, lang string")
    docs = many.unionByName(few)
    options = {"fit_rows": 200, "positions": 1 << 14}
    found = identify(docs, **options).where("doc_id >= 300000").collect()
    assert [r.lang_pred for r in found] == ["cc", "cc"]
    assert keep_identified(docs, **options).where("doc_id >= 300000").count() == 2


def test_language_of_many_ngrams_is_kept(spark):
    rows = [(i, sentence("aa", 40, i), "aa") for i in range(90)]
    rnd = random.Random(2)
    rows += [(1000 + i, " ".join("".join(chr(0x4E00 + min(rnd.randrange(60), rnd.randrange(60))) for _ in range(3)) for _ in range(200)), "zz") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert keep_identified(docs, per_language=1000, positions=1 << 14).count() == 180  # few of the n-grams fit


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None, 1, "x", None)], SCHEMA)
    assert [tuple(r) for r in identify(df).collect()] == [(1, zlib.crc32(b"1") % 3 == 1, "und", 0.0)]
    assert identify(spark.createDataFrame([], SCHEMA)).collect() == []
