"""The pipeline's stages, each on what its predecessor kept, against plain rules."""

from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from clipwright.llm.mixing import targets
from clipwright.llm.shared import materialize
from clipwright.llm.tokens import encode, vocabulary_path

DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(materialize(stage(spark, out[-1], DIR), f"test-{k}"))
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language id", "exact dedup", "near dedup", "mix sources", "pack"] and corpus_pipeline.ORACLE_SQL is None


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages[0].collect(), stages[1].collect()
    assert after[0].__fields__ == COLUMNS and set(after) <= set(before)
    lettered = [r for r in before if r.text and any(c.isalpha() for c in r.text)]
    assert len(after) >= 0.98 * len(lettered) and all(r.text and any(c.isalpha() for c in r.text) for r in after)


def test_exact_stage(stages):
    best = {}
    for r in stages[1].collect():
        best[r.text] = max(best.get(r.text, r), r, key=lambda x: x.doc_id)
    assert sorted(stages[2].collect()) == sorted(best.values())


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def linked_by_hand(rows):
    """doc_ids that stay when texts of an exact similarity of 0.8 or more are linked and each group keeps its smallest."""
    sets = {r.doc_id: shingles(r.text) for r in rows}
    label, ids = {d: d for d in sets}, sorted(sets)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    links = 0
    for k, a in enumerate(ids):
        for b in ids[:k]:
            p, q = sets[a], sets[b]
            if min(len(p), len(q)) >= 0.8 * max(len(p), len(q)):
                common = len(p & q)
                if common >= 0.8 * (len(p) + len(q) - common):
                    low, high = sorted((root(a), root(b)))
                    label[high] = low
                    links += 1
    return {d for d in ids if root(d) == d}, links


def test_near_stage(stages):
    after = stages[3].collect()
    assert stages[3].columns == COLUMNS and {r.doc_id for r in after} == linked_by_hand(stages[2].collect())[0] and len(after) == len({r.doc_id for r in after})


def test_near_stage_on_more_documents(spark):
    docs = corpus_pipeline.STAGES[1][1](spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null"), DIR)
    docs = materialize(docs, "test-distinct")
    want, links = linked_by_hand(docs.collect())
    assert links > 0 and {r.doc_id for r in corpus_pipeline.STAGES[2][1](spark, docs, DIR).collect()} == want


def test_mixing_stage(stages):
    before, after = stages[3].collect(), stages[4].collect()
    assert stages[4].columns == COLUMNS
    size, taken, source = Counter(), Counter(), {}
    for r in before:
        size[r.doc_id], source[r.doc_id] = len(r.text.split()), r.source
    for r in after:
        taken[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert all(taken[d] <= 2 * size[d] for d in size)
    per, got = Counter(), Counter()
    for d, s in source.items():
        per[s] += size[d]
        got[s] += taken[d]
    wanted = targets(list(per.items()))
    assert all(abs(got[s] - wanted[s]) <= 256 for s in per)


def test_packing_stage(stages):
    rows = stages[5].collect()
    want = Counter()
    for r in stages[4].collect():
        want[r.doc_id] += len(encode(r.text, vocabulary_path()))
    held, sequences = Counter(), defaultdict(list)
    for r in rows:
        held[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert held == want
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0, *(n for _, n in s[:-1])]).tolist() and sum(n for _, n in s) <= 1024


@pytest.mark.parametrize("k", range(5))
def test_stages_on_an_empty_table(spark, k):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, extra int")
    out = corpus_pipeline.STAGES[k][1](spark, docs, DIR)
    assert out.collect() == [] and (k == 4 or out.columns == docs.columns)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_nulls_repeats_and_clashing_names(spark, k):
    base = spark.read.parquet(f"{DIR}/documents.parquet").selectExpr("*", "text as id", "doc_id as uid", "source as digest", "lang as lang_pred", "1 as score", "map('a', 1) as node", "2 as c0", "3 as taken", "'p' as piece")
    odd = base.limit(3).selectExpr("cast(null as long) as doc_id", "text", "cast(null as string) as lang", "cast(null as string) as source", "cast(null as long) as n_chars", *[f"`{c}`" for c in base.columns[5:]])
    blank = base.limit(2).selectExpr("doc_id", "cast(null as string) as text", *[f"`{c}`" for c in base.columns[2:]])
    docs = materialize(base.unionByName(base.limit(5)).unionByName(odd).unionByName(odd).unionByName(blank), "test-odd")
    out = materialize(corpus_pipeline.STAGES[k][1](spark, docs, DIR), "test-stage")
    assert out.count() > 100 and (k == 4 or out.columns == docs.columns)
    if k < 3:  # what stays is as it came
        key = lambda r: (repr(r.doc_id), r.id, r.uid, r.digest, r.lang_pred, r.score, r.c0, r.taken, r.piece)
        assert {key(r) for r in out.collect()} <= {key(r) for r in docs.collect()}


def test_run_is_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, DIR).count() == stages[5].count()
