from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from clipwright.llm.exact_dedup import drop_exact_copies, exact_groups

ROWS = [(1, "a", "x", 5), (2, "a", "y", 6), (3, None, "z", 7), (4, "", "z", 8), (5, "A", None, None), (6, "a" * 300_000, "k", 1), (7, "a" * 300_000, "k", 1), (7, "a" * 300_000, "k", 1), (None, "b", "k", 1), (9, "b ", "k", 1)]
SCHEMA = "doc_id long, text string, keep_id string, digest int"


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    want = []
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((r[0], keep, len(ids), r[0] == keep, sha256((r[1] or "").encode()).hexdigest()))
    return sorted(want, key=repr)


def test_groups_match_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    assert sorted(map(tuple, exact_groups(df).collect()), key=repr) == brute(ROWS)


def test_colliding_digests_are_told_apart(spark):
    rows = [(i, f"t{i % 7}" + "x" * (i % 3), None, 0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = exact_groups(df, digest=lambda t: F.length(t).cast("string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_hot_group(spark):
    rows = [(i, "same" if i % 3 else f"t{i}", None, 0) for i in range(3000)]
    assert sorted(map(tuple, exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()), key=repr) == brute(rows)


def test_drop_keeps_one_row_and_all_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    left = drop_exact_copies(df).collect()
    assert sorted((r.doc_id for r in left), key=repr) == sorted([2, 4, 5, 7, None, 9], key=repr)
    assert left[0].__fields__ == df.columns


def test_drop_with_clashing_columns_and_repeated_ids(spark):
    rows = [(1, "a", "first", "p"), (1, "a", "second", "q"), (1, "b", "third", "r"), (None, "c", "x", "s"), (None, "c", "y", "t"), (2, None, "x", "u"), (3, "", "x", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, digest string").selectExpr("*", "map(id, digest) as order", "id as nth", "id as c0")
    runs = [sorted(map(repr, drop_exact_copies(df.repartition(n)).collect())) for n in (1, 3)]
    left = drop_exact_copies(df).collect()
    assert runs[0] == runs[1] and left[0].__fields__ == df.columns and all(r.id == r.nth == r.c0 for r in left)
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted([(1, "a"), (1, "b"), (None, "c"), (3, "")], key=repr)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_groups(df).collect() == [] and drop_exact_copies(df).collect() == []
