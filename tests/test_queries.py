"""Every named query of the core against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from clipwright.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DIR):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DIR}/{name}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DIR)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    found = sorted((tuple(plain(dict(zip(want.columns, r))[c]) for c in columns) for r in want.fetchall()), key=repr)
    assert rows == found


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


#: Queries that threshold planes at 0.15, by the findings that named them.
THRESHOLDED = ("artifact_roundtrip", "mask_area", "mask_rle", "predicted_masks", "mask_rle_json", "mask_union")


@pytest.fixture(scope="module")
def level_planes(spark, tmp_path_factory):
    """Planes with values at the threshold in single precision, which is above it in double precision."""
    folder = str(tmp_path_factory.mktemp("level"))
    planes = [[0.15 if (k + p) % 5 == 0 else 0.1 + 0.1 * ((k * p) % 3 == 1) for p in range(64)] for k in range(40)]
    rows = [(k, plane, k % 10) for k, plane in enumerate(planes)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("name", THRESHOLDED)
def test_values_at_the_threshold(spark, level_planes, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{level_planes}/embeddings.parquet/*.parquet'")
    got, want = QUERIES[name](spark, level_planes), con.sql(ORACLE_SQL[name])
    rows = sorted(tuple(r[c] for c in want.columns) for r in got.collect())
    assert rows and rows == sorted(want.fetchall())


@pytest.mark.parametrize("odd", [(None, 1), (40, None)], ids=["no_object", "no_clip"])
def test_artifacts_of_null_keys(spark, tmp_path, odd):
    """A plane without an object is not lost, one without a clip does not come back after the second write."""
    plane = [0.1 + 0.1 * (p % 3 == 1) for p in range(64)]
    rows = [(k, plane, k % 10) for k in range(40)] + [(odd[0], plane, odd[1])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got, want = QUERIES["artifact_roundtrip"](spark, str(tmp_path)), con.sql(ORACLE_SQL["artifact_roundtrip"])
    rows = sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=repr)
    assert rows and rows == sorted(want.fetchall(), key=repr)


def test_artifacts_of_a_repeated_object(spark, tmp_path):
    """Every plane is written once, also those that share an object's id."""
    rows = [(k // 2, [0.2 * ((k + p) % 3 == 1) for p in range(64)], 1 + k % 3) for k in range(12)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["artifact_roundtrip"](spark, str(tmp_path)).collect()
    assert sorted((r.frame_index, int(r.clip_id)) for r in got) == sorted((k, clip) for k, _, clip in rows)


def test_masks_of_unknown_pixels(spark, tmp_path):
    """Planes that are null, empty or too short, or have null values, at their start too."""
    plane = [0.1 + 0.1 * (p % 5 < 2) for p in range(64)]
    holes = [[None if (p * 7 + k) % (k + 2) == 0 else plane[(p + k) % 64] for p in range(64)] for k in range(12)]
    planes = [plane, None, [], plane[:60], [None] * 64, [None] * 63 + [0.2], [None] + plane[1:], *holes]
    spark.createDataFrame([(k, p, 1 + k % 3) for k, p in enumerate(planes)], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    for name in ("mask_rle_json", "artifact_roundtrip"):
        got, want = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLE_SQL[name])
        rows = sorted(tuple(r[c] for c in want.columns) for r in got.collect())
        assert len(rows) == len(planes) and rows == sorted(want.fetchall())
