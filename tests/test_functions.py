"""Scalar rules against plain Python."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipwright.functions import errors, masks, time
from clipwright.functions.ids import clip_id
from clipwright.operators import boxes as ops
from clipwright.operators import manifest
from clipwright.operators.masks import bits_by_column, prompt_frames, runs, union
from clipwright.operators.models import encode_mask


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).head())


def test_frames_round_half_to_even(spark):
    rows = spark.createDataFrame([(s, f) for s in (0.0, 0.5, 1.5, 2.5, 1 / 3) for f in (1.0, 0.0, -1.0, 30.0)], "s double, f double")
    for r in rows.select("s", "f", time.frames_from_seconds(F.col("s"), F.col("f")).alias("n"), time.seconds_from_frames(F.lit(45), F.col("f")).alias("t")).collect():
        assert r.n == (round(r.s * r.f) if r.f > 0 else 0) and r.t == (45 / r.f if r.f > 0 else 0)


def test_alignment(spark):
    lit = lambda *v: [F.lit(x) for x in v]
    assert one(spark, time.aligned(*lit(1.0, 2.0, 30, 60, 30.0)), time.aligned(*lit(1.001, 2.0, 30, 60, 30.0))) == (True, False)


def test_clip_id(spark):
    import hashlib

    (got,) = one(spark, clip_id(F.lit("video-abc"), F.lit(0), F.lit(30)))
    assert got == "video-abc-000000000-000000030-" + hashlib.sha256(b"video-abc:0:30").hexdigest()[:8]


@pytest.mark.parametrize("kind,message,reason,again", [("OOMError", "", "OOMError", True), ("DecodeError", "out of memory", "DecodeError", False), ("", "CUDA Out Of Memory", "oom", True), ("", "CUDA launch Error", "cuda_error", True), ("", "cuda", "unknown", False), ("ValueError", None, "unknown", False)])
def test_errors(spark, kind, message, reason, again):
    k, m = F.array(F.lit(kind)), F.lit(message).cast("string")
    assert one(spark, errors.reason(k, m), errors.retryable(k, m)) == (reason, again)


def test_errors_by_descent(spark):
    class Lost(errors.TransientIOError, OSError):
        pass

    class Odd(errors.InvalidDataError):
        pass

    for error, reason, again in ((Lost("x"), "Lost", True), (errors.RetryableError("socket reset"), "RetryableError", True), (Odd("cuda error"), "Odd", False), (KeyError("x"), "unknown", False)):
        k = F.array(*map(F.lit, errors.ancestry(error)))
        assert one(spark, errors.reason(k, F.lit(str(error))), errors.retryable(k, F.lit(str(error)))) == (reason, again)
    assert errors.ancestry(Lost("x")) == ["Lost", "TransientIOError", "RetryableError", "OSError"]
    nothing = F.lit(None).cast("array<string>")
    assert one(spark, errors.reason(nothing, F.lit(None).cast("string")), errors.retryable(nothing, F.lit("out of memory"))) == ("unknown", True)


def test_delays(spark):
    assert one(spark, *[errors.next_delay(F.lit(a)) for a in (0, 1, 2, 3)]) == (5.0, 5.0, 15.0, 45.0)


def counts_of(plane):
    flat = [int(plane[y][x]) for x in range(len(plane[0])) for y in range(len(plane))]
    groups = [(b, len(list(g))) for b, g in itertools.groupby(flat)]
    return ([0] if groups[0][0] else []) + [n for _, n in groups]


def test_run_lengths_three_ways(spark):
    rng = np.random.default_rng(0)
    planes = [np.zeros((4, 6)), np.ones((4, 6)), *(rng.integers(0, 2, (4, 6)) for _ in range(20))]
    rows = spark.createDataFrame([(i, [float(v) for v in p.ravel()]) for i, p in enumerate(planes)], "object int, plane array<double>")
    fold = dict(map(tuple, rows.select("object", masks.run_lengths(bits_by_column(F.col("plane"), 4, 6))).collect()))
    window = {}
    for r in runs(rows, "object", 4, 6).orderBy("run").collect():
        window.setdefault(r.object, [0] if r.run == 1 and r.object not in window else []).append(r.length)
    for i, p in enumerate(planes):
        want = counts_of(p.tolist())
        assert fold[i] == want == window[i] and json.loads(encode_mask(p)) == {"size": [4, 6], "counts": want}
    assert one(spark, masks.run_lengths(F.array().cast("array<int>"))) == ([0],)


def test_union_and_rle_text(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0, 0.0, -1.0]), (1, [0.0, 0.0, 0.0, 2.0])], "k int, plane array<double>")
    assert union(rows, "k", 2, 2).head().bits == [1, 0, 0, 1]
    parsed = one(spark, masks.parse_rle(F.lit('{"size": [2, 2], "counts": [0, 1, 2, 1]}')), masks.rle_area(F.array(*map(F.lit, (0, 1, 2, 1)))))
    assert parsed[0]["size"] == [2, 2] and parsed[0]["counts"].replace(" ", "") == "[0,1,2,1]" and parsed[1] == 2


def plain_iou(a, b, signed=False):
    side = (lambda x: x) if signed else (lambda x: max(0.0, x))
    inter = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    size = lambda r: side(r[2] - r[0]) * side(r[3] - r[1])
    return inter / (size(a) + size(b) - inter + 1e-6)


def test_suppression_and_tracking_match_loops(spark):
    rnd = random.Random(3)
    data = []
    for frame in range(60):
        for k in range(rnd.randint(1, 12)):
            x, y = rnd.randint(0, 40), rnd.randint(0, 40)
            data.append((frame, k, float(x), float(y), float(x + rnd.choice([10, 20, -3])), float(y + rnd.choice([10, 20]))))
    rows = spark.createDataFrame(data, "frame_key int, ord int, x1 double, y1 double, x2 double, y2 double")
    kept = {(r.frame_key, r.ord) for r in ops.suppressed(rows, 0.3).collect()}
    ids = {(r.frame_key, r.ord): r.object for r in ops.tracked(rows.withColumn("clip_key", F.col("frame_key")).withColumn("frame", F.col("ord").cast("long")), 0.2).select(F.col("clip_key").alias("frame_key"), "ord", "object").collect()}
    for frame in range(60):
        own = [r for r in data if r[0] == frame]
        order = sorted(own, key=lambda r: ((r[4] - r[2]) * (r[5] - r[3]), r[1]), reverse=True)
        left = []
        for r in order:
            if all(plain_iou(s[2:], r[2:], True) < 0.3 for s in left):
                left.append(r)
        assert {o for f, o in kept if f == frame} == {r[1] for r in left}
        now = {}
        for r in own:
            best = max(((plain_iou(b, r[2:]), -i) for i, b in now.items() if plain_iou(b, r[2:]) >= 0.2), default=None)
            chosen = -best[1] if best else len(now) + 1
            now[chosen] = r[2:]
            assert ids[frame, r[1]] == chosen


def test_scene_rules(spark):
    videos = spark.createDataFrame([("v", 10.0, 30.0, "/v.mp4"), ("w", 5.0, 25.0, "/w.mp4")], "video_id string, duration_s double, fps double, path string")
    scenes = spark.createDataFrame([("v", 0.5, 2.0), ("v", 8.9, 9.8)], "video_id string, start_s double, end_s double")
    found = manifest.or_whole(videos, scenes)
    assert [tuple(r)[1:] for r in found.where("video_id = 'w'").collect()] == [(0.0, 5.0, True)]
    assert manifest.or_whole(videos, scenes, fallback=False).count() == 2
    for r in manifest.expanded(manifest.with_videos(found, videos), 1.0).collect():
        assert 0 <= r.start_s <= r.end_s <= r.duration_s and r.start_s == r.frame_start / r.fps and r.end_s == r.frame_end / r.fps
    with pytest.raises(Exception, match="missing video_id"):
        manifest.with_videos(spark.createDataFrame([("x", 0.0, 1.0)], scenes.schema), videos).collect()
    with pytest.raises(Exception, match="empty path"):
        manifest.with_videos(scenes, videos.withColumn("path", F.lit(""))).collect()


def test_prompts(spark):
    videos = spark.createDataFrame([("a", 10.0, 30.0), ("b", 10.0, 0.0), ("c", 0.0, 30.0)], "video_id string, duration_s double, fps double")
    got = {}
    for r in prompt_frames(videos, 2.0, 4).orderBy("nth").collect():
        got.setdefault(r.video_id, []).append(r.frame)
    assert got == {"a": [0, 60, 120, 180], "b": [0, 60, 120, 180], "c": [0]}
    assert prompt_frames(videos, 2.0, 0).where("video_id = 'a'").count() == 1


def test_area_filter_then_suppression(spark):
    rows = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 0.0, 0.0, 30.0, 30.0), (2, 0, 5.0, 5.0, 1.0, 1.0)], "frame_key int, ord int, x1 double, y1 double, x2 double, y2 double")
    assert [(r.frame_key, r.x2) for r in ops.suppressed(ops.large_enough(rows, 200.0), 1.0).collect()] == [(1, 30.0)]
    assert ops.large_enough(rows, 100.0).count() == 2 and ops.large_enough(rows, 0.0).count() == 3
    same = rows.where("frame_key = 1").withColumns({"x2": F.lit(20.0), "y2": F.lit(20.0)})
    assert [r.ord for r in ops.suppressed(same, 0.5).collect()] == [1]  # of equal boxes the later one


def test_top_k_ties_and_missing_phrases(spark):
    rows = spark.createDataFrame([(1, 0, 0.5, "a"), (1, 1, 0.5, None), (1, 2, 0.9, "c"), (1, 3, None, "d")], "frame_key int, ord int, score double, phrase string")
    assert [(r.ord, r.phrase) for r in ops.top_k(rows, 3).orderBy("place").collect()] == [(2, "c"), (1, ""), (0, "a")]
    lists = spark.createDataFrame([(1, [0.1, 0.2], ["x"]), (2, [], ["y"])], "frame_key int, scores array<double>, phrases array<string>")
    assert [tuple(r) for r in ops.detections(lists).collect()] == [(1, 0, 0.1, "x"), (1, 1, 0.2, "")]


def test_formats_are_told_apart_per_frame(spark):
    data = [(1, 0, 10.0, 20.0, 400.0, 300.0), (2, 0, 0.5, 0.5, 0.25, 0.5), (2, 1, 0.5, 0.5, 0.25, 0.25), (3, 0, 0.0, 0.25, 1.0, 1.0)]
    rows = ops.normalized(spark.createDataFrame(data, "frame_key int, ord int, x1 double, y1 double, x2 double, y2 double"), 320, 240)
    got = {(r.frame_key, r.ord): (r.x1, r.y1, r.x2, r.y2) for r in rows.collect()}
    assert got == {(1, 0): (10, 20, 319, 239), (2, 0): (120, 60, 200, 180), (2, 1): (120, 90, 200, 150), (3, 0): (0, 60, 319, 239)}


def test_absolute_frames(spark):
    from clipwright.operators.masks import absolute, frames_between

    clips = spark.createDataFrame([("c", 1.0, 30.0, 30, 36), ("d", 1.0, 0.0, 9, 8)], "clip_id string, start_s double, fps double, frame_start int, frame_end int")
    rows = absolute(frames_between(clips, F.lit(3))).orderBy("frame").collect()
    assert [(r.offset, r.frame, r.frame_index, r.timestamp_s) for r in rows] == [(0, 30, 30, 1.0), (3, 33, 33, 1.1), (6, 36, 36, 1.2)]


def test_quality_rules_of_no_rows(spark):
    from clipwright.operators import quality

    none = spark.createDataFrame([], "v double, empty boolean")
    assert tuple(none.agg(quality.empty_rate(F.col("empty")), quality.empty_rate_counted(F.col("empty"))).head()) == (1.0, 0.0)
    assert tuple(none.agg(*quality.distribution(F.col("v"))).head()) == (0.0, 0.0, 0.0)


def test_schedule_is_longest_first_and_stable(spark):
    rows = spark.createDataFrame([(k, 0.0, float(k % 7) if k % 5 else None) for k in range(500)], "k int, start_s double, end_s double")
    placed = manifest.schedule(rows, "k").orderBy("place").collect()
    want = sorted(range(500), key=lambda k: (-(float(k % 7) if k % 5 else 0.0), k))
    assert [r.k for r in placed] == want and [r.place for r in placed] == list(range(1, 501))
