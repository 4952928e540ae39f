"""Configuration, sources, sinks, the runner and streams."""

import json
import os
import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipwright import schemas
from clipwright.functions.errors import DecodeError, InvalidDataError, ModelMissingError, OOMError, RetryableError, TransientIOError
from clipwright.operators import manifest
from clipwright.operators.models import Adapter, Detector, Segmenter, Thresholds
from clipwright.operators.shells import BoxSegmenter, TextDetector
from clipwright.operators.state import insert_pending, latest, resumable
from clipwright.plans.config import OperatorConfig, PathsConfig, PipelineConfig, PromptConfig, RetryPolicy, first_existing, load_config, make_run_id, operator_configs
from clipwright.plans.runner import StateLog, run
from clipwright.scratch import discard, materialize, shared_dir
from clipwright.sources import frames, manifests, sinks, video
from clipwright.streaming import alerts


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"num_gpus": 4, "unknown": 1, "backpressure": {"max_in_flight_gpu": 0, "max_in_flight_write": 3}, "operators": {"hamer": {"enabled": True, "params": None}, "other": {}}}))
    c = load_config(str(path)).resolved()
    assert (c.backpressure.max_in_flight_cpu, c.backpressure.max_in_flight_gpu, c.backpressure.max_in_flight_write) == (8, 8, 3)
    assert c.operators["sam2"].enabled and c.operators["hamer"] == OperatorConfig(True, {}) and not c.operators["fast3r"].enabled
    path.write_text(json.dumps({"retry": {"tries": 1}}))
    with pytest.raises(TypeError):
        load_config(str(path))
    row = PipelineConfig(model_versions={"sam2": "v1"}).run_manifest("r", "t")
    assert all(isinstance(v, str) for v in row.values()) and json.loads(row["model_versions"]) == {"sam2": "v1"} and json.loads(row["parquet_params"])["compression"] == "zstd"
    assert [RetryPolicy().next_delay(a) for a in (1, 2, 3)] == [5.0, 15.0, 45.0] and len(make_run_id()) == 15
    assert PromptConfig.load({}) == PromptConfig() and PromptConfig.load({"nms_iou": "1", "x": 2}).nms_iou == 1.0
    with pytest.raises(TypeError):
        PromptConfig.load({"nms_iou": None})
    assert first_existing(str(path), ()) == str(path) and first_existing("a/c.json", (str(tmp_path),)) == str(path) and first_existing("z", ()) == "z"


def test_manifests_and_discovery(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.mp4").write_bytes(b"abc")
    (tmp_path / "y.txt").write_bytes(b"no")
    assert [(os.path.basename(r.path), r.length) for r in manifests.discover(spark, str(tmp_path)).collect()] == [("x.mp4", 3)]
    assert manifests.checksums(spark, str(tmp_path)).head().checksum == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    lines = tmp_path / "m.jsonl"
    lines.write_text('{"video_id":"v","fps":30.0}\n\n  \n{"video_id":"w"}\n')
    assert [(r.video_id, r.fps) for r in manifests.read_manifest(spark, str(lines), schemas.VIDEOS).collect()] == [("v", 30.0), ("w", None)]
    lines.write_text('{"video_id":\n')
    with pytest.raises(Exception):
        manifests.read_manifest(spark, str(lines), schemas.VIDEOS).collect()


def test_state_rules(spark):
    log = spark.createDataFrame([("c1", "v1", "Pending", "", 0, 1, 1.0), ("c2", "v1", "Done", "", 0, 2, 1.0), ("c3", "v1", "Running", "", 0, 3, 1.0), ("c4", "v1", "Writing", "", 0, 4, 1.0), ("c5", "v1", "Failed", "oops", 1, 5, 1.0), ("c1", "other", "Running", "", 2, 6, 2.0)], schemas.STATE)
    now = latest(log, "clip_id")
    assert {r.clip_id for r in resumable(now).collect()} == {"c1", "c3", "c4", "c5"} == {r.clip_id for r in resumable(now, ()).collect()}
    assert {r.clip_id for r in resumable(now, ("Failed",)).collect()} == {"c5"}
    assert now.where("clip_id = 'c1'").head().video_id == "v1" and now.where("clip_id = 'c1'").head().retry_count == 2
    incoming = spark.createDataFrame([("c1", "v", 0), ("c9", "first", 1), ("c9", "second", 2)], "clip_id string, video_id string, seq int")
    assert [(r.clip_id, r.video_id) for r in insert_pending(now, incoming, "clip_id").collect()] == [("c9", "first")]


def test_artifacts(spark, tmp_path):
    root = str(tmp_path)
    clips = spark.createDataFrame([("r", "v", "007"), ("r", "v", "008")], "run_id string, video_id string, clip_id string")
    rows = clips.select("*", F.lit(1).cast("long").alias("frame_index"), F.lit(0.5).alias("timestamp_s"), F.lit("{}").alias("mask_rle"))
    sinks.write_artifact(rows, clips, root, "masks")
    sinks.write_artifact(rows.where("clip_id = '008'"), clips, root, "masks")
    back = sinks.read_artifact(spark, root, "masks", schemas.MASKS)
    assert [(r.clip_id, r.frame_index) for r in back.collect()] == [("008", 1)] and dict(back.dtypes)["frame_index"] == "bigint"
    assert spark.read.parquet(f"{root}/artifact_index").count() == 4
    for _ in range(2):
        sinks.write_json(spark, f"{root}/m.json", {"a": 1, "b": None, "c": "é"})
    assert (tmp_path / "m.json").read_text() == json.dumps({"a": 1, "b": None, "c": "é"}, indent=2)
    sinks.write_json_lines(spark.createDataFrame([("x", None)], "a string, b string"), f"{root}/lines")
    assert spark.read.text(f"{root}/lines").head().value == '{"a":"x","b":null}'
    meta = json.loads(sinks.meta_documents(clips, schemas.FIELDS).where("clip_id = '007'").head().meta)
    assert meta["clip"]["clip_id"] == "007" and meta["mask_encoding"] == "rle" and "mask_rle" in meta["field_specs"]


class MountLost(RetryableError):
    """A subclass of a user's own."""


class Flaky(Thresholds):
    """Fails by clip: some for good, some always, some on their first try only (by a marker file)."""

    once = {"flaky": RuntimeError("CUDA out of memory"), "reset": RetryableError("socket reset"), "mount": MountLost("gone")}

    def __init__(self, folder):
        super().__init__(2, 0.5)
        self.folder = folder

    def frames(self, task):
        clip = task["clip_id"]
        if clip == "bad":
            raise DecodeError("broken")
        if clip in ("never", "tired"):
            raise OOMError("always")
        marker = os.path.join(self.folder, clip)
        if clip in self.once and not os.path.exists(marker):
            open(marker, "w").close()
            raise self.once[clip]
        return super().frames(task)


def clip_frame(spark, names, **retries):
    rows = [(c, "v", 0.0, 1.0, 0, 30, retries.get(c, 0), [0.0, 1.0, 0.0, 1.0]) for c in names]
    return spark.createDataFrame(rows, "clip_id string, video_id string, start_s double, end_s double, frame_start int, frame_end int, retry_count int, plane array<double>")


def one_video(spark):
    return spark.createDataFrame([("v", "/v.mp4", 1.0, 30.0)], "video_id string, path string, duration_s double, fps double")


def settings(tmp_path, run_id="r1", **more):
    return PipelineConfig(run_id=run_id, paths=PathsConfig(output_root=str(tmp_path / "out"), state_db_path=str(tmp_path / "state")), **more)


def test_runner_retries_buries_and_resumes(spark, tmp_path):
    clips = clip_frame(spark, ("good", "bad", "flaky", "reset", "mount", "never", "tired"), tired=1)
    marks = tmp_path / "marks"
    marks.mkdir()
    config = settings(tmp_path, retry=RetryPolicy(max_retries=2), operators=operator_configs({"hamer": {"enabled": True}}))
    waits = []
    segmenter = Segmenter(lambda folder=str(marks): Flaky(folder))
    assert run(spark, config, one_video(spark), clips, segmenter, sleep=waits.append, config_path="c.json") == "r1"
    log = StateLog(spark, str(tmp_path / "state"))
    now = {r.clip_id: (r.status, r.last_error, r.retry_count) for r in log.latest().collect()}
    done = ("Done", "", 0)
    assert now == {"good": done, "flaky": done, "reset": done, "mount": done, "bad": ("Failed", "broken", 0), "never": ("Failed", "always", 2), "tired": ("Failed", "always", 2)}
    assert waits == [15.0, 15.0]  # tired came with a count of one
    running = log.rows().where("status = 'Running'").groupBy("clip_id").agg(F.sort_array(F.collect_list("retry_count")).alias("n")).collect()
    assert {r.clip_id: r.n for r in running} == {"good": [0], "bad": [0], "flaky": [0, 1], "reset": [0, 1], "mount": [0, 1], "never": [0, 1, 2], "tired": [1, 2]}
    letters = spark.read.schema(schemas.DEAD_LETTERS).parquet(log.letters)
    assert sorted(r.clip_id for r in letters.collect()) == ["bad", "never", "tired"]
    masks = sinks.read_artifact(spark, str(tmp_path / "out"), "masks", schemas.MASKS).collect()
    assert sorted(r.clip_id for r in masks) == ["flaky", "good", "mount", "reset"] and json.loads(masks[0].mask_rle) == {"size": [2, 2], "counts": [2, 2]}
    assert log.lookup("good").status == "Done" and log.lookup("unknown") is None
    before = log.lookup("good").updated_at
    run(spark, settings(tmp_path, "r2", retry=RetryPolicy(max_retries=0)), one_video(spark), clips, segmenter, sleep=waits.append)
    assert log.lookup("good").updated_at == before
    assert spark.read.schema(schemas.DEAD_LETTERS).parquet(log.letters).count() == 6


def test_a_failing_write_buries_its_clip_alone(spark, tmp_path):
    calls = []

    def write(rows, clips, root, name, parquet):
        names = sorted(r.clip_id for r in clips.collect())
        calls.append((name, names))
        if "c3" in names:
            raise InvalidDataError("cannot be written")
        if len(calls) == 1:
            raise TransientIOError("disk")
        sinks.write_artifact(rows, clips, root, name, parquet)

    waits = []
    run(spark, settings(tmp_path), one_video(spark), clip_frame(spark, [f"c{k}" for k in range(6)]), Segmenter(lambda: Thresholds(2, 0.5)), sleep=waits.append, write=write)
    log = StateLog(spark, str(tmp_path / "state"))
    assert {r.clip_id: r.status for r in log.latest().collect()} == {f"c{k}": "Failed" if k == 3 else "Done" for k in range(6)}
    assert "cannot be written" in log.lookup("c3").last_error
    assert sorted(r.clip_id for r in sinks.read_artifact(spark, str(tmp_path / "out"), "masks", schemas.MASKS).collect()) == ["c0", "c1", "c2", "c4", "c5"]
    moved = tmp_path / "again"
    moved.mkdir()
    calls.clear()
    run(spark, settings(moved), one_video(spark), clip_frame(spark, ["c0", "c1"]), Segmenter(lambda: Thresholds(2, 0.5)), sleep=waits.append, write=write)
    assert waits == [5.0] and {r.status for r in StateLog(spark, str(moved / "state")).latest().collect()} == {"Done"}


class Pose:
    def poses(self, task):
        return [{"frame_index": 3, "timestamp_s": 0.1, "pose": [1.0, float(len(task.get("hand_pose", ())))]}]


def test_smoke_from_manifests_to_artifacts(spark, tmp_path):
    """Manifests in files, prompting from the configuration, all artifacts, the state, and a second run that skips it."""
    (tmp_path / "v.jsonl").write_text(json.dumps({"video_id": "v", "path": "/videos/\u00e9.mp4", "duration_s": 1.0, "fps": 30.0, "width": 320, "height": 240, "audio": False, "checksum": "x", "split": "train"}) + "\n")
    (tmp_path / "c.jsonl").write_text("".join(json.dumps({"clip_id": c, "video_id": "v", "start_s": s, "end_s": e, "frame_start": 0, "frame_end": 30, "overlap_s": 0.0, "scenedetect_failed": False, "status": "Pending", "last_error": "", "retry_count": 0}) + "\n" for c, s, e in (("c1", 0.0, 1.0), ("c2", 0.5, 1.0), ("none", 0.0, 0.0))))
    (tmp_path / "config.json").write_text(json.dumps({"num_gpus": 1, "run_id": "test_run", "paths": {"output_root": str(tmp_path / "out"), "state_db_path": str(tmp_path / "state")}, "operators": {
        "sam2": {"params": {"prompting": {"prompt_interval_s": 0.5, "min_box_area": 50, "nms_iou": 0.5}}}, "hamer": {"enabled": True}, "dex_retarget": {"enabled": True}}}))

    class Finder:
        def detect(self, task):
            for k, frame in enumerate(task["prompt_frames"]):
                boxes = [] if task["clip_id"] == "none" else [[0.5, 0.5, 0.25, 0.25], [0.5, 0.5, 0.24, 0.24], [0.1, 0.1, 0.01, 0.01]]  # centres and sizes
                yield {"frame": int(frame), "height": 100, "width": 200, "boxes": boxes, "scores": [0.9, 0.8, 0.7][: len(boxes)], "phrases": ["hand"]}

    class Planes:
        def frames(self, task):
            assert [(p["object"], round(p["x1"]), round(p["y2"])) for p in task["prompts"]] == [(1, 75, 62)] * len(task["prompts"])
            yield {"offset": 0, "planes": np.array([[[0, 1], [0, 0]], [[0, 0], [1, 0]]])}
            yield {"offset": 1, "planes": None}

    config = load_config(str(tmp_path / "config.json"))
    videos, clips = (manifests.read_manifest(spark, str(tmp_path / n), s, ordinal=True) for n, s in (("v.jsonl", schemas.VIDEOS), ("c.jsonl", schemas.CLIPS)))
    poses = {name: Adapter(name, Pose, "poses", schemas.POSES) for name in ("hamer", "dex_retarget", "fast3r")}
    go = lambda: run(spark, config, videos, clips, Segmenter(Planes), detector=Detector(Finder), operators=poses, config_path="config.json")
    assert go() == "test_run"
    out = tmp_path / "out"
    assert json.loads((out / "run_id=test_run" / "run_manifest.json").read_text())["config_path"] == "config.json"
    masks = {(r.clip_id, r.frame_index): (r.timestamp_s, json.loads(r.mask_rle)) for r in sinks.read_artifact(spark, str(out), "masks", schemas.MASKS).collect()}
    assert masks == {("c1", 0): (0.0, {"size": [2, 2], "counts": [1, 2, 1]}), ("c2", 15): (0.5, {"size": [2, 2], "counts": [1, 2, 1]})}
    hands = sinks.read_artifact(spark, str(out), "hand_pose", schemas.POSES).collect()
    assert sorted(r.clip_id for r in hands) == ["c1", "c2", "none"]
    assert [r.pose[1] for r in sinks.read_artifact(spark, str(out), "mapping", schemas.POSES).collect()] == [1.0] * 3  # was given a hand pose
    assert sinks.read_artifact(spark, str(out), "object_pose", schemas.POSES).collect() == [] and not (out / "fast3r_pose").exists()
    index = spark.read.parquet(f"{out}/artifact_index").groupBy("artifact").count().collect()
    assert dict(map(tuple, index)) == {"masks": 3, "hand_pose": 3, "object_pose": 3, "mapping": 3}
    text = next((out / "meta" / "run_id=test_run" / "video_id=v" / "clip_id=c2").glob("part-*")).read_text()
    meta = json.loads(text)
    assert text.isascii() and list(meta["clip"]) == list(schemas.TASK) and meta["clip"]["video_path"] == "/videos/\u00e9.mp4" and meta["mask_encoding"] == "rle"
    log = StateLog(spark, str(tmp_path / "state"))
    assert {r.status for r in log.latest().collect()} == {"Done"}
    seq = log.lookup("c1").updated_at
    go()
    assert StateLog(spark, str(tmp_path / "state")).lookup("c1").updated_at == seq


def test_gates(spark, tmp_path):
    """A segmenter switched off gives empty masks; a prompt source that is not the detector's, no prompts."""
    class Never:
        def frames(self, task):
            raise DecodeError("must not run")

        detect = frames

    for k, raw in enumerate(({"sam2": {"enabled": False}}, {"sam2": {"params": {"prompting": {"source": "points"}}}}, {"fast3r": {"enabled": True}, "sam2": {"enabled": False}})):
        folder = tmp_path / str(k)
        folder.mkdir()
        run(spark, settings(folder, operators=operator_configs(raw)), one_video(spark), clip_frame(spark, ["c"]), Segmenter(Never), detector=Detector(Never))
        assert StateLog(spark, str(folder / "state")).lookup("c").status == "Done"
        assert sinks.read_artifact(spark, str(folder / "out"), "masks", schemas.MASKS).collect() == [] and (folder / "out" / "fast3r_pose").exists() == (k == 2)


def test_ids_and_order_of_manifests(spark, tmp_path):
    with pytest.raises(Exception, match="without clip_id"):
        run(spark, settings(tmp_path), one_video(spark), clip_frame(spark, ["a", None]), Segmenter(lambda: Thresholds(2, 0.5)))
    rows = [f'{{"video_id": "v{k}", "path": "old", "fps": 30.0}}' for k in range(3000)]
    folder = tmp_path / "m.jsonl"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(rows))
    (folder / "b.json").write_text('{"video_id": "v1", "path": "new", "fps": 30.0}\n{"video_id": "v1", "path": "newest", "fps": 30.0}')
    read = manifests.read_manifest(spark, str(folder), schemas.VIDEOS, ordinal=True)
    assert manifest.last_by_key(manifest.in_order(read), "video_id", "__at").where("video_id = 'v1'").head().path == "newest"


def test_state_log_is_compacted(spark, tmp_path):
    log = StateLog(spark, str(tmp_path))
    clips = spark.createDataFrame([("a", "v"), ("b", "v")], "clip_id string, video_id string")
    for k in range(5):
        log.append(clips, "Running", k)
    os.makedirs(tmp_path / "log" / "batch-000000000099")  # a write that never ended
    before = sorted(map(tuple, log.rows().collect()))
    log.compact(3)
    assert len(log.batches()) == 1 and sorted(map(tuple, log.rows().collect())) == before
    log = StateLog(spark, str(tmp_path))
    log.append(clips.where("clip_id = 'a'"), "Done")
    assert log.seq == 6 and log.rows().count() == 11 and log.lookup("a").status == "Done" and log.lookup("b").retry_count == 4


def test_video_tools(spark, tmp_path, monkeypatch):
    """With stand-ins for the tools: what they are asked, and what comes of their failures."""
    probe, cut = tmp_path / "bin" / "ffprobe", tmp_path / "bin" / "ffmpeg"
    probe.parent.mkdir()
    probe.write_text("#!/bin/sh\ncase \"$*\" in *bad*) exit 1;; esac\necho '{\"streams\": [{\"codec_type\": \"video\", \"r_frame_rate\": \"30000/1001\", \"width\": 320, \"height\": 240, \"nb_frames\": \"30\"}], \"format\": {\"duration\": \"1.0\"}}'\n")
    cut.write_text('#!/bin/sh\necho "$@" | grep -q bad && exit 1\nfor last; do :; done\necho "$@" > "$last"\n')
    for f in (probe, cut):
        f.chmod(0o755)
    monkeypatch.setenv("PATH", f"{probe.parent}:{os.environ['PATH']}")
    with video.extracted("file:/v.mp4", 1.0, 2.5) as path:
        assert open(path).read().startswith("-y -ss 1.0 -to 2.5 -i /v.mp4 -c copy -an") and path != "/v.mp4"
    assert not os.path.exists(path)
    for args in (("/v.mp4", 0.0, -1.0), ("/bad.mp4", 1.0, 2.0)):
        with video.extracted(*args) as path:
            assert path == args[0]
    where = str(probe.parent)

    def found(path):
        os.environ["PATH"] = f"{where}:{os.environ['PATH']}"
        return video.probe(path)["streams"][0]["nb_frames"]

    assert found("/v.mp4") == "30"
    files = spark.createDataFrame([("/v.mp4",), ("/bad.mp4",)], "path string")
    cuts = video.detect_scenes(files, lambda: lambda path: [1.0, 2.5] if "bad" not in path else 1 / 0)
    assert sorted(map(tuple, cuts.collect())) == [("/v.mp4", 1.0), ("/v.mp4", 2.5)]


@pytest.fixture
def stand_ins(tmp_path, monkeypatch):
    """Modules of the names that the shells look for, and tools that give 4 frames of 2 x 1 pixels at 10 a second."""
    tools = tmp_path / "bin"
    tools.mkdir()
    (tools / "ffprobe").write_text("#!/bin/sh\necho '{\"streams\": [{\"codec_type\": \"video\", \"r_frame_rate\": \"10/1\", \"width\": 2, \"height\": 1}]}'\n")
    (tools / "ffmpeg").write_text('#!/bin/sh\ncase "$*" in *rawvideo*) printf "abcdefghijklmnopqrstuvwx";; *) exit 1;; esac\n')
    for f in tools.iterdir():
        f.chmod(0o755)
    monkeypatch.setenv("PATH", f"{tools}:{os.environ['PATH']}")
    said = []

    class Model:
        def __init__(self, config, weights, device):
            said.append(("model", config, weights, device))

        def predict_with_caption(self, image, text, box_threshold, text_threshold):
            said.append(("predict", image.shape, int(image[0, 0, 0]), text, box_threshold, text_threshold))
            return [[0.5, 0.5, 0.2, 0.2]], [0.9], ["hand"]

    class Predictor:
        def init_state(self, video_path=None, *, wanted="video_path"):
            said.append(("state", video_path))
            return "state"

        def add_new_points_or_box(self, state, frame, obj, points):  # the older signature
            said.append(("prompt", frame, obj, points))

        def propagate_in_video(self, state):
            yield 0, [1], np.array([[[[0.5, -0.5]]], [[[-1.0, 2.0]]]])
            yield 1, [1], None
            yield 2, [1], np.zeros((0, 1, 2))

    def build(config, weights, **extras):
        said.append(("build", config, weights, sorted(extras)))
        if extras:
            raise TypeError("unknown argument")
        return Predictor()

    names = {"groundingdino": {}, "groundingdino.util": {"inference": types.SimpleNamespace(Model=Model)}, "sam2": {"__file__": str(tmp_path / "sam2" / "__init__.py")}, "sam2.build_sam": {"build_sam2_video_predictor": build}}
    for name, parts in names.items():
        module = types.ModuleType(name)
        module.__dict__.update(parts)
        monkeypatch.setitem(sys.modules, name, module)
    return said


def test_shells_call_models_as_they_want(stand_ins, tmp_path):
    prompt = PromptConfig(prompt_text="hand .", box_threshold=0.1, text_threshold=0.2, gd_config="g.py", gd_checkpoint="g.pth", gd_device="cpu")
    task = {"clip_id": "c", "video_path": "/v.mp4", "start_s": 0.0, "end_s": 1.0, "prompt_frames": [0, 2], "prompts": [{"frame": 2, "object": 1, "x1": 0.0, "y1": 0.0, "x2": 2.0, "y2": 1.0}]}
    found = list(TextDetector(prompt).detect(task))
    assert found[0] == {"frame": 0, "height": 1, "width": 2, "boxes": [[0.5, 0.5, 0.2, 0.2]], "scores": [0.9], "phrases": ["hand"]} and [f["frame"] for f in found] == [0, 2]
    assert stand_ins[:2] == [("model", "g.py", "g.pth", "cpu"), ("predict", (1, 2, 3), ord("a"), "hand .", 0.1, 0.2)]
    (tmp_path / "sam2" / "configs").mkdir(parents=True)
    (tmp_path / "sam2" / "configs" / "s.yaml").write_text("")
    stand_ins.clear()
    segmenter = BoxSegmenter({"config": "elsewhere/s.yaml", "checkpoint": "w.pt", "device": "cpu"})
    planes = [(f["offset"], None if f["planes"] is None else f["planes"].reshape(-1, 2).any(axis=0).tolist()) for f in segmenter.frames(task)]
    assert planes == [(0, [True, True]), (1, None), (2, None)]
    assert [s[0] for s in stand_ins] == ["build", "build", "state", "prompt"] and stand_ins[1] == ("build", str(tmp_path / "sam2" / "configs" / "s.yaml"), "w.pt", []) and stand_ins[3] == ("prompt", 2, 1, (0.0, 0.0, 2.0, 1.0))
    with pytest.raises(ModelMissingError, match="config and checkpoint"):
        list(BoxSegmenter({}).frames(task))


def test_a_worker_without_the_model_fails_its_clips_for_good(spark, tmp_path):
    run(spark, settings(tmp_path), one_video(spark), clip_frame(spark, ["c"]), Segmenter(lambda: BoxSegmenter({})))
    state = StateLog(spark, str(tmp_path / "state")).lookup("c")
    assert (state.status, state.retry_count) == ("Failed", 0) and state.last_error.startswith("no segmenter on this worker")


def test_pixels(stand_ins):
    frames = list(video.read_frames("/v.mp4", 1.0, 2.0, 0))
    assert [(k, t, i.tobytes()) for k, t, i in frames[:2]] == [(0, 1.0, b"abcdef"), (1, 1.1, b"ghijkl")] and len(frames) == 4


def test_globs(spark, tmp_path):
    for name in ("x.mp4", "a/y.mp4", "a/b/z.mp4", "a/n.txt", "c/w.mp4"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"abc" * 10)
    found = lambda glob: sorted(os.path.relpath(r.path.removeprefix("file:"), tmp_path) for r in manifests.discover(spark, str(tmp_path), glob).collect())
    for glob in ("**/*.mp4", "a/*.mp4", "*.mp4", "[ac]/?.mp4", "**/b/*", "a/**/*.mp4"):
        assert found(glob) == sorted(str(p.relative_to(tmp_path)) for p in tmp_path.glob(glob) if p.is_file()), glob


def test_scratch_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            applicationId, master = "app", "spark://host:7077"

    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        Session.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(Session())


def test_materialised_tables_can_be_discarded(spark):
    table = materialize(spark.range(10), "gone")
    path = table._scratch_path.removeprefix("file:").removeprefix("//")
    assert table.count() == 10 and os.path.isdir(path)
    discard(table)
    assert not os.path.exists(path)


def test_frame_source(spark):
    frames.register(spark)
    read = lambda **o: [tuple(r) for r in spark.read.format("frames").options(**o).load().orderBy("frame_index").collect()]
    assert read(fps=10, start_s=1, end_s=2, stride=5) == [(0, 10, 1.0), (5, 15, 1.5), (10, 20, 2.0)]
    assert len(read(fps=10, start_s=0, end_s=1, stride=0, rows=3)) == 11


def test_streaming_streaks(spark):
    events = alerts.read_events(spark, "/root/testdata/sf0.001")
    got = {r.user_id: r.longest for r in alerts.drained(alerts.streaks(events, 20.0), "update").collect()}
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("event_id").collect()
    want, now = {}, {}
    for r in table:
        now[r.user_id] = now.get(r.user_id, 0) + 1 if r.value < 20 else 0
        want[r.user_id] = max(want.get(r.user_id, 0), now[r.user_id])
    assert got == want


PROBE = '{"streams":[{"codec_type":"video","r_frame_rate":"%s","width":1920,"height":1080}],"format":{"duration":"10.0"}}'


def test_building_manifests(spark):
    from clipwright.plans.config import SceneDetectConfig
    from clipwright.plans.manifests import build, unsound

    probes = spark.createDataFrame([("/a.mp4", PROBE % "30/1"), ("/b.mp4", PROBE % "30000/1001")], "path string, probe string")
    cuts = spark.createDataFrame([("/a.mp4", 2.0), ("/a.mp4", 2.5), ("/a.mp4", 8.9), ("/a.mp4", 99.0)], "path string, at_s double")
    videos, clips = build(probes, cuts, "train")
    rows = {r.path: r for r in videos.collect()}
    assert rows["/a.mp4"].fps == 30.0 and not rows["/a.mp4"].audio and rows["/a.mp4"].split == "train" and rows["/b.mp4"].width == 1920
    found = clips.where(F.col("video_id") == rows["/a.mp4"].video_id).orderBy("start_s").collect()
    assert [(r.start_s, r.end_s) for r in found] == [(0.0, 3.0), (1.0, 9.9), (7.9, 10.0)] and not any(r.scenedetect_failed for r in found)
    assert [r.scenedetect_failed for r in clips.where(F.col("video_id") == rows["/b.mp4"].video_id).collect()] == [True]
    assert sorted(map(tuple, build(probes, cuts, "train")[1].collect())) == sorted(map(tuple, clips.collect()))
    assert clips.select(*schemas.CLIPS.replace(" string", "").replace(" double", "").replace(" int", "").replace(" boolean", "").split(", ")).count() == 4 and unsound(videos, clips).count() == 0
    assert build(probes, cuts, "train", SceneDetectConfig(method="none"))[1].count() == 2
    assert build(probes, cuts, "train", SceneDetectConfig(method="none", fallback_full_clip=False))[1].count() == 0
    with pytest.raises(Exception, match="invalid frame rate"):
        build(spark.createDataFrame([("/c.mp4", PROBE % "0/0")], probes.schema), cuts, "train")[0].collect()


def test_metrics_are_observed(spark):
    from clipwright.operators.metrics import Metrics

    metrics = Metrics()
    assert metrics.observe(spark.range(10), "infer", largest=F.max("id")).where("id > 5").count() == 4
    assert metrics.get("infer") == {"clips_processed_total": 10, "largest": 9}


def test_command_line():
    from clipwright.cli import build_parser

    args = build_parser().parse_args(["make-manifest", "--input-dir", "i", "--output-dir", "o", "--config", "c.json"])
    assert args.split == "train" and args.glob == "**/*.mp4" and args.call.__name__ == "make_manifest"
    assert build_parser().parse_args(["run", "--config", "c", "--video-manifest", "v", "--clip-manifest", "m"]).predictor == ""
    with pytest.raises(SystemExit):
        build_parser().parse_args(["run"])


def test_streaming_tracker_matches_the_batch_one(spark, tmp_path):
    import random

    from clipwright.operators.boxes import tracked

    rnd = random.Random(9)
    data = [(k % 5, f, o, float(x), float(y), float(x + 20), float(y + 20)) for k in range(5) for f in range(12) for o in range(2) for x, y in [(rnd.randint(0, 30), rnd.randint(0, 30))]]
    schema = "clip_key long, frame long, ord int, x1 double, y1 double, x2 double, y2 double"
    for half in (0, 1):  # two files, one batch each
        spark.createDataFrame([r for r in data if (r[1] >= 6) == bool(half)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = sorted(map(tuple, alerts.drained(alerts.tracks(stream, 0.3), "append").collect()))
    want = sorted(map(tuple, tracked(spark.createDataFrame(data, schema), 0.3).select("clip_key", "frame", "ord", "object").collect()))
    assert got == want
