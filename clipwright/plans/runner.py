"""Runs clips to artifacts, resumably: state log, attempts in rounds, dead letters."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clipwright import schemas
from clipwright.functions import errors
from clipwright.operators import clips as clip_ops
from clipwright.operators import manifest, state
from clipwright.operators.metrics import Metrics
from clipwright.operators.models import POSE_ARTIFACTS, STUBS, Adapter, Stub, exploded
from clipwright.plans.config import PipelineConfig, PromptConfig, created_at, make_run_id
from clipwright.scratch import discard, materialize
from clipwright.sources import sinks


class StateLog:
    """An append-only log with one writer, the driver; a later batch has a larger seq.

    Batches are folders named by their seq, written whole or not at all; compact() merges them into one that stands for
    all up to its seq.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path, self.letters = spark, f"{root}/log", f"{root}/dead_letters"
        spark.createDataFrame([], schemas.DEAD_LETTERS).write.mode("append").parquet(self.letters)
        self.seq = max((seq for seq, _, _ in self.batches()), default=0)

    def batches(self) -> list[tuple[int, bool, str]]:
        """(seq, whether it stands for all before it, path) of the finished batches that count, in order."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(context._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        child = context._jvm.org.apache.hadoop.fs.Path
        found = [s.getPath() for s in fs.listStatus(path) if fs.exists(child(s.getPath(), "_SUCCESS"))]
        named = sorted((int(p.getName().split("-")[1]), p.getName().startswith("upto"), p.toString()) for p in found)
        merged = max((seq for seq, whole, _ in named if whole), default=-1)
        return [b for b in named if b[0] > merged or b[:2] == (merged, True)]

    def rows(self) -> DataFrame:
        paths = [p for _, _, p in self.batches()]
        return self.spark.read.schema(schemas.STATE).parquet(*paths) if paths else self.spark.createDataFrame([], schemas.STATE)

    def latest(self) -> DataFrame:
        return state.latest(self.rows(), "clip_id")

    def lookup(self, clip_id: str) -> Row | None:
        """The state of one clip; the log is filtered as it is scanned."""
        return state.lookup(self.rows(), "clip_id", clip_id).head()

    def append(self, clips: DataFrame, status: str, retry_count: Column | int = 0, last_error: Column | str = "") -> None:
        self.seq += 1
        column = lambda v: v if isinstance(v, Column) else F.lit(v)
        rows = clips.select("clip_id", "video_id", F.lit(status).alias("status"), column(last_error).alias("last_error"), column(retry_count).cast("int").alias("retry_count"), F.lit(self.seq).cast("long").alias("seq"), F.lit(time.time()).alias("updated_at"))
        rows.write.parquet(f"{self.path}/batch-{self.seq:012d}")

    def bury(self, clips: DataFrame, error: Column) -> None:
        clips.select("clip_id", "video_id", error.alias("error"), F.lit(time.time()).alias("updated_at")).write.mode("append").parquet(self.letters)

    def compact(self, most: int = 64) -> None:
        """Merge the batches if there are more than `most`; the ones merged go once the merged one is finished."""
        old = self.batches()
        if len(old) > most:
            self.rows().coalesce(max(1, self.spark.sparkContext.defaultParallelism)).write.parquet(f"{self.path}/upto-{self.seq:012d}")
            context = self.spark.sparkContext
            for _, _, name in old:
                path = context._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def run(
    spark: SparkSession, config: PipelineConfig, videos: DataFrame, clips: DataFrame, segmenter: Adapter, *, detector: Adapter | None = None, operators: dict[str, Adapter | Stub] | None = None,
    sleep: Callable[[float], None] = time.sleep, write: Callable = sinks.write_artifact, config_path: str = "", metrics: Metrics | None = None,
) -> str:
    """Process what is resumable of clips, and return the run's id.

    Which operators run, and the segmenter's prompting, is up to config.operators; `operators` gives the adapters of the
    pose operators by name (stand-ins otherwise), of which retargeting is given the hand poses. Artifacts are written
    before a clip is Done, so a stop in between leaves it resumable. Retryable failures go into the next round until
    they have been tried retry.max_retries times beyond the count their clip came with; all others fail for good and are
    listed as dead letters. Failing writes are tried again likewise, then halved until the clips that fail are found.
    State is kept across runs: clips that are Done stay so under a new run id. Inference runs in at most
    max_in_flight_gpu tasks at a time, longest clips first, and writing in at most max_in_flight_write.
    """
    config, metrics = config.resolved(), metrics or Metrics()
    run_id, root, policy, limits = config.run_id or make_run_id(), config.paths.output_root, config.retry, config.backpressure
    log = StateLog(spark, config.paths.state_db_path)
    log.compact()
    listed = manifest.identified(manifest.in_order(clips))
    log.append(state.insert_pending(log.latest(), listed, "clip_id", "__at").select("clip_id", "video_id"), "Pending")
    todo = manifest.last_by_key(listed, "clip_id", "__at").drop("__at").join(state.resumable(log.latest()).select("clip_id"), "clip_id", "left_semi")
    met = manifest.with_videos(todo, manifest.last_by_key(manifest.in_order(videos), "video_id", "__at"))
    flag = lambda name, default: F.coalesce(F.col(name), F.lit(default)) if name in clips.columns else F.lit(default)
    columns = ["clip_id", "video_id", F.col("path").alias("video_path"), "start_s", "end_s", "frame_start", "frame_end", flag("scenedetect_failed", False).alias("scenedetect_failed"), flag("retry_count", 0).alias("retry_count")]
    tasks = met.select(*columns, "fps", "duration_s", *[c for c in clips.columns if c in ("plane", "found")])
    sinks.write_json(spark, f"{root}/run_id={run_id}/run_manifest.json", config.run_manifest(run_id, created_at(), config_path))

    enabled = lambda name: config.operators[name].enabled
    poses = {name: (operators or {}).get(name) or STUBS[name] for name in POSE_ARTIFACTS}
    prompt = PromptConfig.load(config.operators["sam2"].params.get("prompting") or {})
    left = materialize(manifest.schedule(tasks, "clip_id"), "run-tasks")
    while left.head(1):
        log.append(left, "Running", F.col("retry_count"))
        dealt = left.repartitionById(limits.max_in_flight_gpu, F.pmod(F.col("place"), F.lit(limits.max_in_flight_gpu)).cast("int")).sortWithinPartitions("place")
        held, keep = [], lambda rows: held.append(materialize(rows, "run-results")) or held[-1]
        results = {"masks": keep(clip_ops.segmented(dealt, detector, segmenter, prompt, keep))} if enabled("sam2") else {}
        for name in POSE_ARTIFACTS:
            if enabled(name):
                given = dealt
                if name == "dex_retarget":
                    hands = results["hand_pose"].select("clip_id", F.col("rows").alias("hand_pose")) if "hand_pose" in results else dealt.select("clip_id", F.array().cast("array<int>").alias("hand_pose"))
                    given = dealt.join(hands, "clip_id")
                results[POSE_ARTIFACTS[name]] = keep(poses[name].run(given))
        failures = [r.where(~F.col("ok")).select("clip_id", F.struct(F.lit(k).alias("nth"), "kinds", "message").alias("failure")) for k, r in enumerate(results.values())]
        failed = left.select("clip_id").limit(0).withColumn("failure", F.lit(None).cast("struct<nth:int,kinds:array<string>,message:string>"))
        for f in failures:
            failed = failed.unionByName(f)
        failed = failed.groupBy("clip_id").agg(F.min_by("failure", "failure.nth").alias("failure"))
        ended = keep(metrics.observe(left.join(failed, "clip_id", "left"), f"round-{log.seq}", clip_failures_total=F.count("failure")))
        good = ended.where("failure is null").drop("failure")
        log.append(good, "Writing", F.col("retry_count"))
        lost = written(spark, config, run_id, good, results, write, sleep)
        log.append(good.join(lost, "clip_id", "left_anti"), "Done")
        report(log, good.join(lost, "clip_id"), 0)
        kinds, message, tries = F.col("failure.kinds"), F.col("failure.message"), F.col("retry_count")
        again = errors.retryable(kinds, message) & (tries < policy.max_retries)
        bad = ended.where("failure is not null")
        report(log, bad.where(~again).withColumn("message", message), tries)
        more = materialize(bad.where(again).drop("failure").withColumn("retry_count", tries + 1), "run-tasks")
        discard(left, *held)
        left = more
        most = left.agg(F.max("retry_count")).head()[0]
        if most is not None:
            sleep(policy.next_delay(most))
    discard(left)
    return run_id


def report(log: StateLog, clips: DataFrame, tries: Column | int) -> None:
    """Clips with a message fail for good."""
    log.append(clips, "Failed", tries, F.col("message"))
    log.bury(clips, F.col("message"))


def written(spark: SparkSession, config: PipelineConfig, run_id: str, good: DataFrame, results: dict[str, DataFrame], write: Callable, sleep: Callable[[float], None]) -> DataFrame:
    """Write all artifacts of the clips; returns clip_id, message of those that could not be written.

    Every clip has its description, masks and the three pose tables, empty ones included, and camera poses if enabled.
    A write that fails is repeated as the retry policy says, and beyond that halved.
    """
    names = ["masks", "hand_pose", "object_pose", "mapping"] + ["fast3r_pose"] * config.operators["fast3r"].enabled
    limit, lost = config.backpressure.max_in_flight_write, []

    def one(clips: DataFrame) -> None:
        keyed = clips.select(F.lit(run_id).alias("run_id"), "video_id", "clip_id")
        sinks.write_meta(clips.select(*schemas.TASK), keyed, config.paths.output_root, config.coordinates, limit)
        for name in names:
            if name in results:
                mine = results[name].join(clips.select("clip_id"), "clip_id", "left_semi")
                rows = clip_ops.mask_rows(mine, clips) if name == "masks" else exploded(mine)
            else:
                rows = spark.createDataFrame([], f"clip_id string, {schemas.ARTIFACTS[name]}")
            write(rows.join(keyed, "clip_id").repartition(limit, "clip_id"), keyed, config.paths.output_root, name, config.parquet)

    def attempt(clips: DataFrame, depth: int, tries: int) -> None:
        try:
            one(clips)
        except Exception as error:  # noqa: BLE001  found to be some clip's, below
            kinds, text = errors.ancestry(error), str(error)
            said = spark.range(1).select(errors.retryable(F.array(*map(F.lit, kinds)).cast("array<string>"), F.lit(text))).head()[0]
            if said and tries < config.retry.max_retries:
                sleep(config.retry.next_delay(tries + 1))
                attempt(clips, depth, tries + 1)
            elif len(some := clips.select("clip_id").limit(2).collect()) > 1 and depth < 63:
                for half in (0, 1):
                    part = clips.where(F.shiftright(F.xxhash64("clip_id"), depth).bitwiseAND(1) == half)
                    if part.head(1):
                        attempt(part, depth + 1, config.retry.max_retries)
            else:
                lost.extend((r["clip_id"], text) for r in some)

    if good.head(1):
        attempt(good, 0, 0)
    return spark.createDataFrame(lost, "clip_id string, message string")  # the clips that failed one by one
