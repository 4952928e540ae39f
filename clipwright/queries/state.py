"""The state log, resumption, retries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwright import fixtures
from clipwright.fixtures import with_
from clipwright.functions import errors
from clipwright.operators import manifest, state
from clipwright.plans.config import BackpressureConfig
from clipwright.queries.manifest import framed_clips


def state_latest(spark, sf_dir):
    return state.latest(fixtures.state_events(spark, sf_dir))


def resumable(spark, sf_dir):
    return state.resumable(state_latest(spark, sf_dir)).select("clip_key", "status")


def resumable_failed(spark, sf_dir):
    return state.resumable(state_latest(spark, sf_dir), ("Failed",)).select("clip_key", "status")


def insert_pending(spark, sf_dir):
    log = fixtures.state_events(spark, sf_dir)
    return state.insert_pending(state.latest(log.where("seq % 20 = 0")), log.where("seq % 2 = 1"))


def resume_semi(spark, sf_dir):
    todo = resumable(spark, sf_dir).select(F.col("clip_key").alias("video_id"))
    return fixtures.clips(spark, sf_dir).join(todo, "video_id", "left_semi")


def dead_letters(spark, sf_dir):
    return state.dead_letters(fixtures.state_events(spark, sf_dir))


#: Crafted failures: ancestry, comma-joined, and message.
FAILURES = (
    ("TransientIOError,RetryableError", "disk"), ("", "CUDA Out Of Memory"), ("RuntimeError", "CUDA launch Error"), ("DecodeError", "out of memory"), ("", "cuda"), ("OOMError,RetryableError", ""),
    ("ValueError", "no frames"), ("InvalidDataError", "x"), ("RetryableError", "socket reset"), ("MountLost,TransientIOError,RetryableError,OSError", "gone"), ("BadIndex,InvalidDataError,KeyError", "cuda error"), ("TransientIOError", "by its name alone"),
)


def _failures(spark, sf_dir):
    pick = lambda k: F.element_at(F.array(*[F.lit(f[k]) for f in FAILURES]), (F.col("seq") % len(FAILURES)).cast("int") + 1)
    return fixtures.state_events(spark, sf_dir).select("seq", F.split(pick(0), ",").alias("kinds"), pick(1).alias("message"))


def classify_errors(spark, sf_dir):
    k, m = F.col("kinds"), F.col("message")
    return _failures(spark, sf_dir).select("seq", errors.reason(k, m).alias("reason"), errors.retryable(k, m).alias("retryable"))


def retry_schedule(spark, sf_dir):
    rows = _failures(spark, sf_dir).withColumn("attempt", (F.col("seq") % 6).cast("int"))
    again = errors.retryable(F.col("kinds"), F.col("message")) & (F.col("attempt") < 3)
    return rows.select("seq", "attempt", again.alias("again"), errors.next_delay(F.col("attempt") + 1).alias("delay_s"))


def transition_audit(spark, sf_dir):
    return state.transitions(fixtures.state_events(spark, sf_dir))


def round_robin(spark, sf_dir):
    """Which of 4 workers takes each scheduled clip."""
    rows = manifest.schedule(framed_clips(spark, sf_dir), "video_id", "line", "part", "supp", "start_s")
    return rows.select("place", "video_id", F.pmod(F.col("place") - 1, F.lit(4)).alias("worker"))


def backpressure_resolve(spark, sf_dir):
    """In-flight limits by the configuration's rule: none or zero means twice the workers."""
    known = [(g, n, BackpressureConfig(max_in_flight_gpu=g).resolved(n).max_in_flight_gpu) for g in (None, 0, 1, 2, 3, 4) for n in (1, 2, 3, 4)]
    known = spark.createDataFrame(known, "given int, workers int, in_flight int")
    given = F.when(F.col("s_suppkey") % 3 == 0, F.lit(None)).otherwise((F.col("s_suppkey") % 5).cast("int"))
    rows = fixtures.table(spark, sf_dir, "supplier").select("s_suppkey", given.alias("wanted"), (F.col("s_suppkey") % 4 + 1).cast("int").alias("n"))
    return rows.join(F.broadcast(known), F.col("wanted").eqNullSafe(F.col("given")) & (F.col("n") == F.col("workers"))).select("s_suppkey", "in_flight")


def state_lookup(spark, sf_dir):
    return state.lookup(fixtures.state_events(spark, sf_dir), "clip_key", 7)


def id_membership(spark, sf_dir):
    """How many clips of each state the manifest names; ids only in the state are ignored."""
    named = fixtures.clips(spark, sf_dir).select(F.col("video_id").alias("clip_key"))
    return state_latest(spark, sf_dir).join(named, "clip_key", "left_semi").groupBy("status").agg(F.count(F.lit(1)).alias("clips"))


QUERIES = {f.__name__: f for f in (state_latest, resumable, resumable_failed, insert_pending, resume_semi, dead_letters, classify_errors, retry_schedule, transition_audit, round_robin, backpressure_resolve, id_membership, state_lookup)}

_LATEST = """latest AS (
  SELECT clip_key, arg_min(video_id, seq) AS video_id, arg_max(status, seq) AS status, arg_max(last_error, seq) AS last_error,
         arg_max(retry_count, seq) AS retry_count, arg_max(updated_at, seq) AS updated_at FROM state_events GROUP BY clip_key)"""
_OPEN = "status IN ('Pending', 'Failed', 'Writing', 'Running')"
_CASES = "failures AS (SELECT event_id AS seq, " + ", ".join(f"CASE event_id % {len(FAILURES)} " + " ".join(f"WHEN {k} THEN '{f[n]}'" for k, f in enumerate(FAILURES)) + f" END AS {name}" for n, name in enumerate(("kinds", "message"))) + " FROM events)"
_PASSING = f"list_has_any(string_split(kinds, ','), {list(errors.PASSING)})"
_REASON = f"CASE WHEN list_has_any(string_split(kinds, ','), {list(errors.PASSING + errors.LASTING)}) THEN string_split(kinds, ',')[1] WHEN contains(lower(message), 'out of memory') THEN 'oom' WHEN contains(lower(message), 'cuda') AND contains(lower(message), 'error') THEN 'cuda_error' ELSE 'unknown' END"
_AGAIN = f"({_PASSING} OR ({_REASON}) IN ('oom', 'cuda_error'))"

SQL = {
    "state_latest": f"{with_('state_events')}, {_LATEST} SELECT * FROM latest",
    "state_lookup": f"{with_('state_events')}, {_LATEST} SELECT * FROM latest WHERE clip_key = 7",
    "resumable": f"{with_('state_events')}, {_LATEST} SELECT clip_key, status FROM latest WHERE {_OPEN}",
    "resumable_failed": f"{with_('state_events')}, {_LATEST} SELECT clip_key, status FROM latest WHERE status = 'Failed'",
    "insert_pending": f"""{with_('state_events')}
SELECT clip_key, arg_min(video_id, seq) AS video_id, 'Pending' AS status, '' AS last_error, 0 AS retry_count FROM state_events
WHERE seq % 2 = 1 AND clip_key NOT IN (SELECT clip_key FROM state_events WHERE seq % 20 = 0) GROUP BY clip_key""",
    "resume_semi": f"{with_('clips', 'state_events')}, {_LATEST} SELECT * FROM clips WHERE video_id IN (SELECT clip_key FROM latest WHERE {_OPEN})",
    "dead_letters": f"{with_('state_events')} SELECT clip_key, video_id, last_error AS error, updated_at FROM state_events WHERE status = 'Failed' AND retry_count >= 3",
    "classify_errors": f"WITH {_CASES} SELECT seq, {_REASON} AS reason, {_AGAIN} AS retryable FROM failures",
    "retry_schedule": f"WITH {_CASES} SELECT seq, (seq % 6)::INT AS attempt, {_AGAIN} AND seq % 6 < 3 AS again, 5.0 * pow(3.0, seq % 6) AS delay_s FROM failures",
    "transition_audit": f"""{with_('state_events')}, steps AS (
  SELECT coalesce(lag(status) OVER (PARTITION BY clip_key ORDER BY seq), '') AS before, status AS after FROM state_events)
SELECT before, after, count(*) AS n, before = '' OR before || '>' || after IN ('Pending>Running', 'Running>Writing', 'Writing>Done', 'Running>Failed', 'Writing>Failed', 'Failed>Running') AS allowed
FROM steps GROUP BY before, after""",
    "round_robin": f"""{with_('clips')}, placed AS (
  SELECT row_number() OVER (ORDER BY end_s - start_s DESC, video_id, line, part, supp, start_s) AS place, video_id FROM clips)
SELECT place, video_id, (place - 1) % 4 AS worker FROM placed""",
    "backpressure_resolve": """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 THEN 2 * (s_suppkey % 4 + 1)::INT ELSE (s_suppkey % 5)::INT END AS in_flight FROM supplier""",
    "id_membership": f"{with_('clips', 'state_events')}, {_LATEST} SELECT status, count(*) AS clips FROM latest WHERE clip_key IN (SELECT video_id FROM clips) GROUP BY status",
}
