"""Mask planes: thresholds, unions, run lengths, and frames to look at."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.functions.masks import transposed
from clipwright.functions.time import frames_from_seconds, seconds_from_frames, stride_of
from clipwright.operators.models import run_lengths


#: Pixels in one number while planes are united.
WORD = 62


def level(planes: DataFrame, threshold: float):
    """A threshold in the precision of the planes' values, in which both are compared: a value stored as a float 0.15 is
    not above 0.15, though it would be in double precision."""
    kind = planes.schema["plane"].dataType.elementType.simpleString()
    return F.lit(float(threshold)).cast("float" if kind == "float" else "double")


def union(planes: DataFrame, key: str, height: int, width: int, threshold: float = 0.0) -> DataFrame:
    """The planes of a key united bit by bit: key, bits (row by row). Planes travel as numbers of WORD pixels, united
    before and after the shuffle, so any number of planes makes as many rows as one plane has words."""
    words, above = -(-height * width // WORD), level(planes, threshold)
    number = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, v: F.shiftleft(a, 1) + (v > above).cast("long"))
    packed = F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: number(F.slice("plane", w * WORD + 1, F.lit(WORD))))
    united = planes.select(key, F.posexplode(packed).alias("word", "bits")).groupBy(key, "word").agg(F.bit_or("bits").alias("bits"))
    whole = united.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    size = lambda w: F.least(F.lit(WORD), F.lit(height * width) - w["word"] * WORD)
    spelled = F.concat_ws("", F.transform("words", lambda w: F.lpad(F.bin(w["bits"]), size(w), "0")))
    return whole.select(key, F.transform(F.split(spelled, ""), lambda c: c.cast("int")).alias("bits"))


def runs(planes: DataFrame, key: str, height: int, width: int, threshold: float = 0.0) -> DataFrame:
    """Run lengths, column by column, as rows: key, run (from 0, the first being of zeros and absent if there is none),
    bit, length. Each plane is encoded where it is read, its values compared in their own precision; a null plane has
    no runs."""
    threshold = float(threshold)  # numpy takes a Python number in the values' precision

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, run, bit, length = [], [], [], []
            for name, plane in zip(batch.column(0).to_pylist(), batch.column(1)):
                if plane.is_valid:
                    values = plane.values.to_numpy(zero_copy_only=False)
                    counts = [(k, n) for k, n in enumerate(run_lengths((values > threshold).reshape(height, width))) if n]
                    keys += [name] * len(counts)
                    run += [k for k, _ in counts]
                    bit += [k % 2 for k, _ in counts]
                    length += [n for _, n in counts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(run, pa.int64()), pa.array(bit, pa.int32()), pa.array(length, pa.int64())], [key, "run", "bit", "length"])

    rows = planes.select(key, "plane")
    return rows.mapInArrow(encode, rows.select(key).schema.add("run", "long").add("bit", "integer").add("length", "long"))


def bits_by_column(plane, height: int, width: int, threshold=0.0):
    """threshold: a number, compared in double precision, or a column such as `level`."""
    return F.transform(transposed(plane, height, width), lambda v: (v > threshold).cast("int"))


def prompt_frames(videos: DataFrame, interval_s: float, most: int) -> DataFrame:
    """Frames to detect on: every interval, at most `most` (at least one): video_id, nth, frame, at_s."""
    rate = F.when(F.coalesce(F.col("fps"), F.lit(0.0)) == 0, F.lit(30.0)).otherwise(F.col("fps"))
    last = frames_from_seconds(F.col("duration_s"), rate)
    frames = F.slice(F.sequence(F.lit(0), last, stride_of(F.lit(interval_s), F.col("fps"))), F.lit(1), F.lit(max(1, most)))
    at = videos.select("video_id", rate.alias("rate"), F.posexplode(frames).alias("nth", "frame"))
    return at.select("video_id", "nth", "frame", seconds_from_frames(F.col("frame"), F.col("rate")).alias("at_s"))


def frames_between(clips: DataFrame, stride) -> DataFrame:
    """Every stride-th frame of each clip, its last frame included: clips' columns, offset, frame, at_s."""
    step = F.greatest(F.lit(1), stride)
    frames = F.when(F.col("frame_end") >= F.col("frame_start"), F.sequence("frame_start", "frame_end", step)).otherwise(F.array().cast("array<int>"))
    at = clips.withColumn("frame", F.explode(frames))
    return at.withColumns({"offset": F.col("frame") - F.col("frame_start"), "at_s": seconds_from_frames(F.col("frame"), F.col("fps"))})


def found(masks: DataFrame, *by: str, mask: str = "mask_rle") -> DataFrame:
    """How many frames there are and how many have a mask: those without one are left out of artifacts, though counted."""
    return masks.groupBy(*by).agg(F.count(F.lit(1)).alias("frames"), F.count(mask).alias("with_mask"))


def absolute(frames: DataFrame) -> DataFrame:
    """Adds frame_index and timestamp_s of frames counted from a clip's start."""
    rate = F.when(F.coalesce(F.col("fps"), F.lit(0.0)) == 0, F.lit(30.0)).otherwise(F.col("fps"))
    index = F.col("offset") + F.rint(F.col("start_s") * rate).cast("int")
    return frames.withColumn("frame_index", index.cast("long")).withColumn("timestamp_s", seconds_from_frames(F.col("frame_index"), rate))
