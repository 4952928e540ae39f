"""Video containers, by the command line tools of the machines that run the workers: properties and cuts in time."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

PROPERTIES = "path string, fps double, width int, height int, frame_count long"


def tool(name: str) -> str:
    found = shutil.which(name)
    if found is None:
        raise RuntimeError(f"{name} is not installed on this worker")
    return found


def local(path: str) -> str:
    return path.removeprefix("file:") if path.startswith("file:/") else path


def probe(path: str) -> dict:
    """What ffprobe says of a file; one it cannot read is an error."""
    said = subprocess.run([tool("ffprobe"), "-v", "error", "-print_format", "json", "-show_streams", "-show_format", local(path)], check=True, capture_output=True, text=True, timeout=300)
    return json.loads(said.stdout)


def properties(files: DataFrame) -> DataFrame:
    """PROPERTIES of each file's first video stream, zero where it doesn't say; a file that cannot be read has zeros."""

    def of(path: str) -> tuple:
        try:
            stream = next((s for s in probe(path).get("streams", []) if s.get("codec_type") == "video"), {})
        except (subprocess.SubprocessError, ValueError):
            stream = {}
        over, _, under = str(stream.get("r_frame_rate") or "0").partition("/")
        rate = float(over) / float(under or 1) if float(under or 1) else 0.0
        return path, rate, int(stream.get("width") or 0), int(stream.get("height") or 0), int(stream.get("nb_frames") or 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([of(p) for p in batch["path"]], columns=["path", "fps", "width", "height", "frame_count"])

    return files.select("path").mapInPandas(run, PROPERTIES)


@contextmanager
def extracted(path: str, start_s: float, end_s: float) -> Iterator[str]:
    """A file of the given time of a video, without sound, while the block runs; the video itself if neither bound is
    above zero, or if it cannot be cut."""
    if start_s <= 0 and end_s <= 0:
        yield local(path)
        return
    handle, cut = tempfile.mkstemp(suffix=".mp4")
    os.close(handle)
    try:
        try:
            subprocess.run([tool("ffmpeg"), "-y", "-ss", str(max(0.0, start_s)), "-to", str(max(0.0, end_s)), "-i", local(path), "-c", "copy", "-an", cut], check=True, capture_output=True)
            found = cut
        except (subprocess.SubprocessError, RuntimeError, OSError):
            found = local(path)
        yield found
    finally:
        os.remove(cut)


def read_frames(path: str, start_s: float, end_s: float, stride: int) -> Iterator[tuple[int, float, np.ndarray]]:
    """(frame from start_s on, its second in the video, RGB image) of every stride-th frame, the last included; a stride
    below one is one, and the video's end ends it."""
    stream = next(s for s in probe(path)["streams"] if s.get("codec_type") == "video")
    over, _, under = str(stream["r_frame_rate"]).partition("/")
    fps, width, height = float(over) / float(under or 1), int(stream["width"]), int(stream["height"])
    first, last, step = round(start_s * fps), round(end_s * fps), max(1, stride)
    chosen = f"select=between(n\\,{first}\\,{last})*not(mod(n-{first}\\,{step}))"
    command = [tool("ffmpeg"), "-v", "error", "-i", local(path), "-an", "-vf", chosen, "-fps_mode", "passthrough", "-f", "rawvideo", "-pix_fmt", "rgb24", "-"]
    with subprocess.Popen(command, stdout=subprocess.PIPE) as running:
        try:
            offset = 0
            while len(data := running.stdout.read(width * height * 3)) == width * height * 3:
                yield offset, (first + offset) / fps, np.frombuffer(data, np.uint8).reshape(height, width, 3)
                offset += step
        finally:
            running.kill()


def write_image(path: str, image: np.ndarray) -> None:
    """An RGB image as a file, in the order of channels that the writer wants."""
    import cv2

    cv2.imwrite(path, np.ascontiguousarray(image[..., ::-1]))


def detect_scenes(files: DataFrame, load: Callable[[], Callable[[str], list[float]]]) -> DataFrame:
    """path, at_s: the cuts a scene detector finds, loaded once per worker task; files it fails on have none, and so
    become one clip marked as not detected."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            out = []
            for path in batch["path"]:
                try:
                    model = model or load()
                    out += [(path, float(at)) for at in model(local(path))]
                except Exception:  # noqa: BLE001, S112  the manifest says which videos went undetected
                    continue
            yield pd.DataFrame(out, columns=["path", "at_s"])

    return files.select("path").mapInPandas(run, "path string, at_s double")

