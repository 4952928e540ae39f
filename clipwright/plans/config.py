"""Typed configuration and its record in the run manifest."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, replace
from datetime import datetime, timezone
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class ParquetConfig:
    compression: str = "zstd"
    row_group_size: int = 268435456
    data_page_size: int = 8388608
    partition: tuple[str, ...] = ("run_id", "video_id", "clip_id")

    def options(self) -> dict[str, str]:
        """Spark's writer options; sizes are bytes."""
        return {"compression": self.compression, "parquet.block.size": str(self.row_group_size), "parquet.page.size": str(self.data_page_size)}


@dataclass(frozen=True)
class BackpressureConfig:
    max_in_flight_cpu: int | None = None
    max_in_flight_gpu: int | None = None
    max_in_flight_write: int | None = None

    def resolved(self, num_gpus: int) -> BackpressureConfig:
        """None and zero mean twice the number of GPUs."""
        return BackpressureConfig(*((getattr(self, f.name) or 2 * num_gpus) for f in fields(self)))


@dataclass(frozen=True)
class RetryPolicy:
    max_retries: int = 3
    base_delay_s: float = 5.0
    backoff: float = 3.0

    def next_delay(self, attempt: int) -> float:
        return self.base_delay_s * self.backoff ** max(0, attempt - 1)


@dataclass(frozen=True)
class SceneDetectConfig:
    method: str = "scenedetect"
    min_scene_len_s: float = 1.0
    fallback_full_clip: bool = True
    overlap_s: float = 1.0


@dataclass(frozen=True)
class CoordinateSpec:
    """How times, lengths and rotations are written."""

    spec_version: str = "v1"
    time_base: str = "seconds"
    mask_encoding: str = "rle"
    length_unit: str = "meters"
    handedness: str = "right"
    quat_order: str = "wxyz"
    frame_index_base: int = 0
    axis_order: str = "x,y,z"
    coord_frame: str = "camera"


@dataclass(frozen=True)
class MetricsThresholds:
    gpu_util_min: float = 0.60
    gpu_util_window_s: int = 600
    failure_rate_max: float = 0.01
    empty_mask_rate_max: float = 0.20


@dataclass(frozen=True)
class PathsConfig:
    """state_db_path is the folder of the state log here."""

    data_root: str = "./data"
    output_root: str = "./output"
    manifest_path: str = "./manifests"
    state_db_path: str = "./state/pipeline.db"
    runlog_path: str = "./runlog.md"


@dataclass(frozen=True)
class PromptConfig:
    source: str = "groundingdino"
    prompt_text: str = "hand ."
    prompt_interval_s: float = 2.0
    max_prompts_per_clip: int = 60
    max_boxes_per_frame: int = 6
    box_threshold: float = 0.35
    text_threshold: float = 0.25
    nms_iou: float = 0.5
    min_box_area: float = 256.0
    gd_config: str = "./models/groundingdino/GroundingDINO_SwinT_OGC.py"
    gd_checkpoint: str = "./models/groundingdino/groundingdino_swint_ogc.pth"
    gd_device: str = "cuda"

    @classmethod
    def load(cls, raw: dict[str, Any]) -> PromptConfig:
        """Absent keys take their defaults; present ones are cast, so null fails where a number is asked for."""
        kinds = {f.name: type(f.default) for f in fields(cls)}
        return cls(**{k: kinds[k](v) if kinds[k] is not str else v for k, v in raw.items() if k in kinds})


@dataclass(frozen=True)
class OperatorConfig:
    enabled: bool = False
    params: dict[str, Any] = field(default_factory=dict)


OPERATORS = ("sam2", "hamer", "foundationpose", "dex_retarget", "fast3r")


def operator_configs(raw: dict[str, Any]) -> dict[str, OperatorConfig]:
    """The known operators; the segmenter is on by default, the others off, unknown names are ignored."""
    out = {}
    for name in OPERATORS:
        given = raw.get(name) or {}
        out[name] = OperatorConfig(bool(given.get("enabled", name == "sam2")), dict(given.get("params") or {}))
    return out


@dataclass(frozen=True)
class PipelineConfig:
    run_id: str | None = None
    num_gpus: int = 1
    paths: PathsConfig = PathsConfig()
    parquet: ParquetConfig = ParquetConfig()
    backpressure: BackpressureConfig = BackpressureConfig()
    retry: RetryPolicy = RetryPolicy()
    scenedetect: SceneDetectConfig = SceneDetectConfig()
    coordinates: CoordinateSpec = CoordinateSpec()
    metrics: MetricsThresholds = MetricsThresholds()
    operators: dict[str, OperatorConfig] = field(default_factory=lambda: operator_configs({}))
    model_versions: dict[str, str] = field(default_factory=dict)
    dataset_hash: str | None = None
    code_git_hash: str | None = None
    extra: dict[str, Any] = field(default_factory=dict)

    def resolved(self) -> PipelineConfig:
        return replace(self, backpressure=self.backpressure.resolved(self.num_gpus))

    def run_manifest(self, run_id: str = "", created_at: str = "", config_path: str = "") -> dict[str, str]:
        """One row of ten strings; nested values are JSON texts."""
        return {
            "run_id": run_id or self.run_id or "", "created_at": created_at, "config_path": config_path, "code_git_hash": self.code_git_hash or "",
            "model_versions": json.dumps(self.model_versions), "dataset_hash": self.dataset_hash or "", "parquet_params": json.dumps(asdict(self.parquet)),
            "coordinate_spec_version": self.coordinates.spec_version, "mask_encoding": self.coordinates.mask_encoding, "time_base": self.coordinates.time_base,
        }


SECTIONS = {"paths": PathsConfig, "parquet": ParquetConfig, "backpressure": BackpressureConfig, "retry": RetryPolicy, "scenedetect": SceneDetectConfig, "coordinates": CoordinateSpec, "metrics": MetricsThresholds}


def load_config(path: str) -> PipelineConfig:
    """JSON by its suffix, anything else YAML. Unknown keys in a section are errors, unknown sections ignored."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        raw = json.loads(text)
    else:
        import yaml

        raw = yaml.safe_load(text)
    given: dict[str, Any] = {name: kind(**(raw.get(name) or {})) for name, kind in SECTIONS.items()}
    given["parquet"] = replace(given["parquet"], partition=tuple(given["parquet"].partition))
    plain = {k: raw[k] for k in ("run_id", "num_gpus", "model_versions", "dataset_hash", "code_git_hash", "extra") if raw.get(k) is not None}
    return PipelineConfig(operators=operator_configs(raw.get("operators") or {}), **given, **plain)


def make_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def created_at(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).replace(tzinfo=None).isoformat() + "Z"


def first_existing(path: str | None, roots: tuple[str, ...]) -> str | None:
    """A model's settings file: the path itself if it exists, else the same name under the roots, else the path."""
    if not path or Path(path).is_file():
        return path
    return next((str(p) for p in (Path(r) / Path(path).name for r in roots) if p.is_file()), path)
