"""Shells around the models that configurations name. The models are found where workers have them installed; a worker
without one reports it as a clip's lasting failure."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np

from clipwright.functions.errors import ModelMissingError
from clipwright.plans.config import PromptConfig, first_existing
from clipwright.sources import video


def first_accepted(*calls: Callable[[], Any]) -> Any:
    """The result of the first call that goes through: releases of a model differ in how they want to be called. The
    last call's error counts."""
    for call in calls[:-1]:
        with contextlib.suppress(Exception):
            return call()
    return calls[-1]()


class TextDetector:
    """Finds what a text names in each prompt frame of a clip."""

    def __init__(self, prompt: PromptConfig):
        self.prompt, self.model, self.tools = prompt, None, None

    def load(self) -> None:
        if self.model is None:
            try:
                from groundingdino.util import inference
            except ImportError as absent:
                raise ModelMissingError(f"no detector on this worker: {absent}") from absent
            self.tools, given = inference, (self.prompt.gd_config, self.prompt.gd_checkpoint)
            self.model = first_accepted(lambda: inference.Model(*given, device=self.prompt.gd_device), lambda: inference.load_model(*given, device=self.prompt.gd_device))

    def predict(self, image: np.ndarray) -> tuple[int, int, Any, Any, Any]:
        """Height, width, boxes, scores, phrases."""
        bounds = {"box_threshold": self.prompt.box_threshold, "text_threshold": self.prompt.text_threshold}
        if hasattr(self.model, "predict_with_caption"):
            return *image.shape[:2], *self.model.predict_with_caption(image, self.prompt.prompt_text, **bounds)
        handle, path = tempfile.mkstemp(suffix=".jpg")
        os.close(handle)
        try:
            video.write_image(path, image)
            source, tensor = self.tools.load_image(path)
            return *source.shape[:2], *self.tools.predict(model=self.model, image=tensor, caption=self.prompt.prompt_text, **bounds)
        finally:
            os.remove(path)

    def detect(self, task: dict[str, Any]) -> Iterator[dict[str, Any]]:
        self.load()
        wanted = [int(f) for f in task["prompt_frames"]]
        stride = wanted[1] - wanted[0] if len(wanted) > 1 else 1
        with video.extracted(task["video_path"], task["start_s"], task["end_s"]) as path:
            for _, (offset, _, image) in zip(wanted, video.read_frames(path, 0.0, 1e9, stride)):
                height, width, boxes, scores, phrases = self.predict(image)
                boxes = np.asarray(boxes, np.float64).reshape(-1, 4)
                yield {"frame": offset, "height": int(height), "width": int(width), "boxes": boxes.tolist(), "scores": np.asarray(scores, np.float64).ravel()[: len(boxes)].tolist(), "phrases": [str(p) for p in phrases]}


class BoxSegmenter:
    """Segments a clip from boxes, each given to an object at a frame."""

    def __init__(self, params: dict[str, Any]):
        self.params, self.model = params, None

    def load(self) -> None:
        if self.model is None:
            try:
                import sam2
                from sam2.build_sam import build_sam2_video_predictor as build
            except ImportError as absent:
                raise ModelMissingError(f"no segmenter on this worker: {absent}") from absent
            root = os.path.join(os.path.dirname(sam2.__file__ or ""), "configs")
            settings, weights = first_existing(self.params.get("config"), (os.path.join(root, "sam2.1"), root)), self.params.get("checkpoint")
            if not settings or not weights:
                raise ModelMissingError("the segmenter needs config and checkpoint among its params")
            extras = {"device": self.params.get("device", "cuda"), "vos_optimized": bool(self.params.get("vos_optimized", False))}
            self.model = first_accepted(lambda: build(settings, weights, **extras), lambda: build(settings, weights))

    @contextlib.contextmanager
    def precision(self) -> Iterator[None]:
        """Inference in half precision, where torch is there to run it."""
        try:
            import torch
        except ImportError:
            yield
            return
        kind = torch.bfloat16 if self.params.get("precision", "bf16") == "bf16" else torch.float16
        with torch.inference_mode(), torch.autocast(device_type="cuda" if "cuda" in self.params.get("device", "cuda") else "cpu", dtype=kind):
            yield

    def frames(self, task: dict[str, Any]) -> Iterator[dict[str, Any]]:
        self.load()
        model = self.model
        with video.extracted(task["video_path"], task["start_s"], task["end_s"]) as path, self.precision():
            state = first_accepted(lambda: model.init_state(path), lambda: model.init_state(video_path=path))
            for p in task["prompts"]:
                place, box = (int(p["frame"]), int(p["object"])), np.array([p[c] for c in ("x1", "y1", "x2", "y2")], np.float32)
                first_accepted(lambda: model.add_new_points_or_box(state, frame_idx=place[0], obj_id=place[1], box=box), lambda: model.add_new_points_or_box(state, *place, tuple(box.tolist())))
            for offset, _, logits in model.propagate_in_video(state):
                yield {"offset": int(offset), "planes": positive(logits)}


def positive(logits: Any) -> np.ndarray | None:
    """Planes of what is above zero, whatever holds the logits; None where there is nothing."""
    if logits is None:
        return None
    if hasattr(logits, "detach"):
        logits = logits.detach().float().cpu().numpy()
    planes = np.asarray(logits) > 0
    return planes if planes.size else None
