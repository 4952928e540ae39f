"""Command line: make-manifest and run."""

from __future__ import annotations

import argparse
import importlib

from clipwright import schemas
from clipwright.operators.models import Detector, Segmenter
from clipwright.operators.shells import BoxSegmenter, TextDetector
from clipwright.plans import manifests as building
from clipwright.plans.config import PromptConfig, load_config
from clipwright.plans.runner import run as run_clips
from clipwright.session import build_session
from clipwright.sources import manifests, sinks, video


def named(factory: str):
    """What module:name stands for."""
    module, _, name = factory.partition(":")
    return getattr(importlib.import_module(module), name)


def make_manifest(args: argparse.Namespace) -> None:
    spark, config = build_session(args.master), load_config(args.config)
    files = manifests.discover(spark, args.input_dir, args.glob)
    if args.cuts:
        cuts = spark.read.schema("path string, at_s double").json(args.cuts)
    elif args.scene_detector:
        cuts = video.detect_scenes(files, named(args.scene_detector))
    else:
        cuts = spark.createDataFrame([], "path string, at_s double")
    videos, clips = building.build(building.probe_files(files), cuts, args.split, config.scenedetect, manifests.checksums(spark, args.input_dir, args.glob))
    sinks.write_json_lines(videos, f"{args.output_dir}/video_manifest.jsonl")
    sinks.write_json_lines(clips, f"{args.output_dir}/clip_manifest.jsonl")


def run(args: argparse.Namespace) -> None:
    spark = build_session(args.master)
    videos = manifests.read_manifest(spark, args.video_manifest, schemas.VIDEOS, ordinal=True)
    clips = manifests.read_manifest(spark, args.clip_manifest, schemas.CLIPS, ordinal=True)
    config = load_config(args.config)
    params = config.operators["sam2"].params
    prompt = PromptConfig.load(params.get("prompting") or {})
    segmenter = Segmenter(named(args.predictor) if args.predictor else lambda: BoxSegmenter(params))
    if args.detector or not args.predictor:
        detector = Detector(named(args.detector) if args.detector else lambda: TextDetector(prompt))
    else:
        detector = None  # a predictor given by itself finds its own prompts
    print(run_clips(spark, config, videos, clips, segmenter, detector=detector, config_path=args.config))


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clipwright")
    parser.add_argument("--master", default=None)
    commands = parser.add_subparsers(dest="command", required=True)
    make = commands.add_parser("make-manifest", help="videos to manifests")
    for flag, default in (("--input-dir", None), ("--output-dir", None), ("--config", None), ("--split", "train"), ("--glob", "**/*.mp4"), ("--cuts", ""), ("--scene-detector", "")):
        make.add_argument(flag, default=default, required=default is None)
    make.set_defaults(call=make_manifest)
    go = commands.add_parser("run", help="manifests to artifacts")
    for flag in ("--config", "--video-manifest", "--clip-manifest"):
        go.add_argument(flag, required=True)
    for flag in ("--predictor", "--detector"):  # module:factory; the configured models without them
        go.add_argument(flag, default="")
    go.set_defaults(call=run)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    args.call(args)


if __name__ == "__main__":
    main()
