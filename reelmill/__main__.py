"""python -m reelmill run|validate|check CONFIG [options]

run writes pictures, the sequence manifest, the split manifest and a summary; validate looks at the sources and writes
nothing; check holds what a run has written against the rules of a manifest and the pictures that are there.
"""

from __future__ import annotations

import argparse
import importlib
import json
import logging
import os
import sys


def named(text: str):
    """module:attribute"""
    module, _, name = text.partition(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="reelmill", description=__doc__)
    out.add_argument("what", choices=("run", "validate", "check"))
    out.add_argument("config", help="YAML settings")
    out.add_argument("--decoder", help="module:function that decodes a path")
    out.add_argument("--detector", help="module:function that makes a detector (otherwise the one that the settings name)")
    out.add_argument("--dataset", action="append", help="only this source; may be repeated")
    out.add_argument("--max-videos", type=int)
    out.add_argument("--workers", type=int, help="tasks that videos are dealt to")
    out.add_argument("--steps", type=int, default=1, help="parts that are saved one after the other")
    out.add_argument("--overwrite", action="store_true", help="clear the sequence folder and start anew")
    out.add_argument("--resume", action="store_true", help="leave out videos that have sequences (as without --no-resume)")
    out.add_argument("--allow-partial", action="store_true", help="check: splits may be missing")
    out.add_argument("--log", help="also log to this file")
    out.add_argument("--no-resume", action="store_true", help="make videos again that have sequences")
    return out


def main(args: list[str]) -> int:
    from pyspark.sql import SparkSession

    from reelmill.operators.validate import require_valid
    from reelmill.operators.vision import detector_named
    from reelmill.plans import config, output, run
    from reelmill.sources.listing import list_files
    from reelmill.shared import release
    from reelmill.sources.manifests import discover, read_sequences

    options = parser().parse_args(args)
    handlers = [logging.StreamHandler(sys.stdout), *([logging.FileHandler(options.log)] if options.log else [])]
    logging.basicConfig(level=logging.INFO, handlers=handlers, format="%(asctime)s %(levelname)s %(message)s")
    settings = config.load(options.config)
    spark = SparkSession.builder.appName("reelmill").getOrCreate()
    folder, pictures = os.path.join(settings.output_dir, "manifest"), os.path.join(settings.output_dir, settings.sequence_dir)
    csv, splits = (os.path.join(settings.output_dir, "manifests", f"{n}_manifest.csv") for n in ("sequence", "split"))
    if options.what == "validate":
        _, told = run.preprocess(spark, settings, None, None, wanted=options.dataset, max_videos=options.max_videos, validate_only=True)
    elif options.what == "check":
        if not output.exists(spark, csv):
            raise ValueError(f"no manifest: {csv}")
        listing = list_files(spark, pictures).select("relative").withColumnRenamed("relative", "path")
        told = require_valid(read_sequences(spark, csv), listing, not options.allow_partial)
    else:
        if not options.decoder:
            parser().error("run needs --decoder")
        if options.overwrite and options.dataset:
            parser().error("--overwrite clears the sequences of all sources; leave out --dataset")
        if options.overwrite and options.resume:
            parser().error("--overwrite starts anew; leave out --resume")
        if options.resume and options.no_resume:
            parser().error("--resume or --no-resume")
        detector = named(options.detector) if options.detector else detector_named(settings.detector)
        if options.overwrite:
            output.reset_sequences(settings)
            output.clear(spark, folder)
        os.makedirs(os.path.dirname(csv), exist_ok=True)
        write = lambda rows, frames: output.write_images(output.sequence_images(rows, frames, settings), pictures).collect()
        how = {"wanted": options.dataset, "max_videos": options.max_videos, "resume": not options.no_resume, "pictures": write, "workers": options.workers}
        manifest, told = run.preprocess_in_steps(spark, settings, named(options.decoder), detector, folder, options.steps, **how)
        output.write_csv(manifest.orderBy("split", "label", "dataset_id", "video_id", "start_time"), csv)
        videos, _ = discover(spark, list(settings.sources), options.dataset)
        output.write_split_manifest(run.split_videos(videos, settings), splits, not options.overwrite)
        run.write_json(told, os.path.join(settings.output_dir, "summary.json"))
        release(spark)
    logging.info("%s", json.dumps(told, sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
