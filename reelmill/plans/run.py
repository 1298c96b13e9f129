"""From videos to a manifest of sequences."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.operators import selection, sequences
from reelmill.operators.export import json_list
from reelmill.operators.identity import fixed9, sequence_id
from reelmill.operators.manifest import conformed, other_fingerprints, remaining, upsert
from reelmill.operators.splits import assign_split
from reelmill.operators.summary import summary
from reelmill.operators.vision import chosen_frames
from reelmill.plans.config import RunConfig
from reelmill.schemas import SEQUENCES
from reelmill.shared import stored
from reelmill.sources.manifests import discover

VERSION = "reelmill_1"


def split_videos(videos: DataFrame, config: RunConfig) -> DataFrame:
    """Every video with its split; given ones stay."""
    named = videos.withColumnRenamed("split", "_given")
    return assign_split(named, "dataset_id", "group_id", "split_locked", "_given", seed=config.seed, ratios=config.ratios).drop("_given")


VIDEO = ["dataset_id", "video_id"]


def gapless(frames: DataFrame, config: RunConfig) -> DataFrame:
    """Every bin of every video with its state and the frame that stands in it; frames has a row without one for a last bin without."""
    carried = ["frame_index", "quality", "motion", "ssim", "timestamp", "source"]
    chosen = frames.where("frame_index IS NOT NULL").select(*VIDEO, "bin", "frame_index", "quality", "motion", "ssim", "timestamp", F.col("bin").alias("source"))
    whole = selection.repair_gaps(chosen, VIDEO, "bin", 1 / config.model_fps, config.max_repairs, carried, "frame_index", frames.select(*VIDEO, "bin"))
    missing, valid = F.col("state") == "missing", F.col("state") == "valid"
    return whole.withColumns(
        {
            "quality": F.when(missing, 0.0).otherwise(F.col("quality")),
            "motion": F.when(valid, F.col("motion")).otherwise(0.0),
            "ssim": F.when(F.col("state") == "repair", 1.0).when(valid, F.col("ssim")),
            "timestamp": F.when(valid, F.col("timestamp")).otherwise(F.col("bin_start")),
        }
    )


def build_sequences(frames: DataFrame, config: RunConfig) -> DataFrame:
    """(dataset_id, video_id, start_bin, ..., window_score): the accepted windows, the best of each stratum."""
    whole = gapless(frames, config)
    windows = sequences.sliding_windows(whole, VIDEO, "bin", "state", "quality", "motion", "ssim", config.seq_len, config.window_hop, config.limits, {"timestamp": "time", "frame_index": "frame"})
    return sequences.stratified_top1(sequences.accepted(windows, config.limits), VIDEO, ["start_bin"], "window_score", config.max_sequences_per_video)


def sequence_rows(windows: DataFrame, videos: DataFrame, config: RunConfig) -> DataFrame:
    """The windows with their videos' columns, ids, and the names of their pictures."""
    suffix = "jpg" if config.output_format.lower() in ("jpg", "jpeg") else "png"
    settings = {"seq_len": config.seq_len, "model_fps": float(config.model_fps), "image_size": config.image_size, "pipeline_fingerprint": config.fingerprint()}
    rows = windows.join(videos, VIDEO).withColumns({k: F.lit(v) for k, v in settings.items()})
    parts = [*map(F.col, (*VIDEO, "start_frame", "end_frame", "seq_len")), F.lit(str(float(config.model_fps))), F.col("image_size")]
    rows = rows.withColumn("sequence_id", sequence_id(*parts, fixed9("start_time"), fixed9("end_time"), F.col("pipeline_fingerprint")))
    names = F.transform(F.sequence(F.lit(0), F.lit(config.seq_len - 1)), lambda k: F.concat(F.col("sequence_id"), F.lit("/"), F.format_string(f"frame_%02d.{suffix}", k)))
    more = {"frame_paths": json_list(names), "candidate_fps": F.lit(config.candidate_fps), "image_format": F.lit(suffix), "missing_face_ratio": F.col("missing_ratio"), "pipeline_version": F.lit(VERSION)}
    return rows.withColumns(more)


def manifest_rows(windows: DataFrame, videos: DataFrame, config: RunConfig) -> DataFrame:
    """Sequence rows in the manifest's columns."""
    return conformed(sequence_rows(windows, videos, config), SEQUENCES)


def write_json(payload: dict, path: str) -> None:
    """Written beside its place and moved there."""
    with open(f"{path}.tmp", "w") as f:
        json.dump(payload, f, indent=2, sort_keys=True)
    os.replace(f"{path}.tmp", path)


def preprocess(
    spark: SparkSession, config: RunConfig, decode, detector, existing: DataFrame | None = None, wanted: list[str] | None = None, max_videos: int | None = None, validate_only: bool = False, resume: bool = True, only=None, pictures=None, workers: int | None = None
) -> tuple[DataFrame, dict]:
    """(manifest, summary). The fingerprint of an existing manifest is compared before anything is made.

    Videos that already have sequences under this fingerprint are left out if resume; videos that fail are listed in
    the summary, or raise if the config says so. `only` narrows what is left to do. `pictures` is called with the new
    rows and the frames before the manifest names them, to write what the rows refer to.
    """
    config.check()
    if max_videos is not None and max_videos <= 0:
        raise ValueError("max_videos must be positive")
    if workers is not None and workers <= 0:
        raise ValueError("workers must be positive")
    print_ = config.fingerprint()
    if existing is not None and (others := [r[0] for r in other_fingerprints(existing, print_).limit(3).collect()]):
        raise ValueError(f"the manifest was made with other settings: {others}")
    videos, rejected = discover(spark, list(config.sources), wanted)
    videos = stored(split_videos(videos, config), "videos")
    n, bad = videos.count(), rejected.count()
    if max_videos is not None:
        videos = videos.orderBy("dataset_id", "video_id").limit(max_videos)
    if not n:
        raise ValueError("no videos")
    if validate_only:
        return conformed(videos, SEQUENCES), summary(videos, n + bad, bad, [], print_)
    todo = remaining(videos, existing.where(F.col("pipeline_fingerprint") == print_), ["dataset_id", "video_id"]) if existing is not None and resume else videos
    todo = only(todo) if only else todo
    frames = stored(chosen_frames(todo, decode, detector, config.video_settings(), workers), "frames")
    failed = failures(frames)
    if failed and config.fail_on_video_error:
        raise RuntimeError(f"{len(failed)} videos failed: {failed[:3]}")
    frames = frames.where("error IS NULL")
    made = stored(sequence_rows(build_sequences(frames, config), todo, config), "sequences")
    if pictures:
        pictures(made, frames)
    made = conformed(made, SEQUENCES)
    sort = ["split", "label", "dataset_id", "video_id", "start_time"]
    manifest = stored(upsert(existing, made, ["sequence_id"], ["start_time"], sort) if existing is not None else made.orderBy(*sort), "manifest")
    return manifest, summary(manifest, n + bad, bad, failed, print_)


def failures(frames: DataFrame) -> list[dict]:
    """Every video that failed, by its id; the summary names them all."""
    return [r.asDict() for r in frames.where("error IS NOT NULL").select(*VIDEO, "error").orderBy(*VIDEO).collect()]


def preprocess_in_steps(spark: SparkSession, config: RunConfig, decode, detector, path: str, steps: int, **how) -> tuple[DataFrame, dict]:
    """preprocess over `steps` parts of the videos (dealt by a hash of their ids), each part saved before the next begins.

    The manifest at path (Parquet, a folder for each step) always holds every finished part, so a run that is
    stopped resumes after the last one.
    """
    if steps <= 0:
        raise ValueError("steps must be positive")
    told: dict = {}
    failed: list[dict] = []
    for k in range(steps):
        existing = saved_manifest(spark, path)
        part = lambda v, k=k: v.where(F.pmod(F.xxhash64("dataset_id", "video_id"), F.lit(steps)) == k)
        made, told = preprocess(spark, config, decode, detector, existing=existing, only=part, **how)
        failed += told["failed_videos"]
        fresh = made.join(existing.select("sequence_id"), "sequence_id", "left_anti") if existing is not None else made
        fresh.write.parquet(f"{path}/step={uuid.uuid4().hex}")
    manifest = saved_manifest(spark, path)
    return manifest, told | {"failed_videos": failed}


def saved_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """What earlier steps have saved; None if that is nothing."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [str(s.getPath().getParent()) for s in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/step=*/_SUCCESS")) or []]
    return stored(conformed(spark.read.schema(SEQUENCES).parquet(*sorted(done)), SEQUENCES), "manifest") if done else None
