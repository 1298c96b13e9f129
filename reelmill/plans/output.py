"""What a run leaves behind: pictures, manifests, plans, catalog entries, and batches for training."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.operators.export import shard_table, write_archives
from reelmill.operators.manifest import conformed, upsert
from reelmill.operators.validate import require_valid
from reelmill.operators.vision import decode_png, resize
from reelmill.plans.config import RunConfig
from reelmill.plans.run import VIDEO, gapless, write_json
from reelmill.schemas import SPLIT_ROWS
from reelmill.shared import stored
from reelmill.sources.manifests import read_csv


def reset_sequences(config: RunConfig) -> None:
    """Clears the sequence folder and nothing else; raises if that folder isn't strictly inside the output folder."""
    if not config.inside():
        raise ValueError("sequence_dir must be inside output_dir")
    folder = os.path.join(config.output_dir, config.sequence_dir)
    shutil.rmtree(folder, ignore_errors=True)
    os.makedirs(folder)


def clear(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store holds it."""
    files, place = _files(spark, path)
    files.delete(place, True)


def _files(spark: SparkSession, path: str):
    """The store that holds a path, and the path in it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def write_csv(rows: DataFrame, path: str) -> None:
    """One CSV with a header, written beside its place and moved over what is there in one step; for manifests, which are metadata."""
    spark = rows.sparkSession
    jvm, temporary = spark.sparkContext._jvm, f"{path}.tmp"
    rows.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(temporary)
    files, place = _files(spark, path)
    (part,) = [s.getPath() for s in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{temporary}/part-*"))]
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    place = files.makeQualified(place)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(part, place, over)
    files.delete(jvm.org.apache.hadoop.fs.Path(temporary), True)


def write_split_manifest(videos: DataFrame, path: str, keep: bool = True) -> None:
    """Every video's split, added to what an earlier run has written there (the last row of a video stays)."""
    rows = conformed(videos, SPLIT_ROWS)
    if keep and exists(videos.sparkSession, path):
        rows = upsert(conformed(read_csv(videos.sparkSession, path), SPLIT_ROWS), rows, VIDEO, ["split"])
    write_csv(stored(rows, "splits").orderBy(*VIDEO), path)


def sequence_images(rows: DataFrame, frames: DataFrame, config: RunConfig) -> DataFrame:
    """(sequence_id, name, image) of every frame of every sequence row; a repaired frame is the last valid one again."""
    whole = gapless(frames, config).select(*VIDEO, "bin", "source")
    wanted = rows.select("sequence_id", *VIDEO, F.posexplode(F.from_json("frame_paths", "array<string>")).alias("_k", "name"), "start_bin")
    wanted = wanted.withColumn("bin", (F.col("start_bin") + F.col("_k")).cast("long")).join(whole, [*VIDEO, "bin"], "left")
    return wanted.drop("bin").join(frames.select(*VIDEO, F.col("bin").alias("source"), "image"), [*VIDEO, "source"], "left").select("sequence_id", "name", "image")


def write_images(images: DataFrame, folder: str, encode: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Writes each image under its name in a folder that all executors share: (sequence_id, files). No image is an error.

    encode turns stored bytes into those of another format.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, image in zip(batch["name"], batch["image"], strict=True):
                if image is None:
                    raise ValueError(f"no image for {name}")
                path = os.path.join(folder, name)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(f"{path}.tmp", "wb") as f:
                    f.write(encode(bytes(image)) if encode else bytes(image))
                os.replace(f"{path}.tmp", path)
            yield batch.groupby("sequence_id", as_index=False).agg(files=("name", "size"))

    return images.mapInPandas(write, "sequence_id string, files long").groupBy("sequence_id").agg(F.sum("files").alias("files"))


def write_parts(shards: DataFrame, files: DataFrame, folder: str, keys: list[str], least_free: int = 11 << 30) -> Iterator[dict]:
    """One archive after the other, for folders that hold few of them at a time; stops with an error when less than least_free is left."""
    for r in shards.select("part").distinct().orderBy("part").collect():  # a row for each shard
        if (free := shutil.disk_usage(folder).free) < least_free:
            raise OSError(f"{free} bytes are free in {folder}, under {least_free}")
        own = files.join(shards.where(F.col("part") == r["part"]).select(*keys, "part"), keys)
        yield write_archives(own, folder).first().asDict()


def plan_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A saved shard plan, or a new one that is saved."""
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def shard_plan(shards: DataFrame, target: int) -> dict:
    """The plan as a document: its shards, and their groups and bytes."""
    rows = [r.asDict() for r in shard_table(shards).orderBy("part").collect()]
    return {"target_bytes": target, "shards": rows, "total_bytes": sum(r["bytes"] for r in rows), "groups": sum(r["groups"] for r in rows)}


def catalog_entry(manifest: DataFrame, listing: DataFrame, path: str, title: str, identifier: str, licence: str = "other") -> dict:
    """Catalog metadata, written only after the whole manifest has passed its rules."""
    told = require_valid(manifest, listing)
    entry = {"title": title, "id": identifier, "licenses": [{"name": licence}]}
    write_json(entry, path)
    return entry | told


def release_flaws(summary_path: str, expected_videos: int, pid: int | None = None) -> list[str]:
    """Why a run isn't fit for release; empty if it is. pid is the run's process, which has to have ended."""
    if pid is not None:
        try:
            os.kill(pid, 0)
            return ["the run has not ended"]
        except ProcessLookupError:
            pass
    if not os.path.exists(summary_path):
        return ["there is no summary"]
    with open(summary_path) as f:
        told = json.load(f)
    flaws = [f"{told.get('valid_videos')} videos, not {expected_videos}"] if told.get("valid_videos") != expected_videos else []
    return flaws + ([f"{len(told['failed_videos'])} videos failed"] if told.get("failed_videos") else [])


def read_picture(path: str) -> np.ndarray:
    """The pixels of a PNG file."""
    with open(path, "rb") as f:
        return decode_png(f.read())


def normalised_pictures(size: int, load: Callable[[str], np.ndarray] = read_picture) -> Callable[[list[str]], np.ndarray]:
    """A loader for training_batches: each picture read, resized and as numbers from 0 to 255, which is what the network takes."""
    return lambda paths: np.stack([resize(np.asarray(load(p))[..., :3], size).astype(np.float32) for p in paths])


def training_batches(rows: DataFrame, size: int, load: Callable[[list[str]], object], seed: int = 42, epoch: int = 0, shuffle: bool = True) -> Iterator[tuple[list, list]]:
    """Batches of loaded sequences and labels, in another seeded order each epoch; partitions are fetched one at a time."""
    ordered = rows.orderBy(F.xxhash64(F.lit(seed), F.lit(epoch), "paths"), "paths") if shuffle else rows
    held: tuple[list, list] = ([], [])
    for r in ordered.toLocalIterator(prefetchPartitions=True):
        held[0].append(load(list(r["paths"])))
        held[1].append(r["label"])
        if len(held[0]) == size:
            yield held
            held = ([], [])
    if held[0]:
        yield held
