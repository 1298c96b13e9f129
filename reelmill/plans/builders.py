"""Manifests of whole collections: twelve columns, a split for every video, no identity in two splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.paths import stem, tokens
from reelmill.operators import export, graph
from reelmill.shared import stored
from reelmill.sources.lists import canonical_manifest, mark_test

COLUMNS = ("path", "label", "group_id", "split", "video_id", "class_name", "compression", "gen_method", "resolution", "media_type", "background_type", "video_name")


def projected(rows: DataFrame, **given) -> DataFrame:
    """The twelve columns; of those that rows lack the given texts, or empty ones."""
    have = set(rows.columns)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit(given.get(c, ""))
    return rows.select(*(F.col(c).cast("int").alias(c) if c == "label" else text(c).alias(c) for c in COLUMNS))


def identity_manifest(files: DataFrame, test: DataFrame, ratio: float = 0.15, seed: int = 42) -> DataFrame:
    """Manifest of files (path, folder, label, class_name, gen_method) whose names hold the ids of who is seen in them.

    Listed test videos stay in the test split; all others that share an identity, through any chain of videos, form a
    group and go to train or val together. Sorted by split, label and path.
    """
    rows = mark_test(files, test).withColumns({"split": F.when(F.col("is_test"), "test").otherwise(""), "tokens": tokens(F.col("path")), "video_name": stem(F.col("path"))})
    rows = stored(rows, "files")
    nodes, edges = graph.identity_edges(rows, "tokens", "label", "split")
    members, names = graph.component_tables(nodes, edges)
    rows = stored(graph.group_ids(rows, members, "tokens", "path", "split", names), "grouped")
    free = rows.where("split = ''").groupBy("group_id").agg(F.sum((F.col("label") == 1).cast("long")).alias("fake"), F.sum((F.col("label") == 0).cast("long")).alias("real"))
    made = export.train_val_assign(free, "fake", "real", "group_id", ratio, seed).select("group_id", F.col("split").alias("_made"))
    rows = rows.join(made, "group_id", "left").withColumn("split", F.when(F.col("split") == "test", "test").otherwise(F.col("_made")))
    rows = rows.withColumns({"video_id": F.col("path"), "background_type": F.col("folder")})
    return projected(rows, media_type="mp4").orderBy("split", "label", "path")


def paired_manifest(meta: DataFrame, splits: DataFrame, methods: tuple[str, ...], original: str = "original", compression: str = "c23", expected_rows: int | None = None, files: DataFrame | None = None) -> DataFrame:
    """Manifest from metadata (File Path, Width, Height) and the canonical split of each id; the first id names the group.

    Raises if files are given and lack a path. Sorted by split, label, method and video.
    """
    rows = canonical_manifest(meta, splits, methods, expected_rows)
    if files is not None and (some := rows.join(files.select("path"), "path", "left_anti").limit(5).collect()):
        raise FileNotFoundError(f"missing videos: {[r['path'] for r in some]}")
    label = F.when(F.col("gen_method") == original, 0).otherwise(1)
    rows = rows.withColumns({"label": label, "class_name": F.when(label == 0, "real").otherwise("fake"), "group_id": F.get("ids", F.lit(0)), "video_id": F.col("path"), "video_name": stem(F.col("path"))})
    return projected(rows, compression=compression, media_type="mp4").orderBy("split", "label", "gen_method", "video_id")
