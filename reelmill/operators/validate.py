"""Integrity rules of a sequence manifest as one table (rule, violations), from one pass of conditional aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.operators.summary import counts_by

REQUIRED = ("sequence_id", "dataset_id", "video_id", "group_id", "label", "split", "frame_paths", "seq_len", "pipeline_fingerprint")
SPLITS = ("train", "val", "test")


def bad_paths(paths: str, length: str):
    """True for a cell that is no JSON list of texts, has another length, or names an absolute or climbing path."""
    parsed = F.from_json(F.col(paths), "array<string>")
    climbing = F.exists(parsed, lambda p: p.isNull() | p.startswith("/") | p.contains("\\") | F.array_contains(F.split(p, "/"), ".."))
    return F.coalesce(~F.col(paths).rlike(r"^\s*\["), F.lit(True)) | parsed.isNull() | F.coalesce(F.size(parsed) != F.col(length), F.lit(True)) | F.coalesce(climbing, F.lit(False))


def violations(manifest: DataFrame, listing: DataFrame | None = None, require_all_splits: bool = True, listed_path: str = "path") -> DataFrame:
    """(rule, violations) for every rule, zero where it holds.

    Null labels and splits count as violations; a row with a bad path takes no part in the search for missing files,
    which counts distinct files.
    """
    missing = [c for c in REQUIRED if c not in manifest.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    bad = bad_paths("frame_paths", "seq_len")
    one = lambda c: F.sum(c.cast("long"))
    print_ = F.coalesce(F.col("pipeline_fingerprint"), F.lit("nan"))
    flat = manifest.agg(
        F.count("*").alias("_rows"),
        (F.count("*") - F.countDistinct("sequence_id")).alias("duplicate_sequence"),
        F.greatest(F.countDistinct(print_) - 1, F.lit(0)).alias("several_fingerprints"),
        one(~F.coalesce(F.col("label").isin(0, 1), F.lit(False))).alias("bad_label"),
        one(~F.coalesce(F.col("split").isin(*SPLITS), F.lit(False))).alias("bad_split"),
        (F.lit(len(SPLITS)) - F.countDistinct(F.when(F.col("split").isin(*SPLITS), F.col("split")))).alias("missing_split"),
        (F.lit(2) - F.countDistinct(F.when((F.col("split") == "train") & F.col("label").isin(0, 1), F.col("label")))).alias("train_label"),
        one(bad).alias("bad_paths"),
    )
    names = ["duplicate_sequence", "several_fingerprints", "bad_label", "bad_split", *(["missing_split", "train_label"] if require_all_splits else []), "bad_paths"]
    found = flat.select(F.explode(F.array(F.struct(F.lit("empty").alias("rule"), (F.col("_rows") == 0).cast("long").alias("violations")), *(F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("violations")) for n in names))).alias("r")).select("r.*")
    leaks = manifest.where("dataset_id IS NOT NULL AND group_id IS NOT NULL").groupBy("dataset_id", "group_id").agg(F.countDistinct("split").alias("n")).where("n > 1")
    found = found.unionByName(leaks.agg(F.lit("leaking_group").alias("rule"), F.count("*").alias("violations")))
    if listing is not None:
        wanted = manifest.where(~bad).select(F.explode(F.from_json("frame_paths", "array<string>")).alias("_p")).distinct()
        gone = wanted.join(listing.select(F.col(listed_path).alias("_p")), "_p", "left_anti")
        found = found.unionByName(gone.agg(F.lit("missing_file").alias("rule"), F.count("*").alias("violations")))
    return found


def totals(manifest: DataFrame) -> DataFrame:
    """(what, value, n): sequences and videos of the whole manifest, rows of each dataset and of each split."""
    whole = manifest.agg(F.count("*").alias("s"), F.countDistinct("dataset_id", "video_id").alias("v"))
    whole = whole.select(F.explode(F.array(*(F.struct(F.lit(w).alias("what"), F.lit("").alias("value"), F.col(c).alias("n")) for w, c in (("sequences", "s"), ("videos", "v"))))).alias("r")).select("r.*")
    return whole.unionByName(counts_by(manifest, ["dataset_id", "split"]).select(F.col("dim").alias("what"), "value", "n"))


def require_valid(manifest: DataFrame, listing: DataFrame | None = None, require_all_splits: bool = True) -> dict:
    """Raises with every broken rule in one message; otherwise rows, videos, datasets and rows of each split."""
    broken = {r["rule"]: r["violations"] for r in violations(manifest, listing, require_all_splits).where("violations > 0").collect()}
    if broken:
        raise ValueError("manifest breaks rules: " + "; ".join(f"{k} ({v})" for k, v in sorted(broken.items())))
    told: dict = {}
    for r in totals(manifest).orderBy("what", "value").collect():
        told.setdefault(r["what"], {})[r["value"]] = r["n"]
    return {"sequences": told["sequences"][""], "videos": told["videos"][""], "datasets": list(told["dataset_id"]), "splits": told["split"]}
