"""Leakage-safe splits: every row of a group goes to one split, by a seeded hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.operators.ranking import hash_rank

SPLITS = ("train", "val", "test")
RATIOS = (0.70, 0.15, 0.15)


def apportioned(n: Column, ratios: tuple[float, ...] = RATIOS) -> list[Column]:
    """Largest remainders in DOUBLE: whole parts first, what is left to the largest fractions, ties to the lower index."""
    whole = [F.floor(n * F.lit(float(r))).cast("long") for r in ratios]
    rest = [n * F.lit(float(r)) - w for r, w in zip(ratios, whole, strict=True)]
    left = n - sum(whole[1:], whole[0])
    out = []
    for i, w in enumerate(whole):
        ahead = F.lit(0)
        for j in range(len(ratios)):
            if j != i:
                ahead = ahead + ((rest[j] >= rest[i]) if j < i else (rest[j] > rest[i])).cast("int")
        out.append(w + (ahead < left).cast("long"))
    return out


def balanced_hash_split(groups: DataFrame, dataset: str, group: str, seed: int = 42, ratios: tuple[float, ...] = RATIOS, out: str = "split") -> DataFrame:
    """Distinct (dataset, group) with its split: per dataset, groups in hash order are cut at the apportioned counts."""
    keys = groups.select(dataset, group).distinct()
    keys = keys.withColumn("_h", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(dataset).cast("string"), F.col(group).cast("string")), 256))
    ranked = hash_rank(keys, [dataset], "_h", [group], "_rank")
    sizes = keys.groupBy(dataset).agg(F.count("*").alias("_n"))
    ranked = ranked.join(sizes, dataset)
    train, val, _ = apportioned(F.col("_n"), ratios)
    split = F.when(F.col("_rank") <= train, SPLITS[0]).when(F.col("_rank") <= train + val, SPLITS[1]).otherwise(SPLITS[2])
    return ranked.select(dataset, group, split.alias(out))


def assign_split(rows: DataFrame, dataset: str, group: str, locked: str | None = None, given: str | None = None, out: str = "split", **how) -> DataFrame:
    """rows with a split: the given one where `locked`, else that of the row's group."""
    free = rows.where(~F.col(locked)) if locked else rows
    made = balanced_hash_split(free, dataset, group, out="_made", **how)
    joined = rows.join(made, [dataset, group], "left")
    return joined.withColumn(out, F.when(F.col(locked), F.col(given)).otherwise(F.col("_made")) if locked else F.col("_made")).drop("_made")


def hash_fraction(text: Column) -> Column:
    """The first 64 bits of sha256 as a share of 2**64."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def uniform_hash_split(group: Column, seed: int = 42, ratios: tuple[float, ...] = RATIOS) -> Column:
    """The provisional split of one group, by itself."""
    x = hash_fraction(F.concat_ws(":", F.lit(str(seed)), group.cast("string")))
    return F.when(x < ratios[0], SPLITS[0]).when(x < ratios[0] + ratios[1], SPLITS[1]).otherwise(SPLITS[2])


def split_counts(rows: DataFrame, dataset: str, group: str, split: str = "split") -> DataFrame:
    """Rows and distinct groups of each split."""
    return rows.groupBy(split).agg(F.count("*").alias("n_rows"), F.countDistinct(dataset, group).alias("n_groups"))


def leaking_groups(rows: DataFrame, keys: list[str], split: str = "split") -> DataFrame:
    """Groups that several splits hold; null keys and null splits don't count."""
    known = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return known.groupBy(*keys).agg(F.countDistinct(split).alias("n_splits")).where("n_splits > 1")


def mixed_locks(rows: DataFrame, dataset: str, locked: str) -> DataFrame:
    """Datasets in which some splits are given and others made."""
    return rows.groupBy(dataset).agg(F.countDistinct(locked).alias("n_states")).where("n_states > 1").select(dataset)


def repeated_videos(rows: DataFrame, dataset: str = "dataset_id", video: str = "video_id") -> DataFrame:
    """(dataset, video, n) of every video that has several rows."""
    return rows.groupBy(dataset, video).agg(F.count("*").alias("n")).where("n > 1")


def check_splits(rows: DataFrame, dataset: str = "dataset_id", group: str = "group_id", video: str = "video_id", split: str = "split", locked: str = "split_locked") -> None:
    """Raises on the first rule that rows break: mixed locks, a given group in two splits, a repeated video."""
    rules = [
        ("datasets mix given and made splits", mixed_locks(rows, dataset, locked)),
        ("groups in several splits", leaking_groups(rows.where(F.col(locked)), [dataset, group], split)),
        ("repeated videos", repeated_videos(rows, dataset, video)),
    ]
    for what, found in rules:
        if some := found.limit(5).collect():
            raise ValueError(f"{what}: {[tuple(r) for r in some]}")
