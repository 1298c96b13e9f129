"""Export planning: closest groups, budgets in hash order, shards and their archives."""

from __future__ import annotations

import json
import os
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.operators.identity import file_sha256
from reelmill.operators.ranking import seeded_sum

SPLIT_ORDER = ("train", "val", "test")


def split_rank(split: Column) -> Column:
    """train, val, test, then anything else."""
    rank = F.when(split == SPLIT_ORDER[0], 0)
    for k, name in enumerate(SPLIT_ORDER[1:], 1):
        rank = rank.when(split == name, k)
    return rank.otherwise(99)


def closest_group(groups: DataFrame, fake: str, real: str, fake_target: int, real_target: int, order: str) -> DataFrame:
    """The one group whose fake count, then real count, is nearest to its target; ties in hash order."""
    return groups.orderBy(F.abs(F.col(fake) - fake_target), F.abs(F.col(real) - real_target), order).limit(1)


def budget_prefix(groups: DataFrame, order: str, amount: str, target: float, base: float = 0.0) -> DataFrame:
    """Groups in the order of a hex hash, up to and with the one whose amount reaches the target."""
    before = seeded_sum(groups, order, amount, "_before")
    return before.where(F.lit(base) + F.coalesce("_before", F.lit(0)) < target).drop("_before")


def half_even_target(count: Column, ratio: float) -> Column:
    return F.bround(count * F.lit(float(ratio))).cast("long")


def train_val_assign(groups: DataFrame, fake: str, real: str, key: str, ratio: float = 0.15, seed: int = 42) -> DataFrame:
    """Adds split to groups: val gets the group with fakes nearest to the target, then real-only groups up to theirs."""
    hashed = groups.withColumn("_h", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256))
    total = hashed.agg(half_even_target(F.sum(fake), ratio).alias("f"), half_even_target(F.sum(real), ratio).alias("r")).first()
    first = closest_group(hashed.where(F.col(fake) > 0), fake, real, total["f"] or 0, total["r"] or 0, "_h").collect()
    base = float(first[0][real]) if first else 0.0
    more = budget_prefix(hashed.where(F.col(fake) == 0), "_h", real, float(total["r"] or 0), base).select(key)
    val = more.unionByName(hashed.where(F.col(key) == F.lit(first[0][key])).select(key)) if first else more
    marked = groups.join(val.withColumn("_val", F.lit(True)), key, "left")
    return marked.withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).drop("_val")


def next_fit_shards(groups: DataFrame, split: str, dataset: str, group: str, size: str, target: int) -> DataFrame:
    """Adds part: groups in the order of (split, dataset, group) fill a shard until the next would overflow it.

    Shards never cross splits, and a group over the target is alone. Where a shard ends depends on all groups before
    it, so one task walks through the groups (a row each, sorted with spilling); it holds a batch of them and two numbers.
    """
    kinds = {f.name: f.dataType.simpleString() for f in groups.select(split, dataset, group, size).schema} | {size: "bigint"}
    rows = groups.select(split, dataset, group, F.col(size).cast("long").alias(size), split_rank(F.col(split)).alias("_rank"))
    ordered = rows.coalesce(1).sortWithinPartitions("_rank", split, dataset, group)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, used, last = 0, 0, None
        for batch in batches:
            out = []
            for name, n in zip(batch[split], batch[size], strict=True):
                if last is not None and (name != last or used and used + n > target):
                    part, used = part + 1, 0
                used, last = used + n, name
                out.append(part)
            yield batch.drop(columns="_rank").assign(part=out)

    return ordered.mapInPandas(fill, ", ".join(f"{k} {v}" for k, v in kinds.items()) + ", part long")


def shard_table(shards: DataFrame) -> DataFrame:
    """(part, split, groups, bytes): a row for each shard of a plan."""
    return shards.groupBy("part", "split").agg(F.count("*").alias("groups"), F.sum("bytes").alias("bytes"))


def shard_rows(manifest: DataFrame, plan: DataFrame, part: int, keys: list[str]) -> DataFrame:
    """The rows of a manifest that belong to one shard of a plan."""
    return manifest.join(plan.where(F.col("part") == part).select(*keys), keys, "left_semi")


def rewrite_paths(paths: str, suffix: str = ".jpg") -> Column:
    """A JSON list of paths with another suffix, written as json_list() does."""
    new = F.transform(F.from_json(F.col(paths), "array<string>"), lambda p: F.concat(F.regexp_replace(p, r"\.[^./]*$", ""), F.lit(suffix)))
    return json_list(new)


def json_text(name: Column) -> Column:
    """A JSON string in ASCII: quotes, backslashes and control characters escaped, others beyond ASCII as \\uXXXX (two for a rare one)."""
    quoted = F.to_json(F.array(name))
    quoted = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    units = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(....)", r"\\u$1")
    plain = F.array_join(F.transform(F.split(quoted, ""), lambda c: F.when(c.rlike(r"^[\x00-\x7e]*$"), c).otherwise(units(c))), "")
    return F.when(quoted.rlike(r"[^\x00-\x7e]"), plain).otherwise(quoted)


def json_list(names: Column) -> Column:
    """A JSON list of strings with a blank after each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(names, json_text), ", "), F.lit("]"))


def archive_name(profile: Column, part: Column) -> Column:
    return F.format_string("%s_part%03d.zip", profile, part.cast("int"))


def manifest_files(rows: DataFrame, plan: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(part, name, content): what goes into each shard's archive besides pictures, its rows as a CSV and its numbers as JSON.

    plan has (keys, part, split, bytes), a row for each group. A shard's rows are gathered in one task, as its archive is.
    """
    placed = rows.join(plan.select(*keys, "part"), keys)
    parts = plan.agg(F.max("part") + 1).first()[0] or 0
    told = plan.groupBy("part").agg(F.min("split").alias("split"), F.count("*").alias("groups"), F.sum("bytes").alias("bytes"))

    def table(part: pd.DataFrame) -> pd.DataFrame:
        k, head = int(part["part"].iloc[0]), part.iloc[0]
        own = part[part["_row"]].sort_values(columns, kind="stable")
        info = {"part": k + 1, "total_parts": int(parts), "split": head["_split"], "group_count": int(head["_groups"]), "sequence_count": len(own), "source_bytes": int(head["_bytes"])}
        files = {"manifests/sequence_manifest.csv": own[columns].to_csv(index=False), "manifests/shard_info.json": json.dumps(info, indent=2)}
        return pd.DataFrame({"part": k, "name": list(files), "content": [x.encode() for x in files.values()]})

    marked = told.select("part", F.col("split").alias("_split"), F.col("groups").alias("_groups"), F.col("bytes").alias("_bytes"))
    wide = placed.select("part", F.lit(True).alias("_row"), *columns).join(marked, "part", "right").withColumn("_row", F.coalesce("_row", F.lit(False)))
    return wide.groupBy("part").applyInPandas(table, "part long, name string, content binary")


def check_arguments(archive: str, sequences_per_video: int = 1, quality: int = 95, workers: int = 1) -> None:
    """Raises with every flaw of an export's arguments in one message, and if the archive or its unfinished form is there."""
    flaws = [f"{n} must be positive" for n, v in (("workers", workers), ("sequences_per_video", sequences_per_video)) if v < 1]
    flaws += ["quality must be 1 to 100"] * (not 1 <= quality <= 100)
    if flaws:
        raise ValueError("; ".join(flaws))
    for path in (archive, f"{archive}.partial"):
        if os.path.exists(path):
            raise FileExistsError(path)


def write_archives(files: DataFrame, folder: str, part: str = "part", name: str = "name", content: str = "content") -> DataFrame:
    """One stored ZIP for each part, written in its task to a folder that all executors share: (part, path, files, sha256).

    An archive is written beside its place, tested and then moved there; one that is already there is an error. The
    rows of manifest_files() are files like any other.
    """

    def write(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        try:
            for batch in rows:
                for k, group in batch.groupby(part, sort=True):
                    if k not in held:
                        path = os.path.join(folder, f"part{int(k):03d}.zip")
                        if os.path.exists(path):
                            raise FileExistsError(path)
                        held[k] = (path, zipfile.ZipFile(f"{path}.partial", "w", zipfile.ZIP_STORED, allowZip64=True), [])
                    for file, data in zip(group[name], group[content], strict=True):
                        held[k][1].writestr(file, bytes(data))
                        held[k][2].append(file)
        finally:
            for _, z, _ in held.values():
                z.close()
        done = []
        for k, (path, _, names) in held.items():
            with zipfile.ZipFile(f"{path}.partial") as z:
                if bad := z.testzip():
                    raise OSError(f"{path}: {bad} is damaged")
            os.replace(f"{path}.partial", path)
            digest = file_sha256(path)
            with open(f"{path}.sha256", "w") as f:
                f.write(f"{digest}  {os.path.basename(path)}\n")
            with open(f"{path}.json", "w") as f:
                json.dump({"part": int(k), "files": len(names), "sha256": digest}, f, indent=2)
            done.append((int(k), path, len(names), digest))
        yield pd.DataFrame(done, columns=["part", "path", "files", "sha256"])

    return files.repartition(part).sortWithinPartitions(part, name).mapInPandas(write, "part long, path string, files long, sha256 string")
