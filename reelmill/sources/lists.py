"""Official test lists, canonical split files and their metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.functions.paths import stem


def test_list_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """(label, path, error) of lines with two columns between white space; blank ones don't count."""
    trimmed = F.regexp_replace(value, r"^\s+|\s+$", "")
    parts = lines.where(trimmed != "").select(F.split(trimmed, r"\s+").alias("p"))
    rows = parts.select(F.size("p").alias("n"), F.expr("try_cast(p[0] AS int)").alias("label"), F.get("p", F.lit(1)).alias("path"))
    malformed = (F.col("n") != 2) | F.coalesce(~F.col("label").isin(0, 1), F.lit(True))
    again = rows.groupBy("path").agg(F.count("*").alias("_times"))
    return rows.join(again, "path", "left").select("label", "path", F.when(malformed, "malformed").when(F.col("_times") > 1, "repeated").alias("error"))


def absent(wanted: DataFrame, there: DataFrame, path: str = "path") -> DataFrame:
    """Wanted paths that are not there."""
    return wanted.select(path).distinct().join(there.select(path), path, "left_anti")


def read_test_list(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """(label, path) of a text with two columns between white space. Blank lines don't count; any other flaw raises."""
    rows = test_list_rows(spark.read.text(path))
    for what, error in (("malformed lines", "malformed"), ("repeated paths", "repeated")):
        if some := rows.where(F.col("error") == error).limit(5).collect():
            raise ValueError(f"{what}: {[tuple(r)[:2] for r in some]}")
    rows = rows.select("label", "path")
    if files is not None and (some := absent(rows, files).limit(5).collect()):
        raise ValueError(f"missing files: {[r['path'] for r in some]}")
    return rows


def marked(videos: DataFrame, test: DataFrame, path: str = "path") -> DataFrame:
    """Adds is_test."""
    return videos.join(test.select(path, F.lit(True).alias("is_test")), path, "left").withColumn("is_test", F.coalesce("is_test", F.lit(False)))


def mark_test(videos: DataFrame, test: DataFrame, path: str = "path") -> DataFrame:
    """marked(); raises if the list names what videos lack."""
    if some := absent(test, videos, path).limit(5).collect():
        raise ValueError(f"listed but absent: {[r[path] for r in some]}")
    return marked(videos, test, path)


def ids_of_pairs(cells: DataFrame, value: str, split: str) -> DataFrame:
    """(id, split) of cells that hold JSON lists of id pairs."""
    pairs = cells.select(F.col(split).alias("split"), F.explode(F.from_json(value, "array<array<string>>")).alias("pair"))
    return pairs.select(F.explode("pair").alias("id"), "split").distinct()


def ids_in_several(ids: DataFrame) -> DataFrame:
    return ids.groupBy("id").agg(F.countDistinct("split").alias("n")).where("n > 1")


def read_canonical_splits(spark: SparkSession, files: dict[str, str], expected_ids: int | None = None) -> DataFrame:
    """(id, split) of JSON files that hold lists of id pairs, one file for each split; an id in two splits raises."""
    found = None
    for split, path in files.items():
        ids = ids_of_pairs(spark.read.option("wholetext", True).text(path).withColumn("split", F.lit(split)), "value", "split")
        found = ids if found is None else found.unionByName(ids)
    if some := ids_in_several(found).limit(5).collect():
        raise ValueError(f"ids in several splits: {[r['id'] for r in some]}")
    if expected_ids is not None and (n := found.count()) != expected_ids:
        raise ValueError(f"{n} ids, not {expected_ids}")
    return found


def one_split(rows: DataFrame, key: str, ids: str, splits: DataFrame) -> DataFrame:
    """(key, split, error) of rows with a list of ids: all have to be known, and in one split."""
    wide = rows.select(key, F.explode_outer(ids).alias("id")).join(splits, "id", "left")
    met = wide.groupBy(key).agg(F.count("*").alias("n"), F.count("split").alias("known"), F.countDistinct("split").alias("kinds"), F.min("split").alias("split"))
    error = F.when(F.col("known") < F.col("n"), "unknown id").when(F.col("kinds") > 1, "crosses splits")
    return met.select(key, F.when(error.isNull(), F.col("split")).alias("split"), error.alias("error"))


def metadata_rows(meta: DataFrame, methods: tuple[str, ...]) -> DataFrame:
    """(path, gen_method, resolution, ids) of metadata (File Path, Width, Height): the method is the first part, the ids are the stem's parts."""
    path = F.col("`File Path`")
    rows = meta.select(path.alias("path"), F.lower(F.get(F.split(path, "/"), F.lit(0))).alias("gen_method"), F.concat_ws("x", F.col("Width").cast("int"), F.col("Height").cast("int")).alias("resolution"))
    return rows.where(F.col("gen_method").isin(*methods)).withColumn("ids", F.split(stem(F.col("path")), "_"))


def canonical_manifest(meta: DataFrame, splits: DataFrame, methods: tuple[str, ...], expected_rows: int | None = None) -> DataFrame:
    """metadata_rows() with their split; raises on an unknown id, on ids in two splits and on a repeated path."""
    rows = metadata_rows(meta, methods)
    found = rows.join(one_split(rows, "path", "ids", splits), "path")
    if some := found.where("error IS NOT NULL").limit(5).collect():
        raise ValueError(f"{[(r['path'], r['error']) for r in some]}")
    if some := rows.groupBy("path").count().where("count > 1").limit(5).collect():
        raise ValueError(f"repeated paths: {[r['path'] for r in some]}")
    if expected_rows is not None and (n := found.count()) != expected_rows:
        raise ValueError(f"{n} rows, not {expected_rows}")
    return found.select("path", "gen_method", "resolution", "ids", "split").orderBy("split", "gen_method", "path")


def training_rows(manifest: DataFrame, split: str, root: str) -> DataFrame:
    """(paths, label) of one split; raises if there are none or their lengths differ."""
    paths = F.transform(F.from_json("frame_paths", "array<string>"), lambda p: F.concat(F.lit(root.rstrip("/") + "/"), p))
    rows = manifest.where(F.col("split") == split).select(paths.alias("paths"), F.col("label").cast("float").alias("label"))
    kinds = [r[0] for r in rows.select(F.size("paths")).distinct().limit(3).collect()]
    if len(kinds) != 1:
        raise ValueError(f"{split}: sequence lengths {kinds}" if kinds else f"{split}: no rows")
    return rows
