"""One query for each operator family on the driver's tables, and the SQL that it is held against."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.functions import paths
from reelmill.operators import export, graph, identity, manifest, sampling, selection, sequences, splits, summary, validate, vision
from reelmill.plans import run
from reelmill.schemas import SPLIT_ROWS
from reelmill.sources import listing, lists, manifests

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
HALF_DAY, DAY = 43_200.0, 86_400.0


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- splits ---------------------------------------------------------------------------------------------------------

_SPLIT = """
    g AS (SELECT DISTINCT o_orderpriority AS ds, o_custkey AS grp FROM orders),
    r AS (SELECT ds, grp, row_number() OVER (PARTITION BY ds ORDER BY sha256('42:' || ds || ':' || grp), grp) AS k, count(*) OVER (PARTITION BY ds) AS n FROM g),
    w AS (SELECT *, floor(n * 0.70::DOUBLE) AS a, floor(n * 0.15::DOUBLE) AS b FROM r),
    f AS (SELECT *, n * 0.70::DOUBLE - a AS fa, n * 0.15::DOUBLE - b AS fb, n - a - b - b AS rest FROM w),
    c AS (SELECT *, a + (((fb > fa)::INT + (fb > fa)::INT) < rest)::INT AS train,
        b + (((fa >= fb)::INT + (fb > fb)::INT) < rest)::INT AS val FROM f),
    s AS (SELECT ds, grp, CASE WHEN k <= train THEN 'train' WHEN k <= train + val THEN 'val' ELSE 'test' END AS split FROM c)
"""


def _orders(spark, sf):
    return _table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("ds"), F.col("o_custkey").alias("grp"), "o_orderdate", "o_totalprice", "o_orderstatus")


@query(f"WITH {_SPLIT} SELECT ds, grp, split FROM s")
def split_balanced_hash(spark, sf):
    return splits.balanced_hash_split(_orders(spark, sf), "ds", "grp")


@query(f"WITH {_SPLIT} SELECT split, count(*) AS n_rows, count(DISTINCT (ds, grp)) AS n_groups FROM orders JOIN s ON o_orderpriority = ds AND o_custkey = grp GROUP BY split")
def split_counts(spark, sf):
    return splits.split_counts(splits.assign_split(_orders(spark, sf), "ds", "grp"), "ds", "grp")


@query("""
    WITH h AS (SELECT doc_id, source, ('0x' || substr(sha256('42:' || doc_id), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE AS x FROM documents)
    SELECT doc_id, CASE WHEN x < 0.7::DOUBLE THEN 'train' WHEN x < 0.7::DOUBLE + 0.15::DOUBLE THEN 'val' ELSE 'test' END AS split FROM h
""")
def split_hash_uniform(spark, sf):
    return _table(spark, sf, "documents").select("doc_id", splits.uniform_hash_split(F.col("doc_id")).alias("split"))


@query("""
    SELECT lang, source, count(DISTINCT CASE doc_id % 50 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END) AS n_splits
    FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY lang, source HAVING n_splits > 1
""")
def leakage_groups(spark, sf):
    split = F.when(F.col("doc_id") % 50 == 0, "test").when(F.col("doc_id") % 50 == 1, "val").otherwise("train")
    return splits.leaking_groups(_table(spark, sf, "documents").withColumn("split", split), ["lang", "source"])


@query("SELECT source FROM documents GROUP BY source HAVING count(DISTINCT doc_id % 60 < 20) > 1")
def mixed_lock_check(spark, sf):
    return splits.mixed_locks(_table(spark, sf, "documents").withColumn("locked", F.col("doc_id") % 60 < 20), "source", "locked")


# -- paths and manifests --------------------------------------------------------------------------------------------

_PATH = """CASE doc_id % 6
    WHEN 0 THEN 'raw/targets/540x960/' || source || '/Clip' || doc_id || '.mp4'
    WHEN 1 THEN 'clips/C23/DeepLiveCam/360x640/' || source || '/clip' || doc_id || '.mp4'
    WHEN 2 THEN 'c40/simswap_224/1080x1920/MP4/' || source || '/clip.' || doc_id || '.avi'
    WHEN 3 THEN 'raw/unknown/1x1/' || source || '/' || doc_id || '.mp4'
    WHEN 4 THEN 'raw/targets/' || doc_id || '.mp4'
    ELSE 'old/raw/raw/targets/270x480/' || source || '/' || doc_id || '.mov' END"""


def _path():
    return F.expr(_PATH)


@query(rf"""
    WITH p AS (SELECT {_PATH} AS path FROM documents), s AS (SELECT path, string_split(path, '/') AS parts FROM p),
    i AS (SELECT *, list_filter(range(1, len(parts)), lambda k: lower(parts[k]) IN ('raw', 'c23', 'c40')
        AND lower(parts[k + 1]) IN ('targets', 'deeplivecam', 'simswap_224', 'simswap_512', 'facefusion'))[1] AS start FROM s),
    t AS (SELECT path, parts[start:] AS tail FROM i WHERE start IS NOT NULL AND len(parts) - start + 1 IN (5, 6)),
    n AS (SELECT *, regexp_replace(tail[-1], '\.[^./]*$', '') AS stem FROM t)
    SELECT path, 'clips' AS dataset_id, path AS video_id, lower(tail[1]) AS compression, lower(tail[2]) AS gen_method, tail[3] AS resolution,
        CASE WHEN len(tail) = 6 THEN lower(tail[4]) ELSE '' END AS media_type, tail[-2] AS background_type, stem AS video_name,
        lower('clips:' || tail[-2] || '/' || stem) AS group_id, CASE WHEN lower(tail[2]) = 'targets' THEN 0 ELSE 1 END AS label,
        CASE WHEN lower(tail[2]) = 'targets' THEN 'real' ELSE 'fake' END AS class_name FROM n
""")
def layout_parse(spark, sf):
    return paths.parse_layout(_table(spark, sf, "documents").select(_path().alias("p")), "p", "clips")[0]


@query(f"SELECT 'clips' AS dataset_id, {_PATH} AS path, 'unknown layout' AS error FROM documents WHERE doc_id % 6 IN (3, 4)")
def layout_rejects(spark, sf):
    return paths.parse_layout(_table(spark, sf, "documents").select(_path().alias("p")), "p", "clips")[1]


def _raw_manifest(spark, sf):
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    return docs.join(labels, "doc_id").select(
        F.expr(_PATH).alias("path"), F.col("toxic").cast("string").alias("label"), F.concat(F.lit(" "), F.upper("source"), F.lit(" ")).alias("group_id"),
        F.expr("CASE doc_id % 3 WHEN 0 THEN 'Train' WHEN 1 THEN '' END").alias("split"), F.expr("CASE WHEN doc_id % 4 = 0 THEN concat('v', doc_id) END").alias("video_id"),
    )


@query(rf"""
    WITH m AS (SELECT {_PATH} AS path, toxic AS label, ' ' || upper(source) || ' ' AS group_id, CASE doc_id % 3 WHEN 0 THEN 'Train' WHEN 1 THEN '' END AS split,
        CASE WHEN doc_id % 4 = 0 THEN 'v' || doc_id END AS video_id FROM documents JOIN labels USING (doc_id))
    SELECT '/data/' || path AS path, coalesce(nullif(trim(video_id), ''), path) AS video_id, '' AS compression, '' AS gen_method, '' AS resolution, '' AS media_type,
        '' AS background_type, regexp_replace(string_split(path, '/')[-1], '\.[^./]*$', '') AS video_name, 'custom:' || lower(trim(group_id)) AS group_id, label::INT AS label,
        CASE WHEN label = 0 THEN 'real' ELSE 'fake' END AS class_name, coalesce(lower(nullif(split, '')), '') AS split, 'custom' AS dataset_id,
        nullif(split, '') IS NOT NULL AS split_locked FROM m
""")
def manifest_defaults(spark, sf):
    return manifests.manifest_videos(_raw_manifest(spark, sf), "custom", "/data")


@query("""
    SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'label' WHEN doc_id % 13 = 0 THEN 'group_id' WHEN doc_id % 17 = 0 THEN 'split' END AS error FROM documents
""")
def reject_split(spark, sf):
    rows = _table(spark, sf, "documents").select(
        "doc_id", F.expr("concat('p', doc_id)").alias("path"), F.expr("CASE WHEN doc_id % 11 = 0 THEN '0.5' ELSE '1' END").alias("label"),
        F.expr("CASE WHEN doc_id % 13 = 0 THEN ' ' ELSE source END").alias("group_id"), F.expr("CASE WHEN doc_id % 17 = 0 THEN 'dev' ELSE 'TEST' END").alias("split"),
    )
    return manifests.manifest_errors(rows).select("doc_id", "error")


@query(r"""
    SELECT page_id, regexp_replace(string_split(url, '/')[-1], '\.[^./]*$', '') AS stem, regexp_replace(url, '\.[^./]*$', '') || '.jpg' AS jpg,
        regexp_matches(lower(url), '\.(mp4|avi|mov|mkv)$') AS is_video FROM pages
""")
def stem_suffix(spark, sf):
    url = F.col("url")
    return _table(spark, sf, "pages").select("page_id", paths.stem(url).alias("stem"), paths.with_suffix(url, ".jpg").alias("jpg"), paths.is_video(url).alias("is_video"))


def _tokens(spark, sf):
    rows = _table(spark, sf, "orders").select("o_orderkey", F.expr("concat('set/id', o_custkey, '_id', o_orderkey % 97, '_000.mp4')").alias("path"))
    return rows.withColumn("tokens", paths.tokens(F.col("path")))


@query("SELECT o_orderkey, array_to_string(regexp_extract_all('id' || o_custkey || '_id' || (o_orderkey % 97) || '_000', 'id\\d+'), ',') AS tokens FROM orders".replace("\\\\", "\\"))
def regex_tokens(spark, sf):
    return _tokens(spark, sf).select("o_orderkey", F.array_join("tokens", ",").alias("tokens"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def json_parse(spark, sf):
    return _table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def _frame_paths(spark, sf):
    items = _table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_linenumber")).alias("n"))
    return items.select("l_orderkey", export.json_list(F.transform("n", lambda k: F.concat(F.col("l_orderkey").cast("string"), F.lit("/frame_"), k.cast("string"), F.lit(".png")))).alias("frame_paths"))


@query("""
    SELECT l_orderkey, '["' || string_agg(l_orderkey || '/frame_' || l_linenumber || '.jpg', '", "' ORDER BY l_linenumber) || '"]' AS frame_paths
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY l_orderkey
""")
def json_paths_rewrite(spark, sf):
    return _frame_paths(spark, sf).select("l_orderkey", export.rewrite_paths("frame_paths").alias("frame_paths"))


# -- joins ----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def resume_anti(spark, sf):
    done = _table(spark, sf, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("o_custkey"))
    return manifest.remaining(_table(spark, sf, "orders").select("o_orderkey", "o_custkey"), done, ["o_custkey"])


@query("""
    WITH k AS (SELECT o_custkey, min(o_orderkey) AS m FROM orders GROUP BY 1 ORDER BY m, o_custkey LIMIT 50)
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM k)
""")
def head_keys_semi(spark, sf):
    return manifest.head_keys(_table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], "o_orderkey", 50)


@query("SELECT DISTINCT o_orderkey AS l_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_files_anti(spark, sf):
    wanted = _table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return manifest.missing_keys(wanted, _table(spark, sf, "lineitem"), ["l_orderkey"])


@query(f"""
    WITH {_SPLIT}, one AS (SELECT grp, min(split) AS split FROM s WHERE ds = '1-URGENT' GROUP BY grp),
    e AS (SELECT l_orderkey, l_suppkey AS id FROM lineitem), j AS (SELECT l_orderkey, id, split FROM e LEFT JOIN one ON one.grp = e.id)
    SELECT l_orderkey, CASE WHEN count(split) = count(*) AND count(DISTINCT split) = 1 THEN min(split) END AS split,
        CASE WHEN count(split) < count(*) THEN 'unknown id' WHEN count(DISTINCT split) > 1 THEN 'crosses splits' END AS error FROM j GROUP BY l_orderkey
""")
def all_ids_one_split(spark, sf):
    known = splits.balanced_hash_split(_orders(spark, sf), "ds", "grp").where("ds = '1-URGENT'").select(F.col("grp").alias("id"), "split")
    rows = _table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("ids"))
    return lists.one_split(rows, "l_orderkey", "ids", known)


_CLASSES = "k AS (SELECT r_name AS folder, r_regionkey::INT % 2 AS label, CASE WHEN r_regionkey % 2 = 0 THEN 'real' ELSE 'fake' END AS class_name FROM region WHERE r_regionkey < 4)"


@query(f"""WITH {_CLASSES} SELECT r_name || '/' || n_name || '/' || c_custkey || '.mp4' AS path, folder, label, class_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN k ON folder = r_name""")
def dimension_join(spark, sf):
    region = _table(spark, sf, "region")  # five rows at any scale, and 25 of nation
    nation = _table(spark, sf, "nation").join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    files = _table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat("r_name", F.lit("/"), "n_name", F.lit("/"), "c_custkey", F.lit(".mp4")).alias("path"))
    classes = region.where("r_regionkey < 4").select(F.col("r_name").alias("folder"), F.expr("cast(r_regionkey % 2 AS int)").alias("label"), F.expr("CASE WHEN r_regionkey % 2 = 0 THEN 'real' ELSE 'fake' END").alias("class_name"))
    return listing.with_class(files, classes, "path")


@query("""
    SELECT s.page_id, path, n_chars AS bytes FROM (SELECT page_id, 'd' || (page_id * 3) AS path FROM pages) s LEFT JOIN (SELECT 'd' || doc_id AS path, n_chars FROM documents) f USING (path)
""")
def file_sizes(spark, sf):
    files = _table(spark, sf, "documents").select(F.expr("concat('d', doc_id)").alias("path"), F.col("n_chars").alias("bytes"))
    return listing.join_sizes(_table(spark, sf, "pages").select("page_id", F.expr("concat('d', page_id * 3)").alias("path")), files, "path")


@query("""
    SELECT lang AS dataset_id, doc_id::VARCHAR AS video_id, CASE WHEN l.doc_id IS NULL THEN 'missing file' ELSE '' END AS error FROM documents LEFT JOIN labels l USING (doc_id)
""")
def missing_video_files(spark, sf):
    videos = _table(spark, sf, "documents").select(F.col("lang").alias("dataset_id"), F.col("doc_id").cast("string").alias("path"))
    good, bad = manifests.present(videos, _table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("path")))
    return good.withColumn("error", F.lit("")).unionByName(bad).withColumnRenamed("path", "video_id")


# -- lists and sources ----------------------------------------------------------------------------------------------

_LINES = """CASE doc_id % 12 WHEN 0 THEN '  ' WHEN 1 THEN '2 a.mp4' WHEN 2 THEN 'x' WHEN 3 THEN ' 1   s/d' || doc_id || '.mp4  ' WHEN 4 THEN '0 s/e' || (doc_id // 24) || '.mp4'
    WHEN 5 THEN '1 a b' ELSE '0' || chr(9) || source || '/' || doc_id || '.mp4' END"""


@query(rf"""
    WITH l AS (SELECT trim({_LINES}) AS line FROM documents), p AS (SELECT regexp_split_to_array(line, '\s+') AS p FROM l WHERE line <> ''),
    r AS (SELECT try_cast(p[1] AS INT) AS label, p[2] AS path, len(p) AS n FROM p)
    SELECT label, path, CASE WHEN n <> 2 OR label IS NULL OR label NOT IN (0, 1) THEN 'malformed' WHEN path IS NOT NULL AND count(*) OVER (PARTITION BY path) > 1 THEN 'repeated' END AS error FROM r
""")
def list_rows(spark, sf):
    return lists.test_list_rows(_table(spark, sf, "documents").select(F.expr(_LINES.replace("//", "div")).alias("value")))


@query("SELECT doc_id, l.doc_id IS NOT NULL AS is_test FROM documents LEFT JOIN labels l USING (doc_id)")
def test_membership(spark, sf):
    return lists.marked(_table(spark, sf, "documents").select("doc_id"), _table(spark, sf, "labels").select("doc_id"), "doc_id")


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def listed_but_absent(spark, sf):
    return lists.absent(_table(spark, sf, "documents"), _table(spark, sf, "labels"), "doc_id")


_PAIRS = "SELECT CASE c_nationkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, c_custkey::VARCHAR AS a, (c_custkey + 7)::VARCHAR AS b FROM customer"


def _canonical(spark, sf):
    pairs = _table(spark, sf, "customer").select(F.expr("CASE c_nationkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END").alias("split"), F.expr("concat('[\"', c_custkey, '\", \"', c_custkey + 7, '\"]')").alias("p"))
    # One cell for each nation's worth of pairs, as a canonical split file would hold them.
    cells = pairs.groupBy("split", F.pmod(F.xxhash64("p"), F.lit(64))).agg(F.concat(F.lit("["), F.array_join(F.collect_list("p"), ", "), F.lit("]")).alias("value"))
    return lists.ids_of_pairs(cells, "value", "split")


@query(f"WITH p AS ({_PAIRS}) SELECT a AS id, split FROM p UNION SELECT b, split FROM p")
def canonical_ids(spark, sf):
    return _canonical(spark, sf)


@query(f"WITH p AS ({_PAIRS}) SELECT id, count(DISTINCT split) AS n FROM (SELECT a AS id, split FROM p UNION SELECT b, split FROM p) GROUP BY id HAVING count(DISTINCT split) > 1")
def canonical_conflicts(spark, sf):
    return lists.ids_in_several(_canonical(spark, sf))


_META = "CASE p_size % 4 WHEN 0 THEN 'original' WHEN 1 THEN 'Deepfakes' WHEN 2 THEN 'FaceSwap' ELSE 'Other' END"


@query(f"""
    WITH m AS (SELECT {_META} || '/' || p_partkey || CASE WHEN p_size % 4 = 0 THEN '' ELSE '_' || (p_partkey + 1) END || '.mp4' AS path, p_size * 10 AS w, p_size + 100 AS h FROM part)
    SELECT path, lower(string_split(path, '/')[1]) AS gen_method, w || 'x' || h AS resolution, array_to_string(string_split(regexp_replace(string_split(path, '/')[-1], '\\.mp4$', ''), '_'), ',') AS ids
    FROM m WHERE path NOT LIKE 'Other/%'
""".replace("\\\\", "\\"))
def metadata_rows(spark, sf):
    name = F.concat(F.expr(_META), F.lit("/"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 4 == 0, "").otherwise(F.concat(F.lit("_"), (F.col("p_partkey") + 1).cast("string"))), F.lit(".mp4"))
    meta = _table(spark, sf, "part").select(name.alias("File Path"), (F.col("p_size") * 10).alias("Width"), (F.col("p_size") + 100).alias("Height"))
    return lists.metadata_rows(meta, ("original", "deepfakes", "faceswap")).withColumn("ids", F.array_join("ids", ","))


@query("""
    WITH u AS (SELECT 'docs' AS dataset_id, doc_id::VARCHAR AS video_id, source AS group_id, lang AS path FROM documents UNION ALL SELECT 'pages', page_id::VARCHAR, '', url FROM pages)
    SELECT dataset_id, video_id, group_id, path, '' AS split, false AS split_locked FROM u
""")
def source_union(spark, sf):
    docs = _table(spark, sf, "documents").select(F.lit("docs").alias("dataset_id"), "doc_id", F.col("doc_id").alias("video_id"), F.col("source").alias("group_id"), F.col("lang").alias("path"))
    pages = _table(spark, sf, "pages").select(F.lit("pages").alias("dataset_id"), F.col("page_id").alias("video_id"), F.col("url").alias("path"))
    known = {"docs": docs, "pages": pages, "other": pages.withColumn("dataset_id", F.lit("other"))}
    return manifests.united([known[n] for n in manifests.selected(list(known), ["Pages", "DOCS", "pages"])]).select("dataset_id", "video_id", "group_id", "path", "split", "split_locked")


@query("SELECT event_type AS dataset_id, user_id AS video_id, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def repeated_videos(spark, sf):
    return splits.repeated_videos(_table(spark, sf, "events").select(F.col("event_type").alias("dataset_id"), F.col("user_id").alias("video_id")))


@query("""
    SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/' || url ELSE '/data/in/' || url END AS absolute, printf('frame_%02d.%s', page_id % 130, CASE page_id % 3 WHEN 0 THEN 'png' ELSE 'jpg' END) AS frame,
        printf('jpeg%d_%dseq', page_id % 100, page_id % 7) AS profile, printf('%s_part%03d.zip', 'p' || page_id, page_id % 1200) AS archive FROM pages
""")
def file_names(spark, sf):
    k = F.col("page_id")
    path = F.when(k % 2 == 0, F.concat(F.lit("/"), F.col("url"))).otherwise(F.col("url"))
    suffix = F.when(k % 3 == 0, "PNG").when(k % 3 == 1, "jpeg").otherwise("JPG")
    return _table(spark, sf, "pages").select(
        "page_id", paths.absolute(path, "/data/in/").alias("absolute"), paths.frame_name(k % 130, suffix).alias("frame"), paths.profile_name(k % 100, k % 7).alias("profile"),
        export.archive_name(F.concat(F.lit("p"), k.cast("string")), k % 1200).alias("archive"),
    )


# -- aggregates -----------------------------------------------------------------------------------------------------


@query("""
    SELECT 'o_orderstatus' AS dim, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
    UNION ALL SELECT 'ds', o_orderpriority, count(*) FROM orders GROUP BY 2
""")
def summary_by_dims(spark, sf):
    return summary.counts_by(_orders(spark, sf), ["o_orderstatus", "ds"])


@query("SELECT count(*) AS n_rows, count(DISTINCT (user_id, event_type)) AS n_videos, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS datasets FROM events")
def distinct_videos(spark, sf):
    return _table(spark, sf, "events").agg(F.count("*").alias("n_rows"), F.countDistinct("user_id", "event_type").alias("n_videos"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("datasets"))


@query("SELECT source, count(*) FILTER (toxic = 0) AS real, count(*) FILTER (toxic = 1) AS fake FROM documents JOIN labels USING (doc_id) GROUP BY source")
def group_pivot(spark, sf):
    return summary.pivot_counts(_table(spark, sf, "documents").join(_table(spark, sf, "labels"), "doc_id"), "source", "toxic", {0: "real", 1: "fake"})


_BYTES = """b AS (SELECT lang, source, sum(n_chars)::BIGINT AS bytes, min_by(CASE doc_id % 5 WHEN 0 THEN 'val' WHEN 1 THEN 'test' ELSE 'train' END, doc_id) AS split
    FROM documents GROUP BY lang, source)"""


def _group_bytes(spark, sf):
    split = F.when(F.col("doc_id") % 5 == 0, "val").when(F.col("doc_id") % 5 == 1, "test").otherwise("train")
    return summary.group_bytes(_table(spark, sf, "documents").withColumn("split", split), ["lang", "source"], "n_chars", "split", "doc_id")


@query(f"WITH {_BYTES} SELECT * FROM b")
def group_bytes(spark, sf):
    return _group_bytes(spark, sf)


@query("SELECT quality, count(*) AS n, round((sum(count(*)) OVER ()) / (2.0 * count(*)), 9) AS weight FROM labels GROUP BY quality")
def class_weights(spark, sf):
    return summary.class_weights(_table(spark, sf, "labels"), "quality").withColumn("weight", F.round("weight", 9))


# -- pictures -------------------------------------------------------------------------------------------------------

_PIXELS = """p AS (SELECT vec_id, k // 8 AS y, k % 8 AS x, embedding[k + 1]::DOUBLE * 100 + 128 AS p FROM (SELECT vec_id, embedding, unnest(range(64)) AS k FROM embeddings))"""
_STATS = f"""{_PIXELS}, m AS (SELECT vec_id, y, x, p, unnest([[-1, 0], [1, 0], [0, -1], [0, 1]]) AS d FROM p),
    n AS (SELECT vec_id, y, x, p, abs(y + d[1]) AS ny, abs(x + d[2]) AS nx FROM m),
    q AS (SELECT vec_id, y, x, p, CASE WHEN ny > 7 THEN 14 - ny ELSE ny END AS ny, CASE WHEN nx > 7 THEN 14 - nx ELSE nx END AS nx FROM n),
    l AS (SELECT q.vec_id, q.y, q.x, sum(o.p) - 4 * any_value(q.p) AS lap, any_value(q.p) AS p FROM q JOIN p o ON o.vec_id = q.vec_id AND o.y = q.ny AND o.x = q.nx GROUP BY ALL),
    s AS (SELECT vec_id, var_pop(lap) AS blur, avg(p) AS brightness, stddev_pop(p) AS contrast FROM l GROUP BY vec_id)"""


def _pictures(spark, sf):
    return _table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda e: e.cast("double") * 100 + 128).alias("px"))


@query(f"WITH {_STATS} SELECT vec_id, round(blur, 5) AS blur, round(brightness, 5) AS brightness, round(contrast, 5) AS contrast FROM s")
def pixel_stats(spark, sf):
    s = vision.picture_statistics(_pictures(spark, sf), "vec_id", "px", 8, 8)
    return s.select("vec_id", *(F.round(c, 5).alias(c) for c in ("blur", "brightness", "contrast")))


@query(f"""WITH {_STATS} SELECT vec_id, round(least(greatest(0.3::DOUBLE * least(greatest(blur / 120, 0), 1) + 0.2::DOUBLE * (1 - abs(brightness - 127.5) / 127.5)
    + 0.2::DOUBLE * least(greatest(contrast / 20, 0), 1) + 0.3::DOUBLE * 0.9::DOUBLE, 0), 1), 5) AS quality, blur >= 60 AND brightness BETWEEN 35 AND 225 AND contrast >= 10 AS inside FROM s""")
def quality_score(spark, sf):
    s = vision.picture_statistics(_pictures(spark, sf), "vec_id", "px", 8, 8)
    blur, mean, std = F.col("blur"), F.col("brightness"), F.col("contrast")
    return s.select("vec_id", F.round(vision.quality_column(blur, mean, std, F.lit(0.9)), 5).alias("quality"), vision.within_limits(blur, mean, std, vision.QualityLimits(enforced=True)).alias("inside"))


@query("""
    WITH e AS (SELECT vec_id, label, embedding, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM embeddings),
    w AS (SELECT vec_id, label, wy, wx, unnest(range(49)) AS k, embedding, before FROM e, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(wy, wx) WHERE before IS NOT NULL),
    v AS (SELECT vec_id, label, wy, wx, embedding[(wy + k // 7) * 8 + wx + k % 7 + 1]::DOUBLE * 100 + 128 AS a, before[(wy + k // 7) * 8 + wx + k % 7 + 1]::DOUBLE * 100 + 128 AS b FROM w),
    s AS (SELECT vec_id, label, avg(a) AS ma, avg(b) AS mb, var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS c FROM v GROUP BY vec_id, label, wy, wx),
    r AS (SELECT vec_id, label, avg(((2 * ma * mb + 6.5025) * (2 * c + 58.5225)) / ((ma * ma + mb * mb + 6.5025) * (va + vb + 58.5225))) AS ssim FROM s GROUP BY vec_id, label)
    SELECT e.label, e.vec_id, round(ssim, 6) AS ssim, CASE WHEN ssim IS NOT NULL THEN round(greatest(0, 1 - ssim), 6) END AS motion FROM e LEFT JOIN r USING (vec_id)
""")
def ssim_motion(spark, sf):
    m = vision.motion_against_previous(_pictures(spark, sf), "label", "vec_id", "px", 8)
    return m.select("label", "vec_id", F.round("ssim", 6).alias("ssim"), F.when(F.col("ssim").isNotNull(), F.round("motion", 6)).alias("motion"))


@query(f"""WITH {_PIXELS}, c AS (SELECT vec_id, y, x, round(least(greatest(p, 0), 255)) AS p FROM p), m AS (SELECT vec_id, y // 2 AS y, x // 2 AS x, round_even(avg(p), 0)::BIGINT AS p FROM c GROUP BY ALL)
    SELECT vec_id, string_agg(p::VARCHAR, ',' ORDER BY y, x) AS pixels FROM m GROUP BY vec_id""")
def half_size(spark, sf):
    @F.pandas_udf("string")
    def halved(px):
        return px.map(lambda p: ",".join(map(str, vision.resize(np.rint(np.clip(np.reshape(p, (8, 8)), 0, 255)).astype(np.uint8), 4).ravel().tolist())))

    return _pictures(spark, sf).select("vec_id", halved("px").alias("pixels"))


def _boxes(spark, sf):
    return _table(spark, sf, "part").select(
        "p_partkey", F.lit(640).alias("width"), F.lit(360).alias("height"),
        F.expr("""struct(cast(p_partkey % 23 / 20D - 0.1D AS double) AS xmin, cast(p_partkey % 17 / 16D AS double) AS ymin, cast(p_size / 100D AS double) AS w,
            cast(p_partkey % 7 / 12D AS double) AS h, 0.5D AS score)""").alias("box"),
    )


@query("""
    WITH b AS (SELECT p_partkey, (p_partkey % 23) / 20.0::DOUBLE - 0.1::DOUBLE AS xmin, (p_partkey % 17) / 16.0::DOUBLE AS ymin, p_size / 100.0::DOUBLE AS w, (p_partkey % 7) / 12.0::DOUBLE AS h FROM part),
    i AS (SELECT *, trunc(xmin * 640)::INT AS x, trunc(ymin * 360)::INT AS y, trunc(w * 640)::INT AS pw, trunc(h * 360)::INT AS ph FROM b),
    c AS (SELECT *, trunc(greatest(pw, ph) * 1.3::DOUBLE)::INT // 2 AS half, x + floor(pw / 2.0)::INT AS cx, y + floor(ph / 2.0)::INT AS cy FROM i),
    r AS (SELECT p_partkey, greatest(0, least(cx - half, 640)) AS x1, greatest(0, least(cy - half, 360)) AS y1, greatest(0, least(cx + half, 640)) AS x2,
        greatest(0, least(cy + half, 360)) AS y2, greatest(w, 0) * greatest(h, 0) < 0.02::DOUBLE AS small FROM c)
    SELECT p_partkey, x1, y1, x2, y2, x2 - x1 <= 10 OR y2 - y1 <= 10 AS missing_face_flag, x2 - x1 <= 10 OR y2 - y1 <= 10 OR small AS hard_invalid FROM r
""")
def crop_geometry(spark, sf):
    return vision.crop_geometry(_boxes(spark, sf), "box", "width", "height").drop("box", "width", "height")


@query("""
    WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS w, l_tax AS h, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem)
    SELECT l_orderkey, l_partkey AS picked FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY w * h DESC, k) AS r FROM d) WHERE r = 1
""")
def pick_detection(spark, sf):
    d = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("w"), F.col("l_tax").alias("h"))
    rows = _table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(d)).alias("d"))
    return rows.select("l_orderkey", vision.pick_detection(F.col("d"))["l_partkey"].alias("picked"))


# -- series ---------------------------------------------------------------------------------------------------------

_FRAMES = """fr AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 1e6::DOUBLE AS t,
    least(value / 500.0::DOUBLE, 1.0::DOUBLE) AS q FROM events)"""
_SAMPLED = f"""{_FRAMES}, bk AS (SELECT *, floor((t + 1e-9::DOUBLE) / 43200.0::DOUBLE)::BIGINT AS b FROM fr),
    sn AS (SELECT *, coalesce(max(b) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS seen FROM bk),
    sm AS (SELECT user_id, i, t, q, row_number() OVER (PARTITION BY user_id ORDER BY i) - 1 AS candidate_id FROM sn WHERE b > seen)"""
_SCORED = f"""{_SAMPLED}, bn AS (SELECT *, trunc(t / 86400.0::DOUBLE)::BIGINT AS bin FROM sm),
    sc AS (SELECT *, 0.65::DOUBLE * q + 0.25::DOUBLE * least((1 - q) / 0.2::DOUBLE, 1.0::DOUBLE) + 0.10::DOUBLE * greatest(0.0::DOUBLE, 1 - abs(t - (bin + 0.5::DOUBLE) * 86400.0::DOUBLE) / 43200.0::DOUBLE) AS score FROM bn),
    bs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, bin ORDER BY score DESC, candidate_id) AS k FROM sc) WHERE k = 1)"""
_BINS = f"""{_SCORED}, dn AS (SELECT user_id, unnest(range(mx + 1)) AS bin FROM (SELECT user_id, max(bin) AS mx FROM bs GROUP BY user_id)),
    ok AS (SELECT user_id, bin, candidate_id, q FROM bs WHERE q >= 0.03::DOUBLE),
    lv AS (SELECT user_id, bin, candidate_id, q, candidate_id IS NOT NULL AS valid, last_value(CASE WHEN candidate_id IS NOT NULL THEN bin END IGNORE NULLS) OVER w AS lv,
        last_value(q IGNORE NULLS) OVER w AS lq FROM dn LEFT JOIN ok USING (user_id, bin) WINDOW w AS (PARTITION BY user_id ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    rp AS (SELECT user_id, bin, CASE WHEN valid THEN 'valid' WHEN lv IS NOT NULL AND bin - lv <= 1 THEN 'repair' ELSE 'missing' END AS state, lq FROM lv),
    st AS (SELECT user_id, bin, state, CASE WHEN state = 'missing' THEN 0 ELSE lq END AS quality FROM rp),
    mv AS (SELECT *, CASE state WHEN 'repair' THEN 1.0::DOUBLE WHEN 'valid' THEN 1 - abs(quality - lag(CASE WHEN state <> 'missing' THEN quality END) OVER (PARTITION BY user_id ORDER BY bin)) END AS ssim FROM st),
    ft AS (SELECT *, CASE WHEN state = 'valid' THEN greatest(0, 1 - coalesce(ssim, 1)) ELSE 0 END AS motion FROM mv)"""
_WINDOWS = f"""{_BINS}, wd AS (SELECT user_id, bin AS start_bin, count(*) OVER w AS n, avg(quality) OVER w AS avg_quality, coalesce(avg(CASE WHEN ssim IS NOT NULL THEN motion END) OVER w, 0) AS avg_motion,
        count(CASE WHEN ssim >= 0.995::DOUBLE THEN 1 END) OVER w / greatest(count(ssim) OVER w, 1)::DOUBLE AS duplicate_ratio, count(CASE WHEN state = 'missing' THEN 1 END) OVER w / 6.0::DOUBLE AS missing_ratio,
        count(CASE WHEN state = 'repair' THEN 1 END) OVER w / 6.0::DOUBLE AS repair_ratio FROM ft WINDOW w AS (PARTITION BY user_id ORDER BY bin ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
    ws AS (SELECT *, 0.60::DOUBLE * avg_quality + 0.25::DOUBLE * least(avg_motion / 0.2::DOUBLE, 1.0::DOUBLE) - 0.10::DOUBLE * duplicate_ratio - 0.05::DOUBLE * repair_ratio AS window_score
        FROM wd WHERE n = 6 AND start_bin % 2 = 0),
    ac AS (SELECT * FROM ws WHERE missing_ratio <= 0.2::DOUBLE AND repair_ratio <= 0.4::DOUBLE AND duplicate_ratio <= 0.5::DOUBLE AND avg_motion >= 0.001::DOUBLE)"""
_LIMITS = sequences.WindowLimits(max_missing=0.2, max_repair=0.4, max_duplicate=0.5, min_motion=0.001)
_WINDOW_OUT = "user_id, start_bin, " + ", ".join(f"round({c}, 9) AS {c}" for c in ("avg_quality", "avg_motion", "duplicate_ratio", "missing_ratio", "repair_ratio", "window_score"))


def _frames(spark, sf):
    from pyspark.sql import Window

    e = _table(spark, sf, "events")
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    t = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)") / F.lit(1e6)
    return e.select("user_id", i.cast("long").alias("i"), t.alias("t"), F.least(F.col("value") / 500.0, F.lit(1.0)).alias("q"))


def _sampled(spark, sf):
    return sampling.rate_sample(_frames(spark, sf), "user_id", "i", "t", HALF_DAY)


def _best(spark, sf):
    rows = _sampled(spark, sf).withColumn("bin", selection.time_bin(F.col("t"), DAY))
    rows = rows.withColumn("score", selection.candidate_score(F.col("q"), 1 - F.col("q"), F.col("t"), F.col("bin"), DAY))
    return selection.best_per_bin(rows, "user_id", "bin", "score", "candidate_id")


def _repaired(spark, sf):
    best = _best(spark, sf).select("user_id", "bin", "q")
    whole = selection.repair_gaps(best.where("q >= 0.03"), "user_id", "bin", DAY, 1, ["q"], candidates=best)
    return whole.select("user_id", "bin", "state", F.when(F.col("state") == "missing", 0.0).otherwise(F.col("q")).alias("quality"))


def _bins(spark, sf):
    from pyspark.sql import Window

    before = F.lag(F.when(F.col("state") != "missing", F.col("quality"))).over(Window.partitionBy("user_id").orderBy("bin"))
    rows = _repaired(spark, sf).withColumn("_b", before)
    rows = rows.withColumn("ssim", F.when(F.col("state") == "repair", 1.0).when(F.col("state") == "valid", 1 - F.abs(F.col("quality") - F.col("_b"))))
    return rows.withColumn("motion", F.when(F.col("state") == "valid", F.greatest(F.lit(0.0), 1 - F.coalesce("ssim", F.lit(1.0)))).otherwise(0.0)).drop("_b")


def _windows(spark, sf):
    return sequences.sliding_windows(_bins(spark, sf), "user_id", "bin", "state", "quality", "motion", "ssim", 6, 2, _LIMITS)


def _rounded(df):
    return df.select("user_id", "start_bin", *(F.round(c, 9).alias(c) for c in ("avg_quality", "avg_motion", "duplicate_ratio", "missing_ratio", "repair_ratio", "window_score")))


@query(f"WITH {_SAMPLED} SELECT user_id, i, candidate_id FROM sm")
def rate_sample(spark, sf):
    return _sampled(spark, sf).select("user_id", "i", "candidate_id")


@query(f"""WITH {_SAMPLED}, b AS (SELECT user_id, trunc(t / 86400.0::DOUBLE)::BIGINT AS bin, count(*) AS n FROM sm GROUP BY ALL)
    SELECT user_id, bin, coalesce(n, 0) AS n FROM (SELECT user_id, unnest(range(max(bin) + 1)) AS bin FROM b GROUP BY user_id) LEFT JOIN b USING (user_id, bin)""")
def time_bins_dense(spark, sf):
    n = _sampled(spark, sf).withColumn("bin", selection.time_bin(F.col("t"), DAY)).groupBy("user_id", "bin").agg(F.count("*").alias("n"))
    return selection.dense_bins(n, "user_id", "bin").join(n, ["user_id", "bin"], "left").select("user_id", "bin", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"WITH {_SCORED} SELECT user_id, bin, candidate_id, round(score, 6) AS score FROM bs")
def best_per_bin(spark, sf):
    return _best(spark, sf).select("user_id", "bin", "candidate_id", F.round("score", 6).alias("score"))


_CHOSEN = """max({{'s': 0.65::DOUBLE * c.q + 0.25::DOUBLE * least({motion} / 0.2::DOUBLE, 1.0::DOUBLE)
    + 0.10::DOUBLE * greatest(0.0::DOUBLE, 1 - abs(c.t - (c.bin + 0.5::DOUBLE) * 86400.0::DOUBLE) / 43200.0::DOUBLE), 'n': -c.candidate_id, 'm': {motion}, 'q': c.q}}) AS best"""


@query(f"""
    WITH RECURSIVE {_SAMPLED}, bn AS (SELECT *, trunc(t / 86400.0::DOUBLE)::BIGINT AS bin FROM sm),
    k AS (SELECT user_id, bin, row_number() OVER (PARTITION BY user_id ORDER BY bin) AS k FROM (SELECT DISTINCT user_id, bin FROM bn)), c AS (SELECT bn.*, k.k FROM bn JOIN k USING (user_id, bin)),
    f AS (SELECT c.user_id, c.k, {_CHOSEN.format(motion="0.0::DOUBLE")} FROM c WHERE c.k = 1 GROUP BY c.user_id, c.k
        UNION ALL SELECT c.user_id, c.k, {_CHOSEN.format(motion="abs(c.q - f.best.q)")} FROM f JOIN c ON c.user_id = f.user_id AND c.k = f.k + 1 GROUP BY c.user_id, c.k)
    SELECT user_id, bin, -best.n AS candidate_id, round(best.s, 9) AS score, round(best.m, 9) AS motion FROM f JOIN k USING (user_id, k)
""")
def fold_select(spark, sf):
    rows = _sampled(spark, sf).withColumn("bin", selection.time_bin(F.col("t"), DAY))
    chosen = selection.fold_select(rows, "user_id", "bin", "candidate_id", "t", "q", "q", DAY)
    return chosen.select("user_id", "bin", "candidate_id", F.round("score", 9).alias("score"), F.round("motion", 9).alias("motion"))


@query(f"WITH {_BINS} SELECT user_id, bin, state, round(quality, 6) AS quality FROM ft")
def gap_repair(spark, sf):
    return _repaired(spark, sf).select("user_id", "bin", "state", F.round("quality", 6).alias("quality"))


@query(f"WITH {_WINDOWS} SELECT {_WINDOW_OUT} FROM ws")
def sliding_windows(spark, sf):
    return _rounded(_windows(spark, sf))


@query(f"WITH {_WINDOWS} SELECT {_WINDOW_OUT} FROM ac")
def window_accept(spark, sf):
    return _rounded(sequences.accepted(_windows(spark, sf), _LIMITS))


_ENDS = f"""{_WINDOWS}, ed AS (SELECT bs.user_id, bs.bin, bs.t, bs.i FROM bs WHERE bs.q >= 0.03::DOUBLE),
    fl AS (SELECT ft.user_id, ft.bin, ft.state, coalesce(t, ft.bin * 86400.0::DOUBLE) AS t, CASE WHEN ft.state = 'missing' THEN -1 ELSE last_value(i IGNORE NULLS) OVER w END AS i FROM ft LEFT JOIN ed USING (user_id, bin)
        WINDOW w AS (PARTITION BY user_id ORDER BY ft.bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    en AS (SELECT ac.*, a.t AS start_time, z.t AS end_time, a.i AS start_frame, z.i AS end_frame
        FROM ac JOIN fl a ON a.user_id = ac.user_id AND a.bin = start_bin JOIN fl z ON z.user_id = ac.user_id AND z.bin = start_bin + 5)"""


def _ends(spark, sf):
    best = _best(spark, sf).select("user_id", "bin", "q", "t", "i")
    whole = selection.repair_gaps(best.where("q >= 0.03"), "user_id", "bin", DAY, 1, ["i", "t"], "i", best.select("user_id", "bin"))
    ends = whole.select("user_id", "bin", "i", F.when(F.col("state") == "valid", F.col("t")).otherwise(F.col("bin_start")).alias("t"))
    bins = _bins(spark, sf).join(ends, ["user_id", "bin"])
    windows = sequences.sliding_windows(bins, ["user_id"], "bin", "state", "quality", "motion", "ssim", 6, 2, _LIMITS, {"t": "time", "i": "frame"})
    return sequences.accepted(windows, _LIMITS)


@query(f"WITH {_ENDS} SELECT user_id, start_bin, round(start_time, 6) AS start_time, round(end_time, 6) AS end_time, start_frame, end_frame FROM en")
def window_ends(spark, sf):
    return _ends(spark, sf).select("user_id", "start_bin", F.round("start_time", 6).alias("start_time"), F.round("end_time", 6).alias("end_time"), "start_frame", "end_frame")


_RUN = run.RunConfig(({"id": "events", "adapter": "layout", "root": "events"},), "out", seq_len=6, window_hop=2, limits=_LIMITS)
_SCORES = ("avg_quality", "avg_motion", "duplicate_ratio", "missing_face_ratio", "repair_ratio", "window_score")


@query(rf"""WITH {_ENDS}, h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('events|' || user_id || '|' || start_frame || '|' || end_frame || '|6|7.5|300|' || printf('%.9f', start_time)
        || '|' || printf('%.9f', end_time) || '|{_RUN.fingerprint()}')) AS h FROM en),
    s AS (SELECT *, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (('0x' || substr(h, 17, 1))::INT % 4) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS sequence_id FROM h)
    SELECT sequence_id, 'events' AS dataset_id, user_id::VARCHAR AS video_id, 'events:' || (user_id % 10) AS group_id, (user_id % 2)::INT AS label, CASE WHEN user_id % 2 = 0 THEN 'real' ELSE 'fake' END AS class_name, 'train' AS split,
        '' AS compression, '' AS gen_method, '' AS resolution, '' AS media_type, '' AS background_type, '' AS video_name,
        '["' || array_to_string(list_transform(range(6), lambda k: sequence_id || '/frame_0' || k || '.png'), '", "') || '"]' AS frame_paths, round(start_time, 6) AS start_time, round(end_time, 6) AS end_time,
        start_frame::INT AS start_frame, end_frame::INT AS end_frame, 15.0::DOUBLE AS candidate_fps, 7.5::DOUBLE AS model_fps, 6 AS seq_len, 300 AS image_size, 'png' AS image_format, round(avg_quality, 9) AS avg_quality,
        round(avg_motion, 9) AS avg_motion, round(duplicate_ratio, 9) AS duplicate_ratio, round(missing_ratio, 9) AS missing_face_ratio, round(repair_ratio, 9) AS repair_ratio, round(window_score, 9) AS window_score,
        '{run.VERSION}' AS pipeline_version, '{_RUN.fingerprint()}' AS pipeline_fingerprint FROM s""")
def sequence_manifest(spark, sf):
    user = F.col("user_id")
    windows = _ends(spark, sf).select(F.lit("events").alias("dataset_id"), user.cast("string").alias("video_id"), "*").drop("user_id")
    videos = _table(spark, sf, "events").select("user_id").distinct().select(
        F.lit("events").alias("dataset_id"), user.cast("string").alias("video_id"), F.concat(F.lit("events:"), (user % 10).cast("string")).alias("group_id"), (user % 2).cast("int").alias("label"),
        F.when(user % 2 == 0, "real").otherwise("fake").alias("class_name"), F.lit("train").alias("split"),
    )
    rounded = {c: F.round(c, 9) for c in _SCORES} | {c: F.round(c, 6) for c in ("start_time", "end_time")}
    return run.manifest_rows(windows, videos, _RUN).withColumns(rounded)


@query("""
    WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
    b AS (SELECT *, unnest(range(6)) AS k FROM r),
    c AS (SELECT *, CASE WHEN n <= 6 THEN i ELSE k END AS chunk FROM b WHERE (n <= 6 AND k = 0) OR (n > 6 AND i >= floor(k * (n / 6.0::DOUBLE)) AND i < floor((k + 1) * (n / 6.0::DOUBLE)))),
    t AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, chunk ORDER BY o_totalprice DESC, i) AS best FROM c)
    SELECT o_custkey, o_orderkey FROM t WHERE best = 1
""")
def stratified_top1(spark, sf):
    return sequences.stratified_top1(_table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", 6).select("o_custkey", "o_orderkey")


@query(f"""
    WITH RECURSIVE {_FRAMES}, r AS (SELECT user_id, i, CASE WHEN user_id % 5 = 0 THEN 30.0::DOUBLE ELSE 25.0::DOUBLE END AS fps, CASE WHEN i % 7 = 3 THEN -1.0::DOUBLE ELSE t / 86400.0::DOUBLE END AS c FROM fr),
    s AS (SELECT user_id, i, CASE WHEN c >= 0 THEN c ELSE i / fps END AS x FROM r WHERE i = 0
        UNION ALL SELECT r.user_id, r.i, CASE WHEN r.c >= 0 AND r.c > s.x THEN r.c ELSE r.i / r.fps END FROM s JOIN r ON r.user_id = s.user_id AND r.i = s.i + 1)
    SELECT user_id, i, round(x, 9) AS timestamp FROM s
""")
def timestamp_repair(spark, sf):
    rows = _frames(spark, sf).select("user_id", "i", F.when(F.col("user_id") % 5 == 0, 0.0).otherwise(25.0).alias("fps"), F.when(F.col("i") % 7 == 3, -1.0).otherwise(F.col("t") / 86400).alias("c"))
    return sampling.repaired_timestamps(rows, "user_id", "i", "fps", "c").select("user_id", "i", F.round("timestamp", 9).alias("timestamp"))


# -- export and upsert ----------------------------------------------------------------------------------------------

_HASHED = "h AS (SELECT c_custkey, sha256('42:' || c_custkey) AS h, c_nationkey::BIGINT AS real FROM customer)"


def _hashed(spark, sf):
    return _table(spark, sf, "customer").select("c_custkey", F.sha2(F.concat(F.lit("42:"), F.col("c_custkey").cast("string")), 256).alias("h"), F.col("c_nationkey").cast("long").alias("real"))


@query(f"WITH {_HASHED}, s AS (SELECT *, coalesce(sum(real) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM h) SELECT c_custkey, h, real FROM s WHERE 10 + before < 500")
def budget_prefix(spark, sf):
    return export.budget_prefix(_hashed(spark, sf), "h", "real", 500.0, 10.0)


@query("""
    WITH g AS (SELECT source, count(*) FILTER (toxic = 1) AS fake, count(*) FILTER (toxic = 0) AS real, sha256('42:' || source) AS h FROM documents JOIN labels USING (doc_id) GROUP BY source)
    SELECT source, fake, real FROM g ORDER BY abs(fake - 3), abs(real - 15), h LIMIT 1
""")
def closest_group(spark, sf):
    g = group_pivot(spark, sf).withColumn("h", F.sha2(F.concat(F.lit("42:"), "source"), 256))
    return export.closest_group(g, "fake", "real", 3, 15, "h").select("source", "fake", "real")


@query(f"""
    WITH RECURSIVE {_BYTES}, o AS (SELECT *, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 WHEN 'test' THEN 2 ELSE 99 END AS r FROM b),
    k AS (SELECT *, row_number() OVER (ORDER BY r, lang, source) AS n FROM o),
    f AS (SELECT n, lang, source, split, bytes, bytes AS used, 0::BIGINT AS part FROM k WHERE n = 1
        UNION ALL SELECT k.n, k.lang, k.source, k.split, k.bytes, CASE WHEN k.split <> f.split OR f.used + k.bytes > 60000 THEN k.bytes ELSE f.used + k.bytes END,
            CASE WHEN k.split <> f.split OR f.used + k.bytes > 60000 THEN f.part + 1 ELSE f.part END FROM f JOIN k ON k.n = f.n + 1)
    SELECT split, lang, source, bytes, part FROM f
""")
def next_fit_shards(spark, sf):
    return export.next_fit_shards(_group_bytes(spark, sf), "split", "lang", "source", "bytes", 60_000)


@query(f"WITH {_BYTES}, p AS (SELECT lang, source FROM b WHERE split = 'val') SELECT doc_id FROM documents JOIN p USING (lang, source)")
def shard_membership(spark, sf):
    plan = _group_bytes(spark, sf).withColumn("part", F.when(F.col("split") == "val", 1).otherwise(0))
    return export.shard_rows(_table(spark, sf, "documents"), plan, 1, ["lang", "source"]).select("doc_id")


@query(f"WITH {_HASHED} SELECT c_custkey, h FROM h ORDER BY h LIMIT 20")
def hash_order_topn(spark, sf):
    return _hashed(spark, sf).orderBy("h").limit(20).select("c_custkey", "h")


@query(f"WITH {_BYTES} SELECT lang, source, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 WHEN 'test' THEN 2 ELSE 99 END AS rank FROM b")
def rank_order(spark, sf):
    return _group_bytes(spark, sf).select("lang", "source", export.split_rank(F.col("split")).alias("rank"))


@query("""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS gen
    FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0
""")
def upsert_keep_last(spark, sf):
    o = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    old = o.where("o_orderkey % 2 = 0").withColumn("gen", F.lit("old"))
    new = o.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("gen", F.lit("new"))
    return manifest.upsert(old, new, ["o_orderkey"], ["o_totalprice"])


@query("""
    SELECT lang AS dataset_id, doc_id::VARCHAR AS video_id, source AS group_id, '' AS split, NULL::INT AS label, '' AS class_name, '' AS compression, '' AS gen_method, '' AS resolution,
        '' AS media_type, '' AS background_type, '' AS video_name FROM documents
""")
def reindex_union(spark, sf):
    rows = _table(spark, sf, "documents").select(F.col("source").alias("group_id"), F.col("lang").alias("dataset_id"), F.col("doc_id").alias("video_id"), "n_chars")
    return manifest.conformed(rows, SPLIT_ROWS)


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference(spark, sf):
    return manifest.missing_keys(_table(spark, sf, "documents"), _table(spark, sf, "labels"), ["doc_id"])


@query(f"""WITH RECURSIVE {_BYTES}, o AS (SELECT *, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 WHEN 'test' THEN 2 ELSE 99 END AS r FROM b),
    k AS (SELECT *, row_number() OVER (ORDER BY r, lang, source) AS n FROM o),
    f AS (SELECT n, split, bytes, bytes AS used, 0::BIGINT AS part FROM k WHERE n = 1
        UNION ALL SELECT k.n, k.split, k.bytes, CASE WHEN k.split <> f.split OR f.used + k.bytes > 60000 THEN k.bytes ELSE f.used + k.bytes END,
            CASE WHEN k.split <> f.split OR f.used + k.bytes > 60000 THEN f.part + 1 ELSE f.part END FROM f JOIN k ON k.n = f.n + 1)
    SELECT part, split, count(*) AS groups, sum(bytes)::BIGINT AS bytes FROM f GROUP BY part, split""")
def shard_totals(spark, sf):
    return export.shard_table(next_fit_shards(spark, sf))


@query("""
    WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey % 7 AS ds, l_partkey AS v, l_shipdate, l_extendedprice, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY l_suppkey % 7, l_partkey) AS n
            FROM lineitem WINDOW w AS (PARTITION BY l_suppkey % 7, l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey)),
    c AS (SELECT *, CASE WHEN n <= 3 THEN i ELSE k END AS chunk FROM (SELECT *, unnest(range(3)) AS k FROM r) WHERE (n <= 3 AND k = 0) OR (n > 3 AND i >= floor(k * (n / 3.0::DOUBLE)) AND i < floor((k + 1) * (n / 3.0::DOUBLE)))),
    t AS (SELECT *, row_number() OVER (PARTITION BY ds, v, chunk ORDER BY l_extendedprice DESC, i) AS best FROM c)
    SELECT ds, v, l_orderkey, l_linenumber FROM t WHERE best = 1
""")
def manifest_stratified(spark, sf):
    rows = _table(spark, sf, "lineitem").withColumns({"ds": F.col("l_suppkey") % 7, "v": F.col("l_partkey")})
    return sequences.stratified_top1(rows, ["ds", "v"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"], "l_extendedprice", 3).select("ds", "v", "l_orderkey", "l_linenumber")


@query(f"""WITH {_SPLIT}, o AS (SELECT o_orderkey, s.ds, s.grp, s.split FROM orders JOIN s ON o_orderpriority = s.ds AND o_custkey = s.grp)
    SELECT * FROM o ORDER BY ds, o_orderkey LIMIT 100""")
def limited_after_split(spark, sf):
    return splits.assign_split(_orders(spark, sf).select("o_orderkey", "ds", "grp"), "ds", "grp").orderBy("ds", "o_orderkey").limit(100)


# -- graph and identity ---------------------------------------------------------------------------------------------

# Every document is a node; documents of one length form a chain in the order of their ids, so what is reached is known.
_REACH = """c AS (SELECT doc_id AS node, min(doc_id) OVER (PARTITION BY n_chars) AS component FROM documents),
    n AS (SELECT component, 'identity-component/' || string_agg(node::VARCHAR, '-' ORDER BY node::VARCHAR) AS name FROM c GROUP BY component)"""


def _nodes_and_edges(spark, sf):
    from pyspark.sql import Window

    docs = _table(spark, sf, "documents")
    before = F.lag("doc_id").over(Window.partitionBy("n_chars").orderBy("doc_id"))
    return docs.select(F.col("doc_id").alias("node")), docs.select(F.col("doc_id").alias("a"), before.alias("b"))


@query(f"WITH {_REACH} SELECT node, component, sha256(name) AS name FROM c JOIN n USING (component)")
def components(spark, sf):
    return graph.named_components(*_nodes_and_edges(spark, sf)).withColumn("name", F.sha2("name", 256))


@query(rf"""WITH {_REACH}, r AS (SELECT doc_id, 'Set/A' || doc_id || '.MP4' AS path, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id END AS first, CASE WHEN doc_id % 10 = 0 THEN 'test' ELSE 'train' END AS split FROM documents)
    SELECT doc_id, sha256(CASE WHEN split = 'test' THEN 'official-test/' || lower('Set/A' || doc_id) ELSE coalesce(name, lower('Set/A' || doc_id)) END) AS group_id
    FROM r LEFT JOIN c ON c.node = r.first LEFT JOIN n USING (component)""")
def component_groups(spark, sf):
    rows = _table(spark, sf, "documents").select(
        "doc_id", F.expr("concat('Set/A', doc_id, '.MP4')").alias("path"), F.expr("CASE WHEN doc_id % 3 = 0 THEN array() ELSE array(doc_id) END").alias("tokens"),
        F.expr("CASE WHEN doc_id % 10 = 0 THEN 'test' ELSE 'train' END").alias("split"),
    )
    members, names = graph.component_tables(*_nodes_and_edges(spark, sf))
    return graph.group_ids(rows, members, "tokens", "path", "split", names, lambda c: F.sha2(c, 256)).select("doc_id", "group_id")


@query("""
    WITH g AS (SELECT source, count(*) FILTER (toxic = 1) AS fake, count(*) FILTER (toxic = 0) AS real, sha256('42:' || source) AS h FROM documents JOIN labels USING (doc_id) GROUP BY source),
    t AS (SELECT round_even(sum(fake) * 0.15::DOUBLE, 0) AS f, round_even(sum(real) * 0.15::DOUBLE, 0) AS r FROM g),
    o AS (SELECT source, real FROM g, t WHERE fake > 0 ORDER BY abs(fake - f), abs(real - r), h LIMIT 1),
    q AS (SELECT g.source, coalesce(sum(g.real) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + coalesce((SELECT real FROM o), 0) AS before FROM g WHERE fake = 0),
    v AS (SELECT source FROM o UNION SELECT source FROM q, t WHERE before < r)
    SELECT source, fake, real, CASE WHEN source IN (SELECT source FROM v) THEN 'val' ELSE 'train' END AS split FROM g
""")
def train_val_assign(spark, sf):
    return export.train_val_assign(group_pivot(spark, sf), "fake", "real", "source")


@query("""
    WITH s AS (SELECT event_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(user_id || '|' || event_type || '|' || printf('%.9f', value))) AS h FROM events)
    SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (('0x' || substr(h, 17, 1))::INT % 4) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS sequence_id FROM s
""")
def sequence_id(spark, sf):
    return _table(spark, sf, "events").select("event_id", identity.sequence_id(F.col("user_id"), F.col("event_type"), identity.fixed9("value")).alias("sequence_id"))


# -- rules and training ---------------------------------------------------------------------------------------------


def _sequence_rows(spark, sf):
    return _table(spark, sf, "orders").select(
        F.expr("concat('s', o_orderkey % 9000)").alias("sequence_id"), F.col("o_orderpriority").alias("dataset_id"), F.col("o_custkey").cast("string").alias("video_id"),
        (F.col("o_custkey") % 50).cast("string").alias("group_id"), F.expr("cast(CASE WHEN o_orderkey % 41 = 0 THEN 2 ELSE o_orderkey % 2 END AS int)").alias("label"),
        F.expr("CASE WHEN o_orderkey % 37 = 0 THEN 'dev' WHEN o_custkey % 5 = 0 THEN 'val' ELSE 'train' END").alias("split"),
        F.expr("""CASE WHEN o_orderkey % 43 = 0 THEN 'x' WHEN o_orderkey % 47 = 0 THEN '["../a.png"]' ELSE concat('["', o_orderkey, '/frame_00.png"]') END""").alias("frame_paths"),
        F.lit(1).alias("seq_len"), F.expr("CASE WHEN o_orderkey < 5 THEN 'old' ELSE 'abc' END").alias("pipeline_fingerprint"),
    )


@query("""
    WITH m AS (SELECT 's' || (o_orderkey % 9000) AS sid, o_orderpriority AS ds, o_custkey % 50 AS grp, CASE WHEN o_orderkey % 41 = 0 THEN 2 ELSE o_orderkey % 2 END AS label,
        CASE WHEN o_orderkey % 37 = 0 THEN 'dev' WHEN o_custkey % 5 = 0 THEN 'val' ELSE 'train' END AS split, o_orderkey % 43 = 0 OR o_orderkey % 47 = 0 AS bad, o_orderkey AS k,
        CASE WHEN o_orderkey < 5 THEN 'old' ELSE 'abc' END AS fp FROM orders)
    SELECT 'empty' AS rule, (count(*) = 0)::BIGINT AS violations FROM m
    UNION ALL SELECT 'duplicate_sequence', count(*) - count(DISTINCT sid) FROM m
    UNION ALL SELECT 'several_fingerprints', greatest(count(DISTINCT fp) - 1, 0) FROM m
    UNION ALL SELECT 'bad_label', count(*) FILTER (label NOT IN (0, 1)) FROM m
    UNION ALL SELECT 'bad_split', count(*) FILTER (split NOT IN ('train', 'val', 'test')) FROM m
    UNION ALL SELECT 'missing_split', 3 - count(DISTINCT CASE WHEN split IN ('train', 'val', 'test') THEN split END) FROM m
    UNION ALL SELECT 'train_label', 2 - count(DISTINCT CASE WHEN split = 'train' AND label IN (0, 1) THEN label END) FROM m
    UNION ALL SELECT 'bad_paths', count(*) FILTER (bad) FROM m
    UNION ALL SELECT 'leaking_group', count(*) FROM (SELECT 1 FROM m GROUP BY ds, grp HAVING count(DISTINCT split) > 1)
    UNION ALL SELECT 'missing_file', count(DISTINCT k) FROM m WHERE NOT bad AND k NOT IN (SELECT l_orderkey FROM lineitem)
""")
def validation_report(spark, sf):
    listing = _table(spark, sf, "lineitem").select(F.expr("concat(l_orderkey, '/frame_00.png')").alias("path")).distinct()
    return validate.violations(_sequence_rows(spark, sf), listing)


@query("""
    SELECT 'sequences' AS what, '' AS value, count(*) AS n FROM orders UNION ALL SELECT 'videos', '', count(DISTINCT (o_orderpriority, o_custkey)) FROM orders
    UNION ALL SELECT 'dataset_id', o_orderpriority, count(*) FROM orders GROUP BY 2
    UNION ALL SELECT 'split', CASE WHEN o_orderkey % 37 = 0 THEN 'dev' WHEN o_custkey % 5 = 0 THEN 'val' ELSE 'train' END, count(*) FROM orders GROUP BY 2
""")
def validation_totals(spark, sf):
    return validate.totals(_sequence_rows(spark, sf))


@query("SELECT DISTINCT 'old' AS pipeline_fingerprint FROM orders WHERE o_orderkey < 5")
def foreign_fingerprints(spark, sf):
    rows = _sequence_rows(spark, sf)
    return manifest.other_fingerprints(rows.unionByName(rows.limit(1).withColumn("pipeline_fingerprint", F.lit("nan"))), "abc")


@query("""
    SELECT '/root/' || l_orderkey || '/frame_1.png' AS first_path, (l_orderkey % 2)::FLOAT AS label FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber = 1) WHERE l_orderkey % 4 < 2
""")
def training_rows(spark, sf):
    rows = _table(spark, sf, "lineitem").where("l_linenumber = 1").select("l_orderkey").distinct()
    rows = rows.select(F.expr("""concat('["', l_orderkey, '/frame_1.png"]')""").alias("frame_paths"), F.expr("l_orderkey % 2").alias("label"), F.expr("CASE WHEN l_orderkey % 4 < 2 THEN 'train' ELSE 'val' END").alias("split"))
    return lists.training_rows(rows, "train", "/root").select(F.get("paths", F.lit(0)).alias("first_path"), "label")
