"""The queries opN_<name> and the SQL that some of them are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.llm.exact_dedup import exact_dedup
from reelmill.llm.fingerprints import fingerprints
from reelmill.llm.line_dedup import line_dedup
from reelmill.llm.lm_scoring import lm_scores
from reelmill.llm.mixing import mix
from reelmill.llm.near_dedup import near_dedup
from reelmill.llm.packing import pack
from reelmill.llm.quality import quality_scores
from reelmill.llm.secret_scan import secret_scan
from reelmill.llm.substring_dedup import substring_dedup


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_documents(spark, sf_dir))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_documents(spark, sf_dir), k=3, percent=85)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_documents(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_documents(spark, sf_dir))


def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of op9 what SQL can say as well."""
    return secret_scan(_documents(spark, sf_dir), words=0).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def edited_text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of op6 what SQL can say as well."""
    return fingerprints(_documents(spark, sf_dir)).select("doc_id", "n_chars", "edited_sha256")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_source_mixing": op3_source_mixing,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_simhash_fingerprints": op6_simhash_fingerprints,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_secret_scan": op9_secret_scan,
    "op10_exact_dedup": op10_exact_dedup,
    "secret_base_spans": secret_base_spans,
    "edited_text_digests": edited_text_digests,
}

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

ORACLE_SQL = {
    "op1_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), runs AS (
            SELECT doc_id, unnest(range(1, len(words) - 48)) AS pos, words FROM w WHERE len(words) >= 50
        ), hashed AS (
            SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS run FROM runs
        ), firsts AS (
            SELECT run, min(doc_id) AS first FROM hashed GROUP BY run HAVING min(doc_id) < max(doc_id)
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM hashed JOIN firsts USING (run) WHERE doc_id > first
        ), lists AS (SELECT doc_id, list(pos) AS gone_at, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed,
            sha256(coalesce(array_to_string(list_filter(words, lambda x, i: gone_at IS NULL OR NOT list_contains(gone_at, i)), ' '), '')) AS kept_sha256
        FROM w LEFT JOIN lists USING (doc_id)
    """,
    "op2_line_dedup": r"""
        WITH w AS (
            SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents
        ), l AS (
            SELECT doc_id, lines, pos, length(lines[pos]) AS a, length(lines[pos + 1]) AS b, length(lines[pos + 2]) AS c
            FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM w)
        ), n AS (
            SELECT doc_id, lines, pos, CASE WHEN a >= 40 THEN 1 WHEN a + b >= 40 THEN 2 WHEN a + b + c >= 40 THEN 3 ELSE 4 END AS n FROM l
        ), windows AS (
            SELECT doc_id, lines, pos, n FROM n WHERE pos + n - 1 <= len(lines)
        ), runs AS (
            SELECT * FROM windows UNION ALL
            SELECT doc_id, lines, 1, len(lines) FROM w WHERE len(lines) > 0 AND doc_id NOT IN (SELECT doc_id FROM windows)
        ), later AS (
            SELECT doc_id, pos, n FROM (
                SELECT doc_id, pos, n, row_number() OVER (PARTITION BY md5(array_to_string(lines[pos:pos + n - 1], chr(10))), n ORDER BY doc_id, pos) AS k FROM runs
            ) WHERE k > 1
        ), gone AS (SELECT doc_id, list(DISTINCT l) AS ls FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS l FROM later) GROUP BY doc_id)
        SELECT doc_id, len(lines) AS n_lines, coalesce(len(ls), 0) AS n_removed,
            sha256(coalesce(array_to_string(list_filter(lines, lambda x, i: ls IS NULL OR NOT list_contains(ls, i)), chr(10)), '')) AS kept_sha256
        FROM w LEFT JOIN gone USING (doc_id)
    """,
    "op7_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, shingle FROM (
                SELECT doc_id, unnest(CASE
                    WHEN len(words) = 0 THEN []
                    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                    ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS shingle
                FROM w)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 85 * (x.n + y.n - met)
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM w UNION SELECT doc_id, b FROM reach JOIN links ON a = other
        ), c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM c LEFT JOIN n USING (doc_id)
    """,
    "secret_base_spans": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        found AS (
            SELECT doc_id, 0 AS ord, 'assign' AS kind, regexp_extract_all(t, '{_ASSIGN}') AS ms, regexp_split_to_array(t, '{_ASSIGN}') AS ps FROM d
            UNION ALL SELECT doc_id, 1, 'access', regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_split_to_array(t, 'AKIA[A-Z0-9]+') FROM d
            UNION ALL SELECT doc_id, 2, 'hex', regexp_extract_all(t, '[0-9a-f]{{24,}}'), regexp_split_to_array(t, '[0-9a-f]{{24,}}') FROM d
        ), one AS (SELECT doc_id, ord, kind, ms, ps, unnest(range(1, len(ms) + 1)) AS k FROM found WHERE len(ms) > 0),
        spans AS (
            SELECT doc_id, ord, kind, ms[k] AS m, list_sum(list_transform(ps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0) AS start FROM one
        ), kept AS (
            SELECT * FROM spans WHERE CASE ord WHEN 0 THEN length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6 WHEN 1 THEN length(m) >= 20 ELSE true END
        ), g AS (
            SELECT doc_id, count(*) FILTER (ord = 0) AS a, count(*) FILTER (ord = 1) AS c, count(*) FILTER (ord = 2) AS h,
                string_agg(kind || ':' || start::BIGINT || ':' || (start + length(m))::BIGINT, ',' ORDER BY start, ord) AS j FROM kept GROUP BY doc_id
        )
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(j, '')) AS base_sha256 FROM d LEFT JOIN g USING (doc_id)
    """,
    "edited_text_digests": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, lead(coalesce(text, '')) OVER (ORDER BY doc_id) AS n, first_value(coalesce(text, '')) OVER (ORDER BY doc_id) AS f FROM documents),
        e AS (SELECT doc_id, t, coalesce(n, f) AS after, length(t) AS n, length(t) // 4 AS q FROM d)
        SELECT doc_id, n AS n_chars, sha256(CASE WHEN q = 0 THEN t ELSE substr(t, 1, n - q) || substr(after, 1, q) END) AS edited_sha256 FROM e
    """,
    "op10_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        ), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM d JOIN g USING (norm)
    """,
}
