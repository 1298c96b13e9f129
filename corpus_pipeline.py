"""A training corpus from raw documents: five stages, each over everything that the one before it kept.

Every stage takes null and empty texts, texts of any length, repeated rows, null ids, an empty table and columns of any
other name; what it does with them is stated at its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.llm import line_dedup, mixing, near_dedup, packing, quality
from reelmill.shared import release, stored, written

#: A document is rejected if its probability of being of quality is under this.
MIN_QUALITY = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels outside the held-out third, does not reject.

    A null or empty text is rejected if a text of no words is; columns of docs come back as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels)
    score = "_score"
    while score in docs.columns:
        score += "_"
    return quality.score(docs, model, "text", score).where(F.col(score) >= MIN_QUALITY).select(*(F.col(f"`{c}`") for c in docs.columns))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines that stand earlier in the corpus; a document that has no line left goes, null and empty texts stay."""
    return line_dedup.deduplicated(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates (five words, similarity of 0.8); null and empty texts stay."""
    return near_dedup.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The Pfair mixture: every document, and those of small sources again until the target weights are met."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048; a null or empty text is a piece of one token."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier, the schedule and the packing can't be written in SQL; the tests hold each stage's rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written before the next one reads it, and its own tables go then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = written()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k}")
            release(spark, but=1, since=before)
    return docs
