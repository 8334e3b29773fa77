"""The corpus pipeline: STAGES over `documents`, each written as Parquet and read again as the next one's input.

Defined results. Null and empty texts go through as their stages define: the classifier gives them the labels' share of good rows, all of them
are equal, so one is left, and they weigh nothing in the mix. Of equal and near-equal texts the row of the rank that the stage defines stays, one exactly, also where rows
repeat a doc_id or have none. The mix repeats rows. Columns of documents stay in all stages, whatever their names; `ids`, `n_pieces` and `decoded` are replaced by
the last. An empty table gives no rows. Each stage reads what the one before it wrote, so a lost executor costs tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import exact_dedup, mixing, near_copies, quality_classifier, sentencepiece_codec
from tributary.plans.lineage import new_folder, removed, workspace


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by 5-word shingles and a similarity of 0.8."""
    return near_copies.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, the number of pieces, and the text the ids decode to."""
    return sentencepiece_codec.encode_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier, fingerprints and pieces can't be said in SQL. tests/llm/test_pipeline.py holds run()'s rows against a plain Python version of the stages after
#: the classifier, whose scores tests/llm/test_plain_versions.py recomputes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`. What a stage returns is written below the folder that the cluster shares, and kept until the next stage is written; what a stage
    saves on its way is removed with it. The last stage's rows are kept until the application ends. After an error nothing is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    try:
        for k, (_, stage) in enumerate(STAGES):
            with workspace(spark):
                stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                removed(spark, f"{folder}/{k - 1}")
    except BaseException:
        removed(spark, folder)
        raise
    return docs
