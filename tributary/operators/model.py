"""The non-private boosted-tree baseline and its scores."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Cells of a part of the training rows at most; a row has one for each feature and four for what is kept beside them. Each step of boosting reads a part's rows whole, in several kept forms: with four features some 250 bytes a row.
CELLS_A_PART = 4_000_000


def evened(df: DataFrame, rows_a_part: int) -> DataFrame:
    """The rows in parts of about so many each, if any part has more: files, and row groups above all, are read in parts that grow with them.

    Dealt rows are sorted within their parts, by a hash of their columns, as an exchange delivers them in any order and the library draws by place.
    """
    most, rows = df.groupBy(F.spark_partition_id().alias("part")).count().agg(F.max("count"), F.sum("count")).first()
    return df.repartition(-(-rows // rows_a_part)).sortWithinPartitions(F.xxhash64(*df.columns)) if most and most > rows_a_part else df


def gbt_baseline(train: DataFrame, features: list[str], label: str, trees: int = 10, depth: int = 4, step: float = 0.1, subsample: float = 1.0, positive_weight: float = 1.0, seed: int = 42) -> Model:
    """Boosted trees; positive_weight is the weight of class 1.

    Rows are counted first, and dealt out evenly if a part of them has too many. The library draws the rows that borders come from, and those of a subsample, part by part, so trees can differ with the parts.
    """
    needed = evened(train.select(*dict.fromkeys([*features, label])), max(1, CELLS_A_PART // (4 + len(features))))
    weighed = needed.withColumns({"__weight": F.when(F.col(label) == 1, float(positive_weight)).otherwise(1.0), "__label": F.col(label).cast("double")})
    trees_ = GBTClassifier(featuresCol="__features", labelCol="__label", weightCol="__weight", maxIter=trees, maxDepth=depth, stepSize=step, subsamplingRate=subsample, seed=seed)
    return trees_.fit(assembled(weighed, features))


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="keep").transform(df)


def score_table(model: Model, df: DataFrame, features: list[str], key: str, label: str) -> DataFrame:
    """id, label, score."""
    scored = model.transform(assembled(df, features))
    return scored.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"), F.get(vector_to_array("probability"), 1).alias("score"))
