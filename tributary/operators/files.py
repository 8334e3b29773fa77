"""Class folders and file names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.rank import global_rank
from tributary.plans.lineage import saved


def class_index(df: DataFrame, folder: str) -> DataFrame:
    """`df` with class_index, the rank of the folder's name from 0."""
    names = saved(df.select(F.col(folder).alias("__folder")).filter("__folder IS NOT NULL").distinct())
    names = global_rank(names, [F.col("__folder")], "__rank")
    return df.join(names, df[folder] == names["__folder"], "left").withColumn("class_index", F.col("__rank") - 1).drop("__folder", "__rank")
