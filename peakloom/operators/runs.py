"""Runs of adjacent rows with equal keys, in the order of a file: what grouping as a stream goes by gives, and equal to grouping by key if the file is sorted by it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise, running, small


def runs(df: DataFrame, key: str, order: str) -> DataFrame:
    """df with run: a number, from 0, shared by adjacent rows (by order, whose values differ) of one key; null keys are equal to each other.

    Rows are dealt by ranges of the order. Whether a range's first row goes on with a run is known from the last key of the range before it, which is a row per
    range; no task holds a run, however long it is.
    """
    dealt = materialise(df.repartitionByRange(order).withColumn("__part", F.spark_partition_id()))
    ends = dealt.groupBy("__part").agg(F.max_by(F.struct(F.col(key).alias("k")), order).alias("last"))
    before = ends.select("__part", F.lag("last").over(Window.orderBy("__part")).alias("__before"))  # a row per range
    within = Window.partitionBy("__part").orderBy(order)
    own = F.struct(F.col(key).alias("k"))
    earlier = F.coalesce(F.lag(own).over(within), F.col("__before"))
    flagged = dealt.join(small(materialise(before)), "__part").withColumn("__new", F.when(earlier.isNotNull() & earlier["k"].eqNullSafe(F.col(key)), 0).otherwise(1))
    counted = running(flagged.drop("__before", "__part"), [], [order], "__run", "__new")
    return counted.withColumn("run", F.col("__run") + F.col("__new") - 1).select(*df.columns, "run")
