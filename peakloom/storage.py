"""Tables in the folder that driver and executors share, and ranks and running sums made in two levels."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A table is broadcast only if it has at most this many rows; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Bytes of a row group, which a task that writes holds in memory.
ROW_GROUP = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of the warehouse where that is unset (tests). On a cluster a warehouse on the driver's own disk is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and re.match(r"/|file:", warehouse):
        raise ValueError(f"executors don't share {warehouse}: set spark.checkpoint.dir")
    return f"{warehouse}/scratch"


#: The tables that this driver has written to the shared folder and not deleted.
_made: list[str] = []


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has yet."""
    _made.append(f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}")
    return _made[-1]


def materialise(df: DataFrame, **options: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back, which cuts its lineage and fixes its row ids."""
    path = new_path(df.sparkSession)
    df.write.options(**{"parquet.block.size": str(ROW_GROUP), **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def made() -> list[str]:
    """The intermediate tables that exist now."""
    return list(_made)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes intermediate tables: for those that nothing reads any more."""
    for path in paths:
        if path in _made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
            _made.remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that are made inside are deleted at the end: what was made lazily from them has to be used inside."""
    before = set(made())
    try:
        yield
    finally:
        discard(spark, [p for p in made() if p not in before])


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if it is known to have few rows, otherwise df as it is."""
    n = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def running(df: DataFrame, group: list[str], order: list[str | Column], into: str, value: str | None = None, ranges: int | None = None) -> DataFrame:
    """df with the sum of value (None: the number of rows) over the rows of its group before it, in order, ties in any order.

    Rows are dealt by ranges of group and order (the first `ranges` columns of it), and sums are made in two levels, within a range and over the ranges' sums, of which
    there are as many as partitions: no task holds a hot group, or all rows where group is empty.
    """
    n = F.lit(1).cast("long") if value is None else F.col(value)
    dealt = materialise(df.repartitionByRange(*group, *order[:ranges]).withColumn("__part", F.spark_partition_id()))
    keys = [F.col(f"`{g}`").alias(f"__g{i}") for i, g in enumerate(group)]
    sums = dealt.groupBy("__part", *keys).agg(F.sum(n).alias("__sum"))
    before = Window.partitionBy(*(f"__g{i}" for i in range(len(group)))).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).withColumnRenamed("__part", "__p").drop("__sum")
    starts = small(materialise(starts))
    within = Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("__own", F.coalesce(F.sum(n).over(within), F.lit(0)))
    met = own["__part"] == starts["__p"]
    for i, g in enumerate(group):
        met &= own[g].eqNullSafe(starts[f"__g{i}"])
    return own.join(starts, met).withColumn(into, F.col("__start") + F.col("__own")).select(*df.columns, into)
