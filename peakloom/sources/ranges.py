"""Sites in a file set with a range index: a query over ranges reads only the groups of sites that it can meet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.intervals import interval_join
from ..storage import running

#: Sites of a group, which is a row of the index. A reader asks the files for at most STRETCHES runs of groups.
GROUP, STRETCHES = 16_384, 256
#: Base pairs by which queries meet the index, whose rows are long.
WIDE = 1 << 20


def write_ranges(sites: DataFrame, path: str, group: int = GROUP) -> None:
    """Writes sites (chrom, start, end and others) in order of place, and for each group of them and chromosome its least start and greatest end."""
    numbered = running(sites, [], ["chrom", "start", "end"], "__n").withColumn("group", F.expr(f"__n div {group}")).drop("__n")
    rows = numbered.repartitionByRange("group", "chrom", "start").sortWithinPartitions("group", "chrom", "start", "end")
    rows.write.option("parquet.block.size", str(1 << 20)).option("parquet.page.row.count.limit", "1000").parquet(f"{path}/sites")
    written = sites.sparkSession.read.parquet(f"{path}/sites")
    written.groupBy("group", "chrom").agg(F.min("start").alias("start"), F.max("end").alias("end")).write.parquet(f"{path}/index")


def groups(spark: SparkSession, path: str, queries: DataFrame) -> list[int]:
    """The groups that may hold a site of a range: a number for each GROUP sites at most."""
    index = spark.read.parquet(f"{path}/index")
    met = interval_join(queries.select("chrom", "start", "end").distinct(), index, width=WIDE)
    return sorted(r.group for r in met.select("group").distinct().collect())


def stretches(found: list[int], most: int = STRETCHES) -> list[tuple[int, int]]:
    """Groups as runs (first, last), the nearest joined until there are at most so many."""
    gaps = sorted(range(1, len(found)), key=lambda i: (found[i - 1] - found[i], i))  # the widest first
    cuts = sorted(i for i in gaps[: most - 1] if found[i] - found[i - 1] > 1)
    return [(found[a], found[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(found)], strict=True)] if found else []


def sites_near(spark: SparkSession, path: str, queries: DataFrame) -> DataFrame:
    """The sites of the groups that queries can meet; others are left in the files."""
    runs = stretches(groups(spark, path, queries))
    asked = reduce(lambda a, b: a | b, (F.col("group").between(a, b) for a, b in runs), F.lit(False)) if runs else F.lit(False)
    return spark.read.parquet(f"{path}/sites").filter(asked)


def read_ranges(spark: SparkSession, path: str, queries: DataFrame, width: int = 4096) -> DataFrame:
    """interval_join(queries, sites), read from the groups that it needs."""
    return interval_join(queries, sites_near(spark, path, queries).drop("group"), width=width)


#: Sites for each task that counts what they meet.
COUNTED = 1 << 18


def counted(spark: SparkSession, path: str, queries: DataFrame, by: list[str]) -> DataFrame:
    """(by, n): the pairs of read_ranges, counted. They are dealt to tasks by the number of sites before they are counted, so that no task's table of counts grows with the sites."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-spark.read.parquet(f"{path}/sites").count() // COUNTED))
    return read_ranges(spark, path, queries).select(*by).repartition(tasks, *by).groupBy(*by).agg(F.count("*").alias("n"))
