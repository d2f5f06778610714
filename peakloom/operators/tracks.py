"""Coverage tracks at several zooms: summaries of windows, each level made from the one below."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialise

#: Base pairs of the finest level's windows, how many of them a window of the next level has, and the number of levels.
BASE, FACTOR, LEVELS = 1024, 4, 8
SUMMARY = ("covered", "low", "high", "total", "squares")


def windows(coverage: DataFrame, base: int = BASE) -> DataFrame:
    """Stretches (chrom, start, end, depth) summed up by windows: chrom, window, and for the covered base pairs their number (covered), least and greatest depth (low, high), its sum and sum of squares (total, squares)."""
    cut = coverage.withColumn("window", F.explode(F.expr(f"sequence(start div {base}, (end - 1) div {base})")))
    n = F.least("end", (F.col("window") + 1) * base) - F.greatest("start", F.col("window") * base)
    sums = {"covered": F.sum("n"), "low": F.min("depth"), "high": F.max("depth"), "total": F.sum(F.col("n") * F.col("depth")), "squares": F.sum(F.col("n") * F.col("depth") * F.col("depth"))}
    return cut.withColumn("n", n).groupBy("chrom", "window").agg(*(x.alias(c) for c, x in sums.items()))


def coarser(level: DataFrame, factor: int = FACTOR) -> DataFrame:
    """The windows of the level above."""
    sums = {"covered": F.sum, "low": F.min, "high": F.max, "total": F.sum, "squares": F.sum}
    return level.groupBy("chrom", F.expr(f"window div {factor}").alias("window")).agg(*(f(c).alias(c) for c, f in sums.items()))


def write_zooms(coverage: DataFrame, path: str, base: int = BASE, factor: int = FACTOR, levels: int = LEVELS) -> None:
    """Writes a pyramid of windows to a folder, a part for each level, each dealt and sorted by place."""
    level = materialise(windows(coverage, base))
    for k in range(levels):
        span = base * factor**k
        rows = level.select("chrom", (F.col("window") * span).alias("start"), ((F.col("window") + 1) * span).alias("end"), *SUMMARY)
        rows.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").write.parquet(f"{path}/level={k}/span={span}")
        level = materialise(coarser(level, factor)) if k + 1 < levels else level


def spans(spark: SparkSession, path: str) -> list[int]:
    """The base pairs of the levels' windows."""
    return sorted(int(r.span) for r in spark.read.parquet(path).select("span").distinct().collect())


def view(spark: SparkSession, path: str, chrom: str, start: int, end: int, most: int = 1000, known: list[int] | None = None) -> DataFrame:
    """The windows of a stretch at the finest level that shows it in at most `most` of them (the coarsest if none does); only that level is read."""
    every = known or spans(spark, path)
    span = next((s for s in every if (end - start) / s <= most), every[-1])
    return spark.read.parquet(path).filter((F.col("span") == span) & (F.col("chrom") == chrom) & (F.col("start") < end) & (F.col("end") > start)).drop("level")


def mean_depth() -> Column:
    return F.col("total") / F.col("covered")


def spread() -> Column:
    """The standard deviation of the depth over covered base pairs."""
    return F.sqrt(F.greatest(F.lit(0.0), F.col("squares") / F.col("covered") - mean_depth() * mean_depth()))
