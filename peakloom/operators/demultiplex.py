"""From index reads to barcodes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import scalars as S


def barcode_counts(index: DataFrame, k: int, config: Config = DEFAULT) -> DataFrame:
    """(barcode, n) of the first k bases of the first index reads of each file (by their number n in it, where index has that), most frequent first."""
    first = index.filter(F.col("n") < config.index_reads) if "n" in index.columns else index
    return first.groupBy(F.substring("seq", 1, k).alias("barcode")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "barcode")


def rank_curve(counts: DataFrame) -> DataFrame:
    """(rank, n): the ends of each plateau of the rank curve, from counts of counts."""
    per = counts.groupBy("n").agg(F.count("*").alias("m"))
    upto = F.sum("m").over(Window.orderBy(F.desc("n")))
    ends = per.select("n", "m", upto.alias("last"))
    both = ends.select("n", F.explode(F.array_distinct(F.array(F.col("last") - F.col("m") + 1, F.col("last")))).alias("rank"))
    return both.select("rank", "n")


def threshold(counts: DataFrame) -> int:
    """The number of barcodes to keep, by the plateau ends of the rank curve (as many as there are distinct counts)."""
    curve = [(r.rank, r.n) for r in rank_curve(counts).orderBy("rank").collect()]
    if len(curve) < 3:
        return curve[-1][0] if curve else 0
    (r0, n0), (r1, n1) = curve[0], curve[-1]
    dx, dy = math.log10(r1) - math.log10(r0), math.log10(max(n1, 1)) - math.log10(max(n0, 1))
    return max(curve, key=lambda c: dx * (math.log10(max(c[1], 1)) - math.log10(max(n0, 1))) - dy * (math.log10(c[0]) - math.log10(r0)))[0]


def corrections(counts: DataFrame, keep: int) -> DataFrame:
    """(observed, barcode): the most frequent barcodes, and what is one base from exactly one of them."""
    good = counts.orderBy(F.desc("n"), "barcode").limit(keep).select("barcode")
    places = F.sequence(F.lit(1), F.length("barcode"))
    variants = F.flatten(F.transform(places, lambda i: F.transform(F.array(*map(F.lit, "ACGTN")), lambda b: F.overlay("barcode", b, i, F.lit(1)))))
    near = good.select("barcode", F.explode(F.array_distinct(variants)).alias("observed")).filter("observed <> barcode")
    near = near.join(good.select(F.col("barcode").alias("observed")), "observed", "left_anti")
    one = near.groupBy("observed").agg(F.min("barcode").alias("barcode"), F.count("*").alias("n")).filter("n = 1").select("observed", "barcode")
    return good.select(F.col("barcode").alias("observed"), "barcode").unionByName(one)


def demultiplexed(reads: DataFrame, index: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """Reads (by file and number with their index read) renamed barcode:id; reads without a known barcode are left out."""
    keyed = index.select("n", F.substring("seq", 1, k).alias("observed"))
    return reads.join(keyed, "n").join(table, "observed").withColumn("id", S.tagged(F.col("barcode"), F.col("id"))).select("n", "id", "seq", "quality")


def demultiplexed_files(spark: SparkSession, index: str | list[str], reads: list[str | list[str]], k: int, keep: int | None = None) -> list[DataFrame]:
    """The reads of each file set, named by the corrected barcodes of the index reads of the same number in the file of the same rank.

    keep: the number of barcodes; None: as many as the rank curve's threshold says.
    """
    from ..sources.tables import read_fastq

    def ranked(path: str | list[str]) -> DataFrame:
        df = read_fastq(spark, path)
        rank = df.select("file").distinct().select("file", F.row_number().over(Window.orderBy(F.substring_index("file", "/", -1), "file")).alias("f"))  # a row per file
        return df.join(F.broadcast(rank), "file").withColumn("n", F.struct("f", "n"))

    own = ranked(index)
    counts = barcode_counts(own.select("seq", F.col("n.n").alias("n")), k)
    table = corrections(counts, threshold(counts) if keep is None else keep)
    return [demultiplexed(ranked(path), own, table, k) for path in reads]
