"""Fragments that arrive as files: distinct fragments and per-cell counts, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.tables import BED


def fragment_stream(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    """A stream of the BED files that appear in a folder, with arrived, the time of the file."""
    options = {"sep": "\t", **({"maxFilesPerTrigger": files} if files else {})}
    df = spark.readStream.schema(BED).options(**options).csv(folder)
    return df.select("chrom", "start", "end", F.col("name").alias("barcode"), "score", F.col("_metadata.file_modification_time").alias("arrived"))


def cell_counts(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """(barcode, uniq, mito_rate) of distinct fragments so far, for output mode update or complete.

    A fragment is known for `delay` after it arrived first, so what is kept of fragments is bounded by what arrives in that time; a copy that
    comes later counts again. What is kept of cells is a row each.
    """
    distinct = stream.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["barcode", "chrom", "start", "end"])
    mito = F.count_if(S.is_mitochondrial(F.col("chrom")))
    return distinct.groupBy("barcode").agg((F.count("*") - mito).alias("uniq"), (mito / F.count("*")).alias("mito_rate"))
