"""Clusters of cells: names, sizes, compositions, subclusters, metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import scalars as S
from ..storage import small


def sizes(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cluster").agg(F.count("*").alias("n"))


def named_by_size(cells: DataFrame, first: str = "barcode") -> DataFrame:
    """Cells with clusters renamed C1, C2, ... from the largest, ties by their first cell."""
    ranked = cells.groupBy("cluster").agg(F.count("*").alias("n"), F.min(first).alias("first"))
    ranked = ranked.select("cluster", F.concat(F.lit("C"), F.row_number().over(Window.orderBy(F.desc("n"), "first"))).alias("name"))
    return cells.join(small(ranked), "cluster").drop("cluster").withColumnRenamed("name", "cluster")


def without_small(cells: DataFrame) -> DataFrame:
    """Cells of clusters with at least max(10, min(50, cells div 1000)) members."""
    least = cells.agg(F.greatest(F.lit(10), F.least(F.lit(50), F.expr("count(*) div 1000"))).alias("least"))
    keep = sizes(cells).crossJoin(F.broadcast(least)).filter("n >= least").select("cluster")
    return cells.join(keep, "cluster", "left_semi")


def to_subcluster(cells: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return sizes(cells).filter(F.col("n") >= config.subcluster_cells)


def reproducible(subclusters: DataFrame, excluded: list[str] | None = None, config: Config = DEFAULT) -> DataFrame:
    """(parent, cluster, name): subclusters reproducible enough, or the only one of their parent, which takes its name."""
    s = subclusters if not excluded else subclusters.filter(~F.col("parent").isin(*excluded))
    n = F.count("*").over(Window.partitionBy("parent"))
    kept = s.withColumn("n", n).filter((F.coalesce("reproducibility", F.lit(1.0)) >= config.reproducibility) | (F.col("n") == 1))
    return kept.select("parent", "cluster", F.when(F.col("n") == 1, F.col("parent")).otherwise(S.renamed_cluster(F.col("parent"), F.col("cluster"))).alias("name"))


def combined(parents: DataFrame, subcells: DataFrame, kept: DataFrame, cell: str = "barcode") -> DataFrame:
    """(cell, cluster): cells by their kept subclusters, and those of parents that have none by their parent."""
    fine = subcells.join(kept, ["parent", "cluster"]).select(cell, F.col("name").alias("cluster"))
    rest = parents.join(subcells.select(F.col("parent").alias("cluster")).distinct(), "cluster", "left_anti").select(cell, "cluster")
    return fine.unionByName(rest)


def routed(sites: DataFrame, cells: DataFrame, cell: str = "barcode") -> DataFrame:
    """Sites with the cluster of their cell; a cell in two clusters is an error."""
    checked = cells.groupBy(cell).agg(F.min("cluster").alias("cluster"), F.count("*").alias("n"))
    one = F.when(F.col("n") == 1, F.col("cluster")).otherwise(F.raise_error(F.concat(F.lit("cell in several clusters: "), F.col(cell).cast("string"))))
    return sites.join(checked.select(cell, one.cast("string").alias("cluster")), cell)


def composition(cells: DataFrame) -> DataFrame:
    """(cluster, sample, n), also where n is 0."""
    grid = cells.select("cluster").distinct().crossJoin(cells.select("sample").distinct())
    return grid.join(cells.groupBy("cluster", "sample").agg(F.count("*").alias("n")), ["cluster", "sample"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _share(x: str, by: str):
    total = F.sum(x).over(Window.partitionBy(by))
    return F.when(total == 0, F.lit(0.0)).otherwise(F.col(x) / total)


def cluster_composition(cells: DataFrame) -> DataFrame:
    """The share of each sample's cells in each cluster."""
    return composition(cells).select("cluster", "sample", _share("n", "sample").alias("share"))


def tissue_composition(cells: DataFrame) -> DataFrame:
    """The share of each sample in each cluster, samples weighed alike, to three digits."""
    return cluster_composition(cells).select("cluster", "sample", S.round3(_share("share", "cluster")).alias("share"))


def metadata(cells: DataFrame, metrics: DataFrame, cell: str = "barcode") -> DataFrame:
    """What is exported of every clustered cell: names without the leading C, quality where known."""
    m = metrics.select(cell, "tsse", "uniq", "doublet", "mito_rate", "dup_rate")
    return cells.join(m, cell, "left").select(
        F.col(cell).alias("Sample+Barcode"), F.regexp_replace("cluster", "^.", "").alias("Cluster"), F.col("x").alias("UMAP1"), F.col("y").alias("UMAP2"),
        F.col("tsse").alias("TSSe"), F.col("uniq").alias("Num_fragments"), F.col("doublet").alias("Doublet_score"), F.col("mito_rate").alias("Fraction_Mito"), F.col("dup_rate").alias("Fraction_duplication"),
    )


def with_batches(cells: DataFrame, batches: DataFrame, cell: str = "cell") -> DataFrame:
    """Cells with batch (the batch's name and the replicate) and group of their experiment, null where unknown."""
    keyed = cells.withColumn("__e", S.experiment_of(F.col(cell))).withColumn("__r", S.replicate_of(F.col(cell)))
    b = batches.select(F.col("sample").alias("__e"), F.col("batch").alias("__b"), "group")
    return keyed.join(b, "__e", "left").withColumn("batch", F.concat("__b", "__r")).drop("__e", "__r", "__b")
