"""Peaks: calling, merging, accessibility and specificity over clusters."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..config import DEFAULT, Config
from ..functions import scalars as S
from ..storage import materialise
from .features import reached, shared_sums
from .intervals import coverage, interval_join, merged, suppressed


def resized(peaks: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Peaks around their summits (offsets from the start), clamped at 0; the new summit is always the half width."""
    at = F.col("start") + F.col("summit")
    half = config.peak_half
    return peaks.withColumns({"start": F.greatest(F.lit(0), at - half), "end": at + half, "summit": F.lit(half).cast("long")})


def merge_peaks(peaks: DataFrame, tie: str = "name") -> DataFrame:
    """Peaks of all clusters, resized, the most significant of each group of overlapping ones, and named p0, p1, ...

    Names follow chromosomes, groups and the order in which peaks were taken. They are ranked in two levels.
    """
    kept = suppressed(resized(peaks), "pvalue", ["start", "end", tie])
    sizes = kept.groupBy("chrom", "island").agg(F.count("*").alias("n"))
    in_chrom = Window.partitionBy("chrom").orderBy("island").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("chrom", "island", F.coalesce(F.sum("n").over(in_chrom), F.lit(0)).alias("__in"))
    chroms = sizes.groupBy("chrom").agg(F.sum("n").alias("n")).select("chrom", F.coalesce(F.sum("n").over(Window.orderBy("chrom").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__of"))
    named = kept.join(starts, ["chrom", "island"]).join(chroms, "chrom").withColumn("id", F.col("__of") + F.col("__in") + F.col("rank"))
    return named.withColumn("name", F.concat(F.lit("p"), F.col("id").cast("string"))).drop("__in", "__of", "island", "rank", "id")


def without_blacklisted(peaks: DataFrame, blacklist: DataFrame) -> DataFrame:
    return interval_join(peaks, blacklist.select("chrom", "start", "end"), "anti")


def genome_size(chrom_sizes: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return chrom_sizes.agg(F.floor(config.genome_share * F.sum("length")).cast("long").alias("gsize"))


@F.pandas_udf(DoubleType())
def poisson_tail(n: pd.Series, rate: pd.Series) -> pd.Series:
    """-log10 of the chance of n or more events at a rate."""

    def one(k: float, r: float) -> float:
        if k <= 0:
            return 0.0
        log_term = -r + k * math.log(r) - math.lgamma(k + 1)
        total, term, i = 1.0, 1.0, k
        if k <= r:
            below = sum(math.exp(-r + j * math.log(r) - math.lgamma(j + 1)) for j in range(int(k)))
            return -math.log10(max(1 - below, 1e-300))
        while term > 1e-17 * total and i < k + 10_000:
            i += 1
            term *= r / i
            total += term
        return -(log_term + math.log(total)) / math.log(10)

    return pd.Series([one(float(k), float(r)) for k, r in zip(n, rate, strict=True)], dtype=float)


def call_peaks(sites: DataFrame, gsize: int, by: str = "cluster", config: Config = DEFAULT, local: int | tuple[int, ...] = 10_000, least: int = 2) -> DataFrame:
    """Peaks of each cluster: sites are shifted and extended, stretches of coverage tested against a Poisson background
    (the genome's rate, or that of the surrounding `local` bases, of one width or several, whichever is highest), corrected by Benjamini and Hochberg and merged.

    Columns: by, chrom, start, end, summit (offset), signal (depth), pvalue and qvalue (-log10).
    """
    at = F.when(F.coalesce("strand", F.lit(True)), F.col("start") + config.peak_shift).otherwise(F.col("end") - config.peak_shift - config.peak_extend)
    tags = sites.select(by, "chrom", F.greatest(F.lit(0), at).alias("start"), (at + config.peak_extend).alias("end")).filter("end > start")
    tags = materialise(tags)
    keyed = tags.withColumn("chrom", F.concat_ws("\t", by, "chrom"))
    depth = coverage(keyed).filter(F.col("depth") >= least)
    totals = tags.groupBy(by).agg(F.count("*").alias("total"))
    d = depth.withColumn(by, F.split("chrom", "\t")[0]).join(totals, by)
    rates = [F.col("total") * config.peak_extend / float(gsize), F.lit(1e-9)]
    for width in (local,) if isinstance(local, int) else local:
        near = keyed.groupBy("chrom", F.floor(F.col("start") / width).alias("w")).agg(F.count("*").alias(f"near{width}"))
        d = d.withColumn("w", F.floor(F.col("start") / width)).join(near, ["chrom", "w"], "left").drop("w")
        rates.append(F.coalesce(f"near{width}", F.lit(0)) * config.peak_extend / float(width))
    rate = F.greatest(*rates)
    d = materialise(d.select(by, "chrom", "start", "end", "depth", F.bround(rate, 6).alias("rate")))
    law = d.select(by, "depth", "rate").distinct()
    d = d.join(law.withColumn("pvalue", poisson_tail(F.col("depth").cast("double"), "rate")), [by, "depth", "rate"])
    d = materialise(d)
    # Benjamini and Hochberg over distinct p-values, each weighed by the bases that have it.
    bases = d.groupBy(by, "pvalue").agg(F.sum(F.col("end") - F.col("start")).alias("m"))
    down = Window.partitionBy(by).orderBy(F.desc("pvalue"))
    up = Window.partitionBy(by).orderBy("pvalue")
    q = F.col("pvalue") - F.log10(F.lit(float(gsize)) / F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    bases = bases.withColumn("q", q).withColumn("qvalue", F.max("q").over(up.rowsBetween(Window.unboundedPreceding, 0)))
    hits = materialise(d.join(bases.select(by, "pvalue", "qvalue"), [by, "pvalue"]).filter(F.col("qvalue") >= -math.log10(config.peak_q)))
    regions = merged(hits.select("chrom", "start", "end"))
    best = interval_join(regions.select("chrom", "start", "end"), hits.select("chrom", "start", "end", "depth", "pvalue", "qvalue"))
    top = F.max_by(F.struct("r_start", "r_end", "depth", "pvalue", "qvalue"), F.struct(F.round("pvalue", 9), -F.col("r_start")))
    out = best.groupBy("chrom", "start", "end").agg(top.alias("t"))
    summit = F.expr("(t.r_start + t.r_end) div 2") - F.col("start")
    return out.select(F.split("chrom", "\t")[0].alias(by), F.split("chrom", "\t")[1].alias("chrom"), "start", "end", summit.alias("summit"), F.col("t.depth").cast("double").alias("signal"), "t.pvalue", "t.qvalue")


def relative_accessibility(matrix: DataFrame, clusters: DataFrame, feature: str = "feature", cell: str = "barcode", config: Config = DEFAULT) -> DataFrame:
    """(cluster, feature, ras): the share of a cluster's cells that are open at a feature, per 1000 open features of a cell, scaled."""
    open_ = matrix.filter("count > 0").join(clusters.select(cell, "cluster"), cell)
    n = clusters.groupBy("cluster").agg(F.count("*").alias("cells"))
    depth = open_.groupBy("cluster").agg((F.count("*") / F.countDistinct(cell)).alias("depth"))
    share = open_.groupBy("cluster", feature).agg(F.countDistinct(cell).alias("open")).join(n, "cluster").join(depth, "cluster")
    return share.select("cluster", feature, (F.col("open") / F.col("cells") * 1000.0 / F.col("depth") * config.accessibility_scale).alias("ras"))


def _shared_accessibility(sites: DataFrame, regions: DataFrame, clusters: DataFrame, feature: str, cell: str, config: Config) -> tuple[DataFrame, DataFrame]:
    """(cluster, __of, ras) and (__of, feature), as shared_sums has them: open cells are counted by different region and cluster where they meet."""
    named = clusters.groupBy(cell, "cluster").agg(F.count("*").alias("__m"))
    of = sites.select(cell, "chrom", "start", "end", "strand").join(named, cell)
    sums, members = shared_sums(of, regions, feature, cell, ("cluster", "__m"))
    met = materialise(sums.select("__of", "cluster", "__m", "cells"))
    open_ = met.groupBy("cluster", "__of").agg(F.sum("cells").alias("open"))
    n = clusters.groupBy("cluster").agg(F.count("*").alias("cells"))
    some = reached(sites, regions, cell).join(named, cell).groupBy("cluster").agg(F.count("*").alias("reached"))
    links = met.join(members.groupBy("__of").agg(F.count("*").alias("__size")), "__of").groupBy("cluster").agg(F.sum(F.col("cells") * F.col("__m") * F.col("__size")).alias("links"))
    depth = links.join(some, "cluster").select("cluster", (F.col("links") / F.col("reached")).alias("depth"))
    share = open_.join(n, "cluster").join(depth, "cluster")
    return share.select("cluster", "__of", (F.col("open") / F.col("cells") * 1000.0 / F.col("depth") * config.accessibility_scale).alias("ras")), members


def accessibility_of_sites(sites: DataFrame, regions: DataFrame, clusters: DataFrame, feature: str = "feature", cell: str = "barcode", config: Config = DEFAULT) -> DataFrame:
    """relative_accessibility of the counts of sites in regions, without a matrix."""
    ras, members = _shared_accessibility(sites, regions, clusters, feature, cell, config)
    return ras.join(members, "__of").select("cluster", feature, "ras")


def specificity_of_sites(sites: DataFrame, regions: DataFrame, clusters: DataFrame, feature: str = "feature", cell: str = "barcode", config: Config = DEFAULT) -> DataFrame:
    """specificity of accessibility_of_sites, made once for equal regions."""
    ras, members = _shared_accessibility(sites, regions, clusters, feature, cell, config)
    return specificity(ras, "__of").join(members, "__of").select("cluster", feature, "ss")


def specificity(ras: DataFrame, feature: str = "feature") -> DataFrame:
    """(cluster, feature, ss): 1 - the square root of the Jensen-Shannon divergence between a feature's law over
    clusters and the law that has only this cluster (1: only there)."""
    x = ras.withColumn("v", S.specificity_input(F.col("ras")))
    total = F.sum("v").over(Window.partitionBy(feature))
    p = x.withColumn("p", F.when(total > 0, F.col("v") / total).otherwise(0.0))
    entropy = F.sum(F.when(F.col("p") > 0, -F.col("p") * F.log2("p")).otherwise(0.0)).over(Window.partitionBy(feature))
    half = F.col("p") / 2
    # H((p + e) / 2): the entropy of p halved in all places but this one.
    others = (F.col("h") - F.when(F.col("p") > 0, -F.col("p") * F.log2("p")).otherwise(0.0)) / 2 + (1 - F.col("p")) / 2
    own = -(half + 0.5) * F.log2(half + 0.5)
    js = F.greatest(F.lit(0.0), others + own - F.col("h") / 2)
    return p.withColumn("h", entropy).select("cluster", feature, (1 - F.sqrt(js)).alias("ss"))


def null_cdf(values: DataFrame, column: str, step: float, top: float) -> DataFrame:
    """One row: cdf, the share of values beyond each multiple of step up to top, and n."""
    n = math.ceil(top / step)
    edges = values.select(F.least(F.lit(n - 1), F.floor(F.col(column) / step)).cast("int").alias("at")).groupBy("at").agg(F.count("*").alias("k"))
    table = values.sparkSession.range(n).select(F.col("id").cast("int").alias("at")).join(edges, "at", "left").withColumn("k", F.coalesce("k", F.lit(0)))
    both = table.agg(F.array_sort(F.collect_list(F.struct("at", "k"))).alias("t"), F.sum("k").alias("n"))
    beyond = F.transform("t", lambda x: F.aggregate(F.filter("t", lambda y: y["at"] > x["at"]), F.lit(0).cast("long"), lambda a, y: a + y["k"]) / F.col("n"))
    return both.select(beyond.alias("cdf"), "n")


def with_empirical_p(scores: DataFrame, null: DataFrame, column: str, step: float) -> DataFrame:
    met = scores.crossJoin(F.broadcast(null))
    return met.withColumn("p", S.empirical_p(F.col(column), F.col("cdf"), F.lit(step), F.col("n"))).drop("cdf", "n")


def enrichment(reference: DataFrame, query: DataFrame) -> DataFrame:
    """Each reference peak with the highest signal and significance of query peaks on it, 0 where there is none."""
    met = interval_join(reference.select("chrom", "start", "end").distinct(), query.select("chrom", "start", "end", "signal", "pvalue"), "left")
    best: dict[str, Column] = {x: F.coalesce(F.max(x), F.lit(0.0)).alias(x) for x in ("signal", "pvalue")}
    out = met.groupBy("chrom", "start", "end").agg(*best.values())
    return out.withColumn("chi2", S.chi2_quantile(F.pow(F.lit(10.0), -F.col("pvalue"))))


def tag_counts(sites: DataFrame) -> DataFrame:
    return sites.groupBy("cluster").agg(F.count("*").alias("tags"))


def open_regions(sites: DataFrame, half: int = DEFAULT.open_half) -> DataFrame:
    """The union of windows around all covered positions."""
    spots = sites.select("chrom", F.col("start").alias("p")).distinct()
    return merged(spots.select("chrom", F.greatest(F.lit(0), F.col("p") - half).alias("start"), (F.col("p") + half).alias("end"))).select("chrom", "start", "end")
