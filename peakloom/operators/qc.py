"""Quality of cells: start-site enrichment, duplication, mitochondrial share, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config, QcCutoffs
from ..functions import scalars as S
from . import fragments as fr
from .intervals import interval_join


def tss_enrichment(fragments: DataFrame, promoters: DataFrame, cell: str = "barcode", config: Config = DEFAULT) -> DataFrame:
    """(cell, tsse) of the cells with cuts around start sites.

    The cuts of a cell around all promoters are counted by their offset from the promoter's start, divided by the cell's
    background (its mean count in both flanks, plus a pseudo-count), smoothed by a centred mean that is cut
    off at the ends, and the highest value is taken. Only offsets with cuts are kept, never the whole profile.
    """
    length, flank, taps = 2 * config.tss_half + 1, config.tss_flank, config.tss_taps
    sites = promoters.select("chrom", "start", "end").distinct()
    hits = interval_join(fr.cuts(fr.without_mitochondrial(fragments.select(cell, "chrom", "start", "end", "strand"))), sites)
    counts = hits.groupBy(cell, (F.col("start") - F.col("r_start")).alias("off")).agg(F.count("*").alias("n"))
    in_flank = (F.col("off") < flank) | (F.col("off") >= length - flank)
    background = counts.groupBy(cell).agg((F.sum(F.when(in_flank, F.col("n")).otherwise(0)) / (2.0 * flank) + config.tss_pseudo).alias("bg"))
    # A window that is whole has the highest sum if it begins at a cut or ends at the last place; windows cut off at the ends are few and summed as they are.
    full, last = 2 * taps + 1, length - 1
    ahead = F.sum("n").over(Window.partitionBy(cell).orderBy("off").rangeBetween(0, full - 1))
    sums = counts.withColumn("ahead", F.when(F.col("off") <= last - full + 1, ahead))
    within = lambda met: F.coalesce(F.sum(F.when(met, F.col("n"))), F.lit(0))
    ends = [within(F.col("off") <= i + taps) / (i + taps + 1) for i in range(taps)] + [within(F.col("off") >= last - i - taps) / (i + taps + 1) for i in range(taps + 1)]
    best = sums.groupBy(cell).agg(F.greatest(F.coalesce(F.max("ahead"), F.lit(0)) / full, *ends).alias("top"))
    return best.join(background, cell).select(cell, (F.col("top") / F.col("bg")).alias("tsse"))


def cell_metrics(fragments: DataFrame, promoters: DataFrame, cell: str = "barcode", config: Config = DEFAULT) -> DataFrame:
    """(cell, dup_rate, mito_rate, tsse, uniq): one row per cell.

    dup_rate is 1 - nuclear fragments / reads of all fragments, null if a fragment of the cell has no score.
    """
    mito = F.count_if(S.is_mitochondrial(F.col("chrom")))
    uniq = F.count("*") - mito
    whole = F.count("score") == F.count("*")
    base = fragments.groupBy(cell).agg(uniq.alias("uniq"), F.when(whole & (F.sum("score") > 0), 1 - uniq / F.sum("score")).alias("dup_rate"), (mito / F.count("*")).alias("mito_rate"))
    return base.join(tss_enrichment(fragments, promoters, cell, config), cell, "left").select(cell, "dup_rate", "mito_rate", F.coalesce("tsse", F.lit(0.0)).alias("tsse"), "uniq")


def passes(cutoffs: QcCutoffs) -> Column:
    return (F.col("tsse") >= cutoffs.tsse) & (F.col("uniq") >= cutoffs.fragments) & (F.coalesce("doublet", F.lit(0.0)) <= cutoffs.doublet)


def passing(metrics: DataFrame, cutoffs: QcCutoffs) -> DataFrame:
    m = metrics if "doublet" in metrics.columns else metrics.withColumn("doublet", F.lit(None).cast("double"))
    return m.filter(passes(cutoffs))


def passing_insertions(fragments: DataFrame, metrics: DataFrame, cutoffs: QcCutoffs, paired: bool = True, cell: str = "barcode") -> DataFrame:
    """Insertion sites, not mitochondrial, of the cells that pass: the semi-join comes before sites are split."""
    cells = passing(metrics, cutoffs).select(cell)
    return fr.insertions(fr.without_mitochondrial(fragments).join(cells, cell, "left_semi"), paired)


def with_doublets(metrics: DataFrame, scores: DataFrame, cell: str = "barcode") -> DataFrame:
    """metrics with the doublet score of scores, 0 where there is none."""
    return metrics.drop("doublet").join(scores.select(cell, "doublet"), cell, "left").withColumn("doublet", F.coalesce("doublet", F.lit(0.0)))


def doublet_percentage(metrics: DataFrame, by: str, config: Config = DEFAULT) -> DataFrame:
    return metrics.groupBy(by).agg((100.0 * F.count_if(F.col("doublet") > config.doublet_p) / F.count("*")).alias("doublet_pct"))


def scatter(metrics: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return metrics.filter(F.col("uniq") >= config.scatter_fragments)


def chart_values(metrics: DataFrame) -> DataFrame:
    """What the report's violins show."""
    return metrics.withColumns({"log_uniq": F.log10("uniq"), "dup_pct": 100 * F.col("dup_rate"), "mito_pct": 100 * F.col("mito_rate")})


def report(metrics: DataFrame, by: str) -> DataFrame:
    """A row per sample: the number of cells and quartiles of each chart's values, and all of it as JSON.

    Quartiles, not the values themselves, so that a row stays small however many cells a sample has.
    """
    values = chart_values(metrics)
    names = ["log_uniq", "tsse", "doublet", "dup_pct", "mito_pct"]
    quartiles = [F.percentile_approx(c, [0.0, 0.25, 0.5, 0.75, 1.0], 1000).alias(c) for c in names if c in values.columns]
    out = values.groupBy(by).agg(F.count("*").alias("cells"), *quartiles)
    return out.withColumn("json", F.to_json(F.struct(*out.columns)))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """bin (0 to bins + 1, as width_bucket has it) and n."""
    return df.groupBy(F.expr(f"width_bucket({column}, {low}D, {high}D, {bins})").alias("bin")).agg(F.count("*").alias("n"))
