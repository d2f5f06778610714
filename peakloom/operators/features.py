"""Cell by feature counts, in long form: (cell, feature, count)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import scalars as S
from ..storage import BROADCAST_ROWS, materialise, running, small
from . import cellwise
from . import fragments as fr
from .intervals import coverage, first_bin, interval_join, last_bin, merged, tiles

KEYS = ["chrom", "start", "end"]


def windows(sites: DataFrame, size: int, blacklist: DataFrame | None = None, cell: str = "barcode") -> DataFrame:
    """Windows that hold sites, with the number of cells (not sites) in each; windows on the blacklist are left out."""
    at = F.floor(F.col("start") / size).cast("long")
    counted = sites.select("chrom", at.alias("w"), cell).distinct().groupBy("chrom", "w").agg(F.count("*").alias("cells"))
    out = counted.select("chrom", (F.col("w") * size).alias("start"), ((F.col("w") + 1) * size).alias("end"), "cells")
    return interval_join(out, blacklist.select(*KEYS), "anti") if blacklist is not None else out


#: Regions of at most this many bases meet sites in the bin where they start; longer ones in all bins that they touch.
SHORT = 1 << 14
#: Sites that a task counts, features of equal regions in a list, and stretches of 512 bases, at least, whose sites of a cell are in one task.
SITES, EQUALS, STRETCH = 1 << 19, 256, 1024


def _met(sites: DataFrame, regions: DataFrame, keys: list[str], width: int) -> DataFrame:
    """(keys, regions' columns, count): a row for each region and each combination of keys with sites in it. Only sites and regions shuffle, not what they make together. Equal regions are met as one.

    If regions are few, sites shuffle once, to their keys, and pairs come out of arrays. Otherwise regions are put into the bin where they start, of a power of two that is no shorter than they are, and
    sites shuffle to the bins where a region that holds them can start, which are two. The sites of equal keys in a bin are one list, so each list meets a region once, and nothing has to be summed over bins.
    """
    valid = regions.filter("end > start").withColumn("__span", F.when(F.col("end") - F.col("start") <= SHORT, F.expr("shiftleft(1L, length(bin(end - start - 1)))")).otherwise(0))
    spans = {r[0]: r[1] for r in valid.groupBy("__span").agg(F.count("*")).collect()}  # at most one for each power of two
    others = [c for c in regions.columns if c not in KEYS]
    if spans and sum(spans.values()) <= BROADCAST_ROWS:
        rows = materialise(valid.drop("__span"))
        least = materialise(rows.groupBy(*KEYS).agg(F.count("*").alias("__copies")).withColumn("__rid", F.monotonically_increasing_id()))
        members = rows.join(least, KEYS).select(F.col("__rid").alias("__r"), F.col("chrom").alias("r_chrom"), F.col("start").alias("r_start"), F.col("end").alias("r_end"), *others)
        met = cellwise.pairs(fr.query_base(sites), least, keys, STRETCH << 9)
        return met.join(F.broadcast(materialise(members)), F.col("__rid") == F.col("__r")).select(*keys, "r_chrom", "r_start", "r_end", *others, "count")
    parts = []
    if set(spans) - {0}:
        nth = F.floor((F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.lit(0))) - 1) / EQUALS).alias("__nth")
        equal = valid.filter("__span > 0").select("*", nth).groupBy(*KEYS, "__span", "__nth").agg(F.collect_list(F.struct(*others)).alias("__those")).drop("__nth")
        r = equal.withColumnsRenamed({"__span": "__r_span", "chrom": "r_chrom", "start": "r_start", "end": "r_end"}).withColumn("__r_bin", F.expr("floor(r_start / __r_span)"))
        tasks = max(sites.sparkSession.sparkContext.defaultParallelism, -(-sites.count() // SITES))
        spread = fr.query_base(sites).select("chrom", "start", *keys).withColumn("__span", F.explode(F.array(*(F.lit(x).cast("long") for x in sorted(set(spans) - {0})))))
        bins = F.array(F.floor(F.col("start") / F.col("__span")), F.floor(F.col("start") / F.col("__span")) - 1)
        held = spread.withColumn("__bin", F.explode(bins)).repartition(2 * tasks, "__span", "chrom", "__bin").groupBy("__span", "chrom", "__bin", *keys, "start").agg(F.count("*").alias("__n"))
        lists = held.groupBy("__span", "chrom", "__bin", *keys).agg(F.min("start").alias("__low"), F.max("start").alias("__high"), F.collect_list(F.struct(F.col("start").alias("at"), F.col("__n").alias("n"))).alias("__own"))
        met = (F.col("__span") == F.col("__r_span")) & (F.col("chrom") == F.col("r_chrom")) & (F.col("__bin") == F.col("__r_bin")) & (F.col("__high") >= F.col("r_start")) & (F.col("__low") < F.col("r_end"))
        inside = F.filter("__own", lambda x: (x["at"] >= F.col("r_start")) & (x["at"] < F.col("r_end")))
        n = F.when(F.col("__low") == F.col("__high"), F.col("__own")[0]["n"]).otherwise(F.aggregate(inside, F.lit(0).cast("long"), lambda a, x: a + x["n"]))
        counted = lists.join(r, met).select(*keys, "r_chrom", "r_start", "r_end", "__those", n.alias("count")).filter("count > 0")
        parts.append(counted.withColumn("__this", F.explode("__those")).select(*keys, "r_chrom", "r_start", "r_end", *(F.col(f"__this.{c}").alias(c) for c in others), "count"))
    if 0 in spans or not parts:
        bases = fr.query_base(sites).groupBy(*KEYS, *keys).agg(F.count("*").alias("__n"))
        long = interval_join(bases, valid.filter("__span = 0").drop("__span").withColumn("__row", F.monotonically_increasing_id()), width=width)
        parts.append(long.groupBy(*keys, "r_chrom", "r_start", "r_end", *others, "__row").agg(F.sum("__n").alias("count")).drop("__row"))
    return stacked(*parts)


def _by_repeats(regions: DataFrame, feature: str) -> tuple[DataFrame, DataFrame | None]:
    """The regions of features that have one row, and those of others, if there are any."""
    several = regions.groupBy(F.col(feature).alias("__f")).agg(F.count("*").alias("__rows")).filter("__rows > 1").select("__f")
    if not several.limit(1).count():
        return regions, None
    same = F.col(feature).eqNullSafe(F.col("__f"))
    return regions.join(several, same, "left_anti"), regions.join(several, same, "left_semi")


def counts(sites: DataFrame, regions: DataFrame, feature: str, cell: str = "barcode", width: int = 4096, also: tuple[str, ...] = ()) -> DataFrame:
    """(cell, feature, count): sites in regions; a site in several regions counts in each. also: further columns of sites, which split a cell's counts, and of regions, which come along with them.

    A cell's equal sites are counted first. Counts don't shuffle, but for features of several regions.
    """
    of = [c for c in also if c in sites.columns]
    more = [c for c in also if c not in sites.columns]
    single, several = _by_repeats(regions.select(*KEYS, feature, *more), feature)
    out = _met(sites, single, [cell, *of], width).select(cell, *of, feature, *more, "count")
    if several is None:
        return out
    met = _met(sites, several, [cell, *of], width)
    return out.unionByName(met.groupBy(cell, *of, feature, *more).agg(F.sum("count").alias("count")))


def open_rows(sites: DataFrame, regions: DataFrame, feature: str, cell: str = "barcode") -> DataFrame:
    """(cell, on): the features that each cell has counts in, in order, as an array. If regions are few, no row is made for each of them."""
    spots = materialise(regions.filter(F.col(feature).isNotNull() & (F.col("end") > F.col("start"))).select(*KEYS, F.col(feature).alias("__rid")).distinct())
    name = F.col(cell).cast("string").alias("cell")
    if spots.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return counts(sites, spots, "__rid", cell).groupBy(name).agg(F.sort_array(F.collect_set("__rid")).alias("on"))
    parts = cellwise.pairs(fr.query_base(sites), spots, [cell], STRETCH << 9, packed=True)
    return parts.groupBy(name).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("on")))).alias("on"))


def counted_rows(sites: DataFrame, columns: DataFrame, cell: str = "barcode") -> DataFrame:
    """(cell, on, n): the columns that each cell has counts in, and these, as arrays. columns: different regions (chrom, start, end) with column, a number."""
    name = F.col(cell).cast("string").alias("cell")
    spots = materialise(columns.select(*KEYS, F.col("column").alias("__rid")))
    if spots.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return packed_counts(counts(sites, spots, "__rid", cell).select(name, F.col("__rid").alias("column"), "count"))
    parts = cellwise.pairs(fr.query_base(sites), spots, [cell], STRETCH << 9, packed=True).groupBy(name).agg(F.collect_list(F.struct("on", "n")).alias("x"))
    return parts.select("cell", F.flatten("x.on").alias("on"), F.flatten("x.n").alias("n"))


def packed_counts(matrix: DataFrame) -> DataFrame:
    """The same of (cell, column, count)."""
    return matrix.groupBy("cell").agg(F.collect_list(F.struct("column", "count")).alias("x")).select("cell", F.col("x.column").alias("on"), F.col("x.count").alias("n"))


def representatives(regions: DataFrame, feature: str) -> tuple[DataFrame, DataFrame]:
    """The regions with one feature, the least, of those that share their only region, and (feature, copies): how many each stands for. The columns of a matrix of all features are copies of theirs."""
    single, several = _by_repeats(regions.filter(F.col(feature).isNotNull() & (F.col("end") > F.col("start"))).select(*KEYS, feature), feature)
    least = materialise(single.groupBy(*KEYS).agg(F.min(feature).alias(feature), F.count("*").alias("copies")))
    kept, copies = least.select(*KEYS, feature), least.select(feature, "copies")
    return (kept, copies) if several is None else (kept.unionByName(several), copies.unionByName(several.select(feature).distinct().withColumn("copies", F.lit(1).cast("long"))))


def _held(sites: DataFrame, spans: DataFrame, by: tuple[str, ...], cell: str | None = None) -> DataFrame:
    """(chrom, start, end, by, total) of different regions that hold sites, with cells if a cell is named: the different cells of the sites in each.

    With cells, and of regions of a few lengths, the sums are running ones (cellwise.held). Else a site counts as a cell where the cell's site before it lies outside of the region, so sites that are as
    far from the one before are one row for each base, whatever their cells, before they meet regions. Nothing shuffles that both tables make together but a region's sums.
    """
    spans = spans.filter("end > start")
    longest = spans.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 1
    if cell and longest <= cellwise.CHUNK[1]:
        lengths = [r[0] for r in spans.select(F.col("end") - F.col("start")).distinct().limit(cellwise.LENGTHS + 1).collect()]
        if 0 < len(lengths) <= cellwise.LENGTHS:
            return cellwise.held(fr.query_base(sites).select("chrom", "start", *dict.fromkeys([*by, cell])), spans, by, cell, lengths)
    bases = fr.query_base(sites).select("chrom", "start", *by, *([cell] if cell else []))
    if cell:
        gap = F.col("start") - F.lag("start").over(Window.partitionBy(cell, *by, "chrom").orderBy("start"))
        bases = bases.withColumn("__gap", gap).withColumn("__gap", F.when(F.col("__gap") < longest, F.col("__gap")))
    seen = bases.groupBy("chrom", "start", *(["__gap"] if cell else []), *by).agg(F.count("*").alias("__n")).withColumn("end", F.col("start") + 1)
    met = interval_join(seen, spans, width=min(SHORT, max(64, 1 << (longest - 1).bit_length())))
    sums = [F.sum("__n").alias("total")]
    if cell:
        first = F.col("__gap").isNull() | (F.col("start") - F.col("__gap") < F.col("r_start"))
        sums.append(F.sum(F.when(first, F.col("__n")).otherwise(0)).alias("cells"))
    return met.groupBy(F.col("r_chrom").alias("chrom"), F.col("r_start").alias("start"), F.col("r_end").alias("end"), *by).agg(*sums)


def region_sums(sites: DataFrame, regions: DataFrame, feature: str = "feature", cell: str = "barcode", by: tuple[str, ...] = ()) -> DataFrame:
    """(feature, by, total, cells): feature_sums of the counts, without a matrix. by: further columns of sites.

    Equal regions are met once and share what they hold, so the work grows with the sites and with the different regions over a base, which the genome bounds.
    """
    single, several = _by_repeats(regions.select(*KEYS, feature), feature)
    out = single.join(_held(sites, single.select(*KEYS).distinct(), by, cell), KEYS).select(feature, *by, "total", "cells")
    if several is None:
        return out
    return out.unionByName(counts(sites, several, feature, cell, also=by).groupBy(feature, *by).agg(F.sum("count").alias("total"), F.count("*").alias("cells")))


def shared_sums(sites: DataFrame, regions: DataFrame, feature: str = "feature", cell: str = "barcode", by: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(__of, by, total, cells) and (__of, feature): region_sums as they are before equal regions' features get them. __of stands for all features of equal regions, or for one of several regions."""
    single, several = _by_repeats(regions.select(*KEYS, feature), feature)
    none = {c: F.lit(None).cast(regions.schema[c].dataType).alias(c) for c in (*KEYS, feature)}
    of = F.struct(*KEYS, none[feature]).alias("__of")
    sums = _held(sites, single.select(*KEYS).distinct(), by, cell).select(of, *by, "total", "cells")
    members = single.select(of, feature)
    if several is None:
        return sums, members
    of = F.struct(*(none[c] for c in KEYS), feature).alias("__of")
    rest = counts(sites, several, feature, cell, also=by).groupBy(feature, *by).agg(F.sum("count").alias("total"), F.count("*").alias("cells"))
    return sums.unionByName(rest.select(of, *by, "total", "cells")), members.unionByName(several.select(feature).distinct().select(of, feature))


def region_totals(sites: DataFrame, regions: DataFrame, feature: str = "feature", by: tuple[str, ...] = ()) -> DataFrame:
    """(by, feature, count): the sites in regions, whatever their cells. Sites are counted by stretch of the regions' coverage before they meet regions, or by base if there are many stretches, and equal regions are met once."""
    rows = regions.select(*KEYS, feature)
    spans = rows.select(*KEYS).distinct()
    held = rows.join(_held_by_stretches(sites, spans, by) or _held(sites, spans, by), KEYS)
    return held.groupBy(*by, feature).agg(F.sum("total").alias("count"))


def _held_by_stretches(sites: DataFrame, spans: DataFrame, by: tuple[str, ...]) -> DataFrame | None:
    """_held without cells, if the regions' coverage has few stretches where there are sites: a task counts sites by stretch, not by base."""
    bases = fr.query_base(sites).select("chrom", "start", *by)
    reach = F.broadcast(bases.groupBy("chrom").agg(F.min("start").alias("__low"), F.max("start").alias("__high")))
    near = materialise(spans.filter("end > start").join(reach, "chrom").filter("end > __low and start <= __high").select(*KEYS))
    steps = materialise(coverage(near).select(*KEYS))
    binned, width = _binned(steps)
    if binned.count() > BROADCAST_ROWS:
        return None
    at = bases.join(F.broadcast(binned), _in_bin(width)).groupBy(F.col("r_chrom").alias("chrom"), F.col("r_start").alias("start"), F.col("r_end").alias("end"), *by).agg(F.count("*").alias("__n"))
    longest = near.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 1
    met = interval_join(at, near, width=min(SHORT, max(64, 1 << (longest - 1).bit_length())))
    return met.groupBy(F.col("r_chrom").alias("chrom"), F.col("r_start").alias("start"), F.col("r_end").alias("end"), *by).agg(F.sum("__n").alias("total"))


def _binned(steps: DataFrame) -> tuple[DataFrame, int]:
    """Stretches, as r_chrom, r_start and r_end, in all bins that they touch, and the bins' width, of a few stretches."""
    mean = steps.agg(F.avg(F.col("end") - F.col("start"))).first()[0] or 1
    width = 1 << min(12, max(4, int(4 * mean).bit_length()))
    binned = steps.withColumn("__bin", F.explode(F.sequence(first_bin(F.col("start"), width), last_bin(F.col("start"), F.col("end"), width))))
    return binned.withColumnsRenamed({"chrom": "r_chrom", "start": "r_start", "end": "r_end"}), width


def _in_bin(width: int) -> Column:
    return (F.col("chrom") == F.col("r_chrom")) & (first_bin(F.col("start"), width) == F.col("__bin")) & (F.col("start") >= F.col("r_start")) & (F.col("start") < F.col("r_end"))


def region_depths(sites: DataFrame, regions: DataFrame, cell: str = "barcode") -> DataFrame:
    """(cell, depth) of all cells of sites: depths of the counts, without a matrix. A site counts as often as the coverage by regions is deep there.

    A site meets one stretch of the coverage or none, and stays; so sites shuffle to their cells once, and before to the stretches if these are too many to broadcast.
    """
    steps = materialise(coverage(regions.select(*KEYS).filter("end > start")))
    binned, width = _binned(steps)
    bases = fr.query_base(sites).select("chrom", "start", cell)
    return bases.join(small(binned), _in_bin(width), "left").groupBy(cell).agg(F.sum(F.coalesce("depth", F.lit(0))).alias("depth"))


def reached(sites: DataFrame, regions: DataFrame, cell: str = "barcode") -> DataFrame:
    """(cell): the cells with a site in any region. Sites meet the regions' union, and stay."""
    islands = materialise(merged(regions.select(*KEYS).filter("end > start").distinct(), False).select(*KEYS))
    binned, width = _binned(islands)
    return fr.query_base(sites).select("chrom", "start", cell).join(small(binned), _in_bin(width)).select(cell).distinct()


def depths(matrix: DataFrame, cells: DataFrame | None = None, cell: str = "barcode") -> DataFrame:
    """(cell, depth); cells without counts have 0 if all cells are given."""
    d = matrix.groupBy(cell).agg(F.sum("count").alias("depth"))
    return d if cells is None else cells.select(cell).distinct().join(d, cell, "left").withColumn("depth", F.coalesce("depth", F.lit(0)))


def feature_sums(matrix: DataFrame, feature: str = "feature") -> DataFrame:
    return matrix.groupBy(feature).agg(F.sum("count").alias("total"), F.count("*").alias("cells"))


def _selected(marginal: DataFrame, of: str, config: Config) -> DataFrame:
    """Features with a non-zero marginal at most feature_z deviations over the mean of those."""
    some = marginal.filter(F.col(of) > 0)
    law = some.agg(F.avg(of).alias("__mean"), F.stddev_samp(of).alias("__sd"))
    z = (F.col(of) - F.col("__mean")) / F.col("__sd")
    return some.crossJoin(F.broadcast(law)).filter(F.coalesce(z, F.lit(0.0)) <= config.feature_z).drop("__mean", "__sd")


def filtered_by_cells(matrix: DataFrame, feature: str = "feature", config: Config = DEFAULT) -> DataFrame:
    """The matrix without features found in very many cells (for clustering one sample)."""
    keep = _selected(matrix.filter("count > 0").groupBy(feature).agg(F.count("*").alias("cells")), "cells", config)
    return matrix.join(keep.select(feature), feature, "left_semi")


def filtered_counts(sites: DataFrame, regions: DataFrame, feature: str = "feature", cell: str = "barcode", config: Config = DEFAULT) -> DataFrame:
    """filtered_by_cells of the counts: the features are chosen before the matrix is made."""
    return counts(sites, filtered_regions(sites, regions, feature, cell, config), feature, cell)


def filtered_regions(sites: DataFrame, regions: DataFrame, feature: str = "feature", cell: str = "barcode", config: Config = DEFAULT) -> DataFrame:
    """The regions of the features that filtered_by_cells keeps."""
    keep = materialise(_selected(region_sums(sites, regions, feature, cell).select(feature, "cells"), "cells", config).select(feature))
    return regions.join(keep, feature, "left_semi")


def kept_features(sums: DataFrame, feature: str = "feature", config: Config = DEFAULT) -> DataFrame:
    """Features to keep by their total count, summed over samples (for clustering all samples)."""
    return _selected(sums.groupBy(feature).agg(F.sum("total").alias("total")), "total", config)


def named_across(sites: DataFrame, regions: DataFrame, sample: Column, replicate: Column, cell: str = "barcode") -> tuple[DataFrame, DataFrame]:
    """Sites with cell, named across samples, and the different regions with feature, their names: what a matrix of samples is made of."""
    named = regions.select(*KEYS).distinct().withColumn("feature", S.region_name(F.col("chrom"), F.col("start"), F.col("end")))
    return sites.withColumn("cell", S.cell_id(sample, replicate, F.col(cell))), named


def feature_matrix(sites: DataFrame, regions: DataFrame, sample: Column, replicate: Column, cell: str = "barcode") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells with depth, features with total, matrix) of a sample, cells named across samples."""
    keyed, named = named_across(sites, regions, sample, replicate, cell)
    return region_depths(keyed, named, "cell"), region_sums(keyed, named, "feature", "cell"), counts(keyed, named, "feature", "cell")  # each without the others


def stacked(*matrices: DataFrame) -> DataFrame:
    out = matrices[0]
    for m in matrices[1:]:
        out = out.unionByName(m)
    return out


def reindexed(matrix: DataFrame, feature: str = "feature") -> DataFrame:
    """The matrix with column, a number from 0 for each feature that is left (for numeric code), made by ranges of features."""
    numbers = materialise(running(matrix.select(feature).distinct(), [], [feature], "column"))
    return matrix.join(small(numbers), feature)


def reindexed_counts(sites: DataFrame, regions: DataFrame, feature: str = "feature", cell: str = "barcode") -> DataFrame:
    """reindexed of the counts: the features with counts are numbered before the matrix is made, which doesn't shuffle."""
    numbers = materialise(running(region_sums(sites, regions, feature, cell).select(feature), [], [feature], "column"))
    return counts(sites, regions.select(*KEYS, feature).join(small(numbers), feature), feature, cell, also=("column",))


def feature_set(peaks: DataFrame, tile: int | None = None) -> DataFrame:
    """The features of all samples: merged regions cut into tiles, or the regions as they are."""
    return tiles(merged(peaks.select(*KEYS)), tile) if tile else peaks.select(*KEYS).distinct()


# Genes


def start_sites(genes: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The regions around the starts of genes and their transcripts, distinct, not clamped at 0."""
    own = genes.select("chrom", "strand", "left", "right")
    each = genes.select("chrom", "strand", F.explode("transcripts").alias("t")).select("chrom", "strand", "t.left", "t.right")
    at = F.when(F.col("strand"), F.col("left")).otherwise(F.col("right"))
    return own.unionByName(each).select("chrom", at.alias("at")).distinct().select("chrom", (F.col("at") - config.tss_half).alias("start"), (F.col("at") + config.tss_half + 1).alias("end"))


def coding(transcripts: Column) -> Column:
    """The coding transcripts, or all if none is."""
    only = F.filter(transcripts, lambda t: t["type"] == "Coding")
    return F.when(F.size(only) == 0, transcripts).otherwise(only)


def promoters(genes: DataFrame, gene_body: bool = False, config: Config = DEFAULT) -> DataFrame:
    """(chrom, start, end, gene): around each coding transcript's start, or its body with what is upstream."""
    t = genes.select("chrom", "strand", S.gene_key(F.col("gene")).alias("gene"), F.explode(coding(F.col("transcripts"))).alias("t")).select("*", "t.left", "t.right")
    at = F.when(F.col("strand"), F.col("left")).otherwise(F.col("right"))
    if gene_body:
        start, end = F.when(F.col("strand"), F.col("left") - config.gene_body_upstream).otherwise(F.col("left")), F.when(F.col("strand"), F.col("right")).otherwise(F.col("right") + config.gene_body_upstream)
    else:
        start, end = at - config.promoter_half, at + config.promoter_half
    return t.select("chrom", F.greatest(F.lit(0), start).alias("start"), end.alias("end"), "gene").distinct()


def wide_promoters(genes: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(chrom, start, end, genes): from far upstream of a gene's start to a little downstream, with the names that share it."""
    up, down = config.wide_promoter
    plus = F.col("strand")
    start = F.when(plus, F.col("left") - up).otherwise(F.col("right") - down)
    end = F.when(plus, F.col("left") + down).otherwise(F.col("right") + up)
    return genes.select("chrom", F.greatest(F.lit(0), start).alias("start"), end.alias("end"), "gene").groupBy(*KEYS).agg(F.array_sort(F.collect_set("gene")).alias("genes"))


def gene_counts(matrix: DataFrame, clusters: DataFrame, feature: str = "feature", cell: str = "barcode") -> DataFrame:
    """(cluster, feature, count); cells outside clusters don't count."""
    return matrix.join(clusters.select(cell, "cluster"), cell).groupBy("cluster", feature).agg(F.sum("count").alias("count"))


def gene_accessibility(counted: DataFrame, regions: DataFrame, feature: str = "feature") -> DataFrame:
    """(gene, cluster, value): counts of a cluster by a promoter's size and the cluster's total, the highest of a gene's promoters."""
    summed = counted.groupBy("cluster", feature).agg(F.sum("count").alias("count"))
    totals = summed.groupBy("cluster").agg(F.sum("count").alias("total"))
    value = S.rpkm(F.col("count"), F.col("end") - F.col("start"), F.col("total"))
    return summed.join(totals, "cluster").join(regions.select(feature, "gene", "start", "end"), feature).groupBy("gene", "cluster").agg(F.max(value).alias("value"))


def wide(values: DataFrame, row: str, column: str, value: str, names: list[str] | None = None) -> DataFrame:
    """A table with a column for each cluster, 0 where there is nothing, in order of rows."""
    return values.groupBy(row).pivot(column, names).agg(F.first(value)).na.fill(0).orderBy(row)
