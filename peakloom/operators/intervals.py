"""Half-open intervals (chrom, start, end): joins by bins, islands, tiles, non-maximum suppression, coverage.

An interval join is an equality join on (chrom, bin) with the overlap as residual condition: each side is
put into the bins that it touches, and a pair counts in the first bin that both touch. Windows over
a chromosome are made in two levels, within ranges of the rows and over the ranges' summaries, so that no task holds a dense chromosome, or many equal intervals.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise, running, small


def first_bin(start: Column, width: int) -> Column:
    return F.floor(start / width).cast("long")


def last_bin(start: Column, end: Column, width: int) -> Column:
    return F.floor((F.greatest(end, start + 1) - 1) / width).cast("long")


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 < e2) & (s2 < e1)


def overlap_size(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))


def interval_join(left: DataFrame, right: DataFrame, how: str = "inner", width: int = 4096) -> DataFrame:
    """Joins intervals that share a base. how: inner, left, semi or anti.

    Both sides have chrom, start and end; the right's come out as r_chrom, r_start and r_end, and its
    other columns must not be in left. width is best about the length of the longer intervals.
    """
    r = right.withColumnsRenamed({"chrom": "r_chrom", "start": "r_start", "end": "r_end"})
    r = r.withColumn("__rf", first_bin(F.col("r_start"), width)).withColumn("__rb", F.explode(F.sequence("__rf", last_bin(F.col("r_start"), F.col("r_end"), width))))
    l = left.withColumn("__lf", first_bin(F.col("start"), width))  # noqa: E741
    if how in ("semi", "anti"):
        return _filtered(left, r, how, width)
    l = l.withColumn("__lb", F.explode(F.sequence("__lf", last_bin(F.col("start"), F.col("end"), width))))  # noqa: E741
    met = (F.col("chrom") == F.col("r_chrom")) & (F.col("__lb") == F.col("__rb")) & overlaps(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"))
    met &= F.col("__lb") == F.greatest("__lf", "__rf")
    joined = l.join(r, met)
    out = joined.select(*left.columns, "r_chrom", "r_start", "r_end", *(c for c in right.columns if c not in ("chrom", "start", "end")))
    if how == "inner":
        return out
    rest = interval_join(left, right, "anti", width)
    nulls = [F.lit(None).cast(out.schema[c].dataType).alias(c) for c in out.columns[len(left.columns) :]]
    return out.unionByName(rest.select(*left.columns, *nulls))


def _filtered(left: DataFrame, r: DataFrame, how: str, width: int) -> DataFrame:
    """Rows of left that meet (semi) or don't meet (anti) a row of r: distinct intervals are tested, and rows joined to those found."""
    keys = ["chrom", "start", "end"]
    spread = left.select(*keys).distinct().withColumn("__lb", F.explode(F.sequence(first_bin(F.col("start"), width), last_bin(F.col("start"), F.col("end"), width))))
    met = (F.col("chrom") == F.col("r_chrom")) & (F.col("__lb") == F.col("__rb")) & overlaps(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"))
    found = spread.join(r.select("r_chrom", "r_start", "r_end", "__rb"), met, "left_semi").select(*keys).distinct()
    return left.join(found, keys, "left_semi" if how == "semi" else "left_anti")


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """df, written, with __part: rows dealt by ranges of chrom and order, of about as many rows each; of rows that are equal in these some may be in the next range."""
    mixed = df.withColumn("__mix", F.monotonically_increasing_id())
    return materialise(mixed.repartitionByRange("chrom", *order, "__mix").withColumn("__part", F.spark_partition_id()).drop("__mix"))


def _over_ranges(frame: str) -> Window:
    """The ranges of a chromosome before (or after) one: a row each."""
    w = Window.partitionBy("chrom").orderBy("__part")
    return w.rowsBetween(Window.unboundedPreceding, -1) if frame == "before" else w.rowsBetween(1, Window.unboundedFollowing)


def _at_ranges(rows: DataFrame, per: DataFrame) -> DataFrame:
    return rows.join(small(materialise(per)), ["chrom", "__part"])


def islands(df: DataFrame, merge_adjacent: bool = True) -> DataFrame:
    """df with island: a number, from 0 in each chromosome, shared by intervals that overlap directly or through others."""
    dealt = in_ranges(df, ["start", "end"])
    within = Window.partitionBy("chrom", "__part").orderBy("start", "end")
    tops = dealt.groupBy("chrom", "__part").agg(F.max("end").alias("__top"))
    carried = _at_ranges(dealt, tops.select("chrom", "__part", F.max("__top").over(_over_ranges("before")).alias("__carry")))
    reach = F.greatest("__carry", F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    gap = F.col("start") > reach if merge_adjacent else F.col("start") >= reach
    flagged = carried.withColumn("__new", F.coalesce(gap, F.lit(True)).cast("long"))
    ranked = materialise(flagged.withColumn("__at", F.sum("__new").over(within.rowsBetween(Window.unboundedPreceding, 0))))
    new = ranked.groupBy("chrom", "__part").agg(F.sum("__new").alias("__n"))
    earlier = new.select("chrom", "__part", F.coalesce(F.sum("__n").over(_over_ranges("before")), F.lit(0)).alias("__first"))
    return _at_ranges(ranked, earlier).withColumn("island", F.col("__first") + F.col("__at") - 1).select(*df.columns, "island")


def merged(df: DataFrame, merge_adjacent: bool = True) -> DataFrame:
    """The union of intervals: chrom, start, end of each island and n, the number of intervals in it."""
    return islands(df, merge_adjacent).groupBy("chrom", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("island")


def tiles(regions: DataFrame, size: int) -> DataFrame:
    """Regions cut into tiles of the size from their left; the last tile of each keeps what is left."""
    cut = regions.withColumn("__s", F.explode(F.sequence("start", F.col("end") - 1, F.lit(size).cast("long"))))
    return cut.select("chrom", F.col("__s").alias("start"), F.least(F.col("__s") + size, "end").alias("end"))


#: Base pairs of a piece in which suppression is decided at once.
PIECE = 100_000


def suppressed(df: DataFrame, score: str, tie: list[str]) -> DataFrame:
    """Greedy non-maximum suppression: the best interval stays, those that overlap it go, and so on.

    Of equal scores the last by `tie` is taken first. Adds island and rank, the order in which an island's intervals were taken.
    Of equal intervals only the best can stay. The others are put into the pieces of the genome that they touch, and each
    piece decides, in order, what its own rows decide: an interval goes if a better one of the piece stays, and is free if no better one is
    undecided. One that is free in all its pieces stays. Rounds go on until all is decided; only chains of overlaps that run on through
    pieces take more than two. No task holds more than a piece, whatever the size of an island.
    """
    others = [c for c in df.columns if c not in (score, *tie)]
    best = df.groupBy("chrom", F.col("start").alias("__s"), F.col("end").alias("__e")).agg(F.max(F.struct(score, *tie, *(c for c in others if c not in ("chrom", "start", "end")))).alias("__x"))
    best = best.select(*(F.col(c) if c == "chrom" else F.col("__s").alias(c) if c == "start" else F.col("__e").alias(c) if c == "end" else F.col(f"__x.{c}") for c in df.columns))
    rows = materialise(best.withColumn("__id", F.monotonically_increasing_id()))
    keys = [score, *(t for t in tie if t not in ("start", "end"))]
    by = [score, *tie]
    state = rows.select("__id", "chrom", "start", "end", *keys, F.lit(0).alias("__state"))  # 0 undecided, 1 stays

    def decide(piece: pd.DataFrame) -> pd.DataFrame:
        g = piece.sort_values(by, ascending=False, na_position="last", kind="stable")
        start, end, known, alone = (g[c].to_numpy() for c in ("start", "end", "__state", "__alone"))
        marks = np.unique(np.concatenate([start, end]))
        first, last = np.searchsorted(marks, start), np.searchsorted(marks, end)
        taken, open_ = np.zeros(len(marks), bool), np.zeros(len(marks), bool)
        for i in np.flatnonzero(known == 1):
            taken[first[i] : last[i]] = True
        out = np.ones(len(g), np.int32)  # 1 free here, 0 undecided, 2 goes
        for i in np.flatnonzero(known == 0):
            a, b = first[i], last[i]
            if taken[a:b].any():
                out[i] = 2
            elif open_[a:b].any() or not alone[i]:
                out[i] = int(not open_[a:b].any())
                open_[a:b] = True
            else:
                taken[a:b] = True
        return pd.DataFrame({"__id": g["__id"].to_numpy(), "__said": out})

    while True:
        spread = state.withColumn("__a", first_bin(F.col("start"), PIECE)).withColumn("__b", last_bin(F.col("start"), F.col("end"), PIECE))
        spread = spread.withColumn("__alone", F.col("__a") == F.col("__b")).withColumn("__piece", F.explode(F.sequence("__a", "__b"))).drop("__a", "__b")
        said = spread.groupBy("chrom", "__piece").applyInPandas(decide, "__id long, __said int").groupBy("__id").agg(F.max("__said").alias("most"), F.min("__said").alias("least"))
        state = state.join(said, "__id").filter((F.col("__state") == 1) | (F.col("most") < 2)).withColumn("__state", F.greatest("__state", F.col("least"))).drop("most", "least")
        state = materialise(state)
        if not state.filter("__state = 0").limit(1).count():
            break
    kept = materialise(islands(rows).join(state.select("__id"), "__id", "left_semi").drop("__id"))
    return running(kept, ["chrom", "island"], [F.desc(c) for c in by], "rank")


def coverage(df: DataFrame) -> DataFrame:
    """chrom, start, end, depth of every stretch that intervals cover: +1 and -1 events, summed in two levels."""
    events = df.select("chrom", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    steps = in_ranges(events.groupBy("chrom", F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d")), ["at"])
    sums = steps.groupBy("chrom", "__part").agg(F.sum("d").alias("s"), F.min("at").alias("low"))
    sums = sums.select("chrom", "__part", F.coalesce(F.sum("s").over(_over_ranges("before")), F.lit(0)).alias("base"), F.min("low").over(_over_ranges("after")).alias("next_low"))
    within = Window.partitionBy("chrom", "__part").orderBy("at")
    run = _at_ranges(steps, sums).select("chrom", F.col("at").alias("start"), F.coalesce(F.lead("at").over(within), "next_low").alias("end"), (F.col("base") + F.sum("d").over(within.rowsBetween(Window.unboundedPreceding, 0))).alias("depth"))
    return run.filter("depth > 0")
