"""Reads and fragments: flags, duplicates, shifts and cut sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import scalars as S
from ..storage import running

#: Bits of alignment flags.
MULTI, MATE_UNMAPPED, REVERSE, FIRST, DROPPED = 0x1, 0x8, 0x10, 0x40, 0x70C
MAPQ_LEAST = 30


def usable(reads: DataFrame) -> DataFrame:
    """Reads without a flag that drops them, of sufficient mapping quality."""
    return reads.filter((F.col("flag").bitwiseAND(DROPPED) == 0) & (F.col("mapq") >= MAPQ_LEAST))


def is_pair_lead(flag: Column) -> Column:
    """The first segment of several, whose mate is mapped."""
    return (flag.bitwiseAND(FIRST) != 0) & (flag.bitwiseAND(MULTI) != 0) & (flag.bitwiseAND(MATE_UNMAPPED) == 0)


def is_normal_length(tlen: Column, config: Config = DEFAULT) -> Column:
    return (F.abs(tlen) > config.fragment_longer) & (F.abs(tlen) < config.fragment_shorter)


def quality_sum(qualities: Column, mate: Column, config: Config = DEFAULT) -> Column:
    """The sum of base qualities of at least the floor, and the mate's sum if known: what ranks duplicates."""
    own = F.aggregate(F.filter(qualities, lambda q: q >= config.base_quality), F.lit(0), lambda a, q: a + q)
    return own + F.coalesce(mate, F.lit(0))


def read_to_interval(paired: bool) -> list[Column]:
    """start and end of a fragment (by template length) or of a single read."""
    if not paired:
        return [F.col("start"), F.col("end")]
    start = F.when(F.col("tlen") >= 0, F.col("start")).otherwise(F.col("end") + F.col("tlen"))
    return [start.alias("start"), (start + F.abs("tlen")).alias("end")]


def deduplicated(reads: DataFrame, paired: bool = True, config: Config = DEFAULT) -> DataFrame:
    """Fragments of a name-keyed read table (name, flag, chrom, start, end, tlen, mapq, quality, order).

    Reads of one barcode and alignment count as one fragment: the one of highest quality, then the first, whose name is read. score is the number
    of reads; ends are shifted for the insertion. Reads are combined before they shuffle.
    """
    r = reads.filter(is_pair_lead(F.col("flag")) & is_normal_length(F.col("tlen"), config)) if paired else reads
    start, end = read_to_interval(paired)
    r = r.withColumn("barcode", S.barcode_of(F.col("name"))).withColumn("reverse", F.col("flag").bitwiseAND(REVERSE) != 0).withColumns({"s": start, "e": end})
    best = F.max(F.struct("quality", (-F.col("order")).alias("o"), "name"))
    one = r.groupBy("barcode", "chrom", "s", "e", *([] if paired else ["reverse"])).agg(F.count("*").alias("score"), best["name"].alias("read"))
    strand = F.lit(None).cast("boolean") if paired else ~F.col("reverse")
    return shifted(one.select("chrom", F.col("s").alias("start"), F.col("e").alias("end"), "barcode", "score", strand.alias("strand"), "read"), config)


def shifted(fragments: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return fragments.withColumns({"start": F.col("start") + config.shift_left, "end": F.col("end") + config.shift_right})


def without_mitochondrial(df: DataFrame) -> DataFrame:
    return df.filter(~S.is_mitochondrial(F.col("chrom")))


def insertions(fragments: DataFrame, paired: bool = True) -> DataFrame:
    """The insertion sites of fragments, a base each: both ends if paired (+ and -), else the reads as they are."""
    if not paired:
        return fragments
    others = [c for c in fragments.columns if c not in ("start", "end", "strand")]
    left = F.struct(F.col("start").alias("start"), (F.col("start") + 1).alias("end"), F.lit(True).alias("strand"))
    right = F.struct((F.col("end") - 1).alias("start"), F.col("end").alias("end"), F.lit(False).alias("strand"))
    return fragments.select(*others, F.explode(F.array(left, right)).alias("site")).select(*others, "site.start", "site.end", "site.strand")


def cuts(fragments: DataFrame) -> DataFrame:
    """The bases that count for enrichment around start sites: both ends of a fragment, the leading end of a read."""
    others = [c for c in fragments.columns if c not in ("start", "end", "strand")]
    left, right = F.col("start"), F.col("end") - 1
    ends = F.when(F.col("strand").isNull(), F.array(left, right)).when(F.col("strand"), F.array(left)).otherwise(F.array(right))
    return fragments.select(*others, F.explode(ends).alias("start")).withColumn("end", F.col("start") + 1)


def index_position(df: DataFrame) -> DataFrame:
    """The position that a cut site index stores: the end for -, else the start."""
    return df.withColumn("position", F.when(~F.col("strand"), F.col("end")).otherwise(F.col("start")))


def query_base(df: DataFrame) -> DataFrame:
    """Sites as the single base that is looked up in regions: the last for -, else the first."""
    at = F.when(~F.col("strand"), F.col("end") - 1).otherwise(F.col("start"))
    return df.withColumn("start", at).withColumn("end", F.col("start") + 1)


def by_name(df: DataFrame, name: str = "barcode") -> DataFrame:
    """df in the order of a name, with place, a row's number in it from 0: for tools that need rows of a name together; operators here group by hash."""
    return running(df, [], [name], "place").orderBy("place")
