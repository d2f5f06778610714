"""A map of bases that have sites: a bit for each base pair, in pages. What is kept is bounded by the genome and not by the sites, and maps of samples merge by OR."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import merged

#: Bits of a page (4 KB), as Spark's bitmap functions have them.
PAGE = 32_768


def base_map(sites: DataFrame) -> DataFrame:
    """(chrom, page, bits) of the starts of sites (chrom, start); negative ones are left out. A task sends a page once, whatever the number of its sites."""
    placed = sites.filter("start >= 0").select("chrom", F.expr(f"start div {PAGE}").alias("page"), (F.col("start") % PAGE).alias("bit"))
    return placed.groupBy("chrom", "page").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged_maps(*maps: DataFrame) -> DataFrame:
    """The bases that any of the maps has."""
    every = maps[0]
    for one in maps[1:]:
        every = every.unionByName(one)
    return every.groupBy("chrom", "page").agg(F.bitmap_or_agg("bits").alias("bits"))


def bases(bits: bytes) -> np.ndarray:
    """The places of set bits, ascending."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


def regions(pages: DataFrame, half: int) -> DataFrame:
    """(chrom, start, end): the union of windows of `half` base pairs to both sides of each base, from runs of bits no farther apart within a page, and then over the pages' borders."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            chrom, start, end = [], [], []
            for name, page, bits in batch.itertuples(index=False, name=None):
                at = bases(bits) + page * PAGE
                first = np.concatenate([[True], np.diff(at) > 2 * half])
                chrom += [name] * int(first.sum())
                start.append(np.maximum(at[first] - half, 0))
                end.append(at[np.concatenate([first[1:], [True]])] + half)
            if chrom:
                yield pd.DataFrame({"chrom": chrom, "start": np.concatenate(start), "end": np.concatenate(end)})

    runs = pages.select("chrom", "page", "bits").mapInPandas(run, "chrom string, start long, end long")
    return merged(runs).select("chrom", "start", "end")
