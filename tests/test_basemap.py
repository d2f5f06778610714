"""The base map against sets of positions, and matched background peaks against plain NumPy."""

import random

import numpy as np
import pytest

from peakloom.operators import basemap
from peakloom.plans import backgrounds


def test_base_map_has_the_bases(spark):
    r = random.Random(1)
    rows = [(f"chr{1 + i % 2}", r.choice([r.randrange(200_000), 32_767, 32_768, 0, 65_535, 70_000])) for i in range(3000)]
    sites = spark.createDataFrame([*rows, ("chr1", -5)], "chrom string, start long")
    a, b = basemap.base_map(sites.filter("start % 2 = 0")), basemap.base_map(sites.filter("start % 2 <> 0"))
    both = basemap.merged_maps(a, b)
    got = {(x.chrom, int(p) + x.page * basemap.PAGE) for x in both.collect() for p in basemap.bases(x.bits)}
    assert got == set(rows) and all(len(x.bits) == 4096 for x in both.collect())
    assert both.count() <= 2 * 7  # pages, however many sites


@pytest.mark.parametrize("half", [1, 50, 40_000])
def test_regions_equal_the_union_of_windows(spark, half):
    r = random.Random(half)
    rows = [("chr1", r.randrange(300_000)) for _ in range(400)] + [("chr1", 10), ("chr1", 32_767), ("chr1", 32_768), ("chr2", 5)]
    got = sorted(map(tuple, basemap.regions(basemap.base_map(spark.createDataFrame(rows, "chrom string, start long")), half).collect()))
    want = []
    for chrom, p in sorted(set(rows)):
        if want and want[-1][0] == chrom and max(0, p - half) <= want[-1][2]:
            want[-1] = (chrom, want[-1][1], p + half)
        else:
            want.append((chrom, max(0, p - half), p + half))
    assert got == want
    assert basemap.regions(basemap.base_map(spark.createDataFrame([], "chrom string, start long")), half).collect() == []


def test_matched_backgrounds_follow_the_kernel(spark):
    """Every draw lies in a bin that the kernel reaches, draws have its chances, and reruns agree."""
    rng = np.random.default_rng(3)
    gc, reads = rng.normal(0.5, 0.1, 600), rng.lognormal(4, 1, 600).astype(int) + 1
    reads[:200], gc[:200] = 50, 0.5  # a third of the peaks are alike
    peaks = spark.createDataFrame([(i, float(g), int(x)) for i, (g, x) in enumerate(zip(gc, reads, strict=True))], "peak long, gc double, reads long")
    got = backgrounds.matched(peaks, 50, bins=20, width=0.3).collect()
    assert len(got) == 30_000 and {(r.peak, r.i) for r in got} == {(p, i) for p in range(600) for i in range(1, 51)}
    assert sorted(map(tuple, got)) == sorted(map(tuple, backgrounds.matched(peaks, 50, bins=20, width=0.3).collect()))
    x = np.stack([gc, np.log10(reads + 1)])
    z = np.linalg.inv(np.linalg.cholesky(np.cov(x, bias=True))) @ x
    assert np.allclose(np.cov(z, bias=True), np.eye(2))
    low, step = z.min(axis=1), (z.max(axis=1) - z.min(axis=1)) / 19
    cell = np.floor((z - low[:, None]) / step[:, None] + 0.5).astype(int).T
    bins = sorted(set(map(tuple, cell)))
    number = np.array([bins.index(tuple(c)) for c in cell])
    centres = np.array(bins) * step + low
    p = np.exp(-((centres[:, None] - centres[None]) ** 2).sum(axis=2) / (2 * 0.3**2))
    p[p < backgrounds.LEAST] = 0
    p /= p.sum(axis=1, keepdims=True)
    seen = np.zeros_like(p)
    for r in got:
        seen[number[r.peak], number[r.background]] += 1
    assert (p[seen > 0] > 0).all()
    hot = number[0]
    assert np.abs(seen[hot] / seen[hot].sum() - p[hot]).max() < 0.03


def test_backgrounds_without_variance(spark):
    peaks = spark.createDataFrame([(i, 0.5, 7) for i in range(9)], "peak long, gc double, reads long")
    got = backgrounds.matched(peaks, 3).collect()
    assert len(got) == 27 and {r.background for r in got} <= set(range(9))
    line = spark.createDataFrame([(i, 0.1 * i, 10**i) for i in range(6)], "peak long, gc double, reads long")
    assert backgrounds.matched(line, 3).count() == 18
    assert backgrounds.matched(peaks.filter("false"), 3).collect() == []
