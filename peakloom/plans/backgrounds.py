"""Background peaks as published for chromatin deviations (Schep et al. 2017): like GC content and accessibility, sampled in a whitened space by a kernel over bins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..storage import materialise, running, small

#: Bins of an axis, the kernel's width in the whitened space, the least share of a bin's kernel that is kept, and steps of a drawn number.
BINS, WIDTH, LEAST, STEPS = 50, 0.1, 1e-6, 1 << 30


def whitening(cov: np.ndarray) -> np.ndarray:
    """The matrix that makes coordinates of this covariance independent and of unit variance; an axis without variance gives nothing."""
    scale = np.where(np.diag(cov) > 1e-12, 1.0, 0.0)
    own = cov * np.outer(scale, scale) + np.diag(1 - scale)
    own[0, 1] = own[1, 0] = np.clip(own[0, 1], -(1 - 1e-9) * np.sqrt(own[0, 0] * own[1, 1]), (1 - 1e-9) * np.sqrt(own[0, 0] * own[1, 1]))
    return np.linalg.inv(np.linalg.cholesky(own)) * scale[None]


def kernel(places: np.ndarray, width: float = WIDTH) -> list[tuple[list[int], list[float]]]:
    """For each of some bins (their centres) the bins that are drawn from there, and the cumulative chance: a normal density of the distance, the same for full and sparse bins."""
    out = []
    for own in places:
        p = np.exp(-((places - own) ** 2).sum(axis=1) / (2 * width * width))
        near = np.flatnonzero(p >= LEAST)
        out.append((near.tolist(), (np.cumsum(p[near]) / p[near].sum()).tolist()))
    return out


def located(peaks: DataFrame, bins: int = BINS) -> tuple[DataFrame, np.ndarray]:
    """((peak, bin), centres of the bins in the whitened space) of peaks (peak, gc, reads): the nearest bin of a grid over all peaks. Bins are numbered as they hold peaks, bins * bins at most."""
    x = peaks.select("peak", F.col("gc").cast("double").alias("a"), F.log10(F.col("reads") + 1).alias("b"))
    c = x.agg(F.covar_pop("a", "a"), F.covar_pop("a", "b"), F.covar_pop("b", "b")).first()
    w = whitening(np.array([[c[0] or 0.0, c[1] or 0.0], [c[1] or 0.0, c[2] or 0.0]]))
    moved = x.select("peak", *((F.col("a") * float(w[i, 0]) + F.col("b") * float(w[i, 1])).alias(k) for i, k in enumerate("uv")))
    ends = moved.agg(*(f(k) for k in "uv" for f in (F.min, F.max))).first()
    low, step = zip(*((ends[2 * i] or 0.0, ((ends[2 * i + 1] or 0.0) - (ends[2 * i] or 0.0)) / (bins - 1) or 1.0) for i in range(2)), strict=True)
    at = materialise(moved.select("peak", *(F.floor((F.col(k) - low[i]) / step[i] + 0.5).alias(f"i{k}") for i, k in enumerate("uv"))))
    full = sorted((r.iu, r.iv) for r in at.select("iu", "iv").distinct().collect())
    numbers = at.sparkSession.createDataFrame([(int(u), int(v), n) for n, (u, v) in enumerate(full)], "iu long, iv long, bin int")
    centres = np.array(full, dtype=float).reshape(-1, 2) * np.array(step) + np.array(low)
    return at.join(F.broadcast(numbers), ["iu", "iv"]).select("peak", "bin"), centres


def matched(peaks: DataFrame, n: int = DEFAULT.background_peaks, bins: int = BINS, width: float = WIDTH, seed: int = 0) -> DataFrame:
    """(peak, i, background): n draws for each peak (peak, gc, reads), the same on every run.

    A draw takes a bin by the kernel around the peak's own, then one of the bin's peaks, all alike: so a peak of a sparse bin is drawn as its place asks and not as
    many peaks are there. Peaks get their rank in a bin by ranges, so a bin may hold most of them.
    """
    placed, centres = located(peaks, bins)
    ranked = materialise(running(placed.withColumn("h", F.xxhash64("peak", F.lit(seed))), ["bin"], ["h", "peak"], "rank"))
    sizes = {r.bin: r["count"] for r in ranked.groupBy("bin").count().collect()}
    rows = [(b, [(t, float(c), sizes[t]) for t, c in zip(*found, strict=True)]) for b, found in enumerate(kernel(centres, width))]
    ways = peaks.sparkSession.createDataFrame(rows, "bin int, ways array<struct<to: int, upto: double, size: long>>")
    u = F.pmod(F.xxhash64("peak", "i", F.lit(seed + 1)), F.lit(STEPS)) / STEPS
    drawn = ranked.select("peak", "bin", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("i")).join(F.broadcast(ways), "bin").withColumn("u", u)
    way = F.coalesce(F.filter("ways", lambda x: x["upto"] > F.col("u"))[0], F.element_at("ways", -1))
    found = drawn.select("peak", "i", way.alias("w")).select("peak", "i", F.col("w.to").alias("bin"), F.pmod(F.xxhash64("i", "peak", F.lit(seed + 2)), F.col("w.size")).alias("rank"))
    return found.join(small(ranked.select("bin", "rank", F.col("peak").alias("background"))), ["bin", "rank"]).select("peak", "i", "background")
