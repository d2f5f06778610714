"""Sums and pairs that are made cell by cell, against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from peakloom.operators import cellwise, features

SITE = "barcode string, chrom string, start long, end long, cluster string, k long"


def _sites(r, n):
    spots = [0, 1, 399, 400, 65_535, 65_536, 65_900, 131_071, 131_072]
    rows = [(r.choice(["a", "b", "c", None]), r.choice(["x", "y"]), s := r.choice(spots) + r.randrange(0, 300), s + 1, r.choice(["C1", "C2", None]), r.randrange(2)) for _ in range(n)]
    return rows + rows[:50] + [("d", "z", 5, 6, "C1", 0), ("e", None, 5, 6, "C1", 0)]


def _held(sites, spans):
    total, cells = Counter(), defaultdict(set)
    for b, c, at, _, cl, k in sites:
        for g, s, e in spans:
            if c == g and s <= at < e:
                total[g, s, e, cl, k] += 1
                cells[g, s, e, cl, k].add(b)
    return {(*x, n, len(cells[x])) for x, n in total.items()}


@pytest.mark.parametrize("lengths", [[400], [1, 400, 65_536, 300_000]])
def test_sums_of_regions_of_a_few_lengths_meet_no_regions(spark, monkeypatch, lengths):
    """Regions that cross chunks, start before 0 and hold nothing, cells and clusters without a name: as by brute force, and no site is joined to regions."""
    r = random.Random(1)
    sites = _sites(r, 900)
    spans = {(r.choice(["x", "y", "w"]), s := r.choice([-300, 0, 65_200, 65_536, 130_900, 700_000]) + r.randrange(500), s + r.choice(lengths)) for _ in range(120)}
    df = spark.createDataFrame(sites, SITE).withColumn("strand", F.lit(True))
    q = spark.createDataFrame(sorted(spans), "chrom string, start long, end long")
    monkeypatch.setattr(features, "interval_join", lambda *a, **k: pytest.fail("sites meet regions"))
    got = features._held(df, q, ("cluster", "k"), "barcode")
    assert Counter(tuple(x[c] for c in ("chrom", "start", "end", "cluster", "k", "total", "cells")) for x in got.collect()) == Counter(_held(sites, spans))


def test_sums_in_small_steps_and_of_many_lengths(spark, monkeypatch):
    """The same with equal rows counted in a task at once, sites added up a few at a time, and by meeting regions where these have many lengths."""
    r = random.Random(2)
    sites = _sites(r, 300)
    spans = {("x", s := r.randrange(70_000), s + n) for n in range(1, 40)}
    df = spark.createDataFrame(sites, SITE).withColumn("strand", F.lit(True))
    q = spark.createDataFrame(sorted(spans), "chrom string, start long, end long")
    want = Counter(_held(sites, spans))
    sums = lambda: Counter(tuple(x[c] for c in ("chrom", "start", "end", "cluster", "k", "total", "cells")) for x in features._held(df, q, ("cluster", "k"), "barcode").collect())
    assert sums() == want
    monkeypatch.setattr(cellwise, "LENGTHS", 64)
    assert sums() == want


def test_equal_rows_of_a_hot_cell_are_one():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"chrom": ["x", "x", None] * 40, "start": [1, 2, 3] * 40})
    t = cellwise._gathered([batch] * 5, held=130)
    assert t.num_rows <= 3 + 120 and sum(t.column("__n").to_pylist()) == 600
    assert cellwise._gathered([batch.slice(0, 0)]) is None


def test_reached_cells(spark):
    df = spark.createDataFrame([("a", "x", 5), ("b", "x", 20), ("c", "y", 5), ("a", "x", 7), ("d", "x", 10)], "barcode string, chrom string, start long").withColumns({"end": F.col("start") + 1, "strand": F.lit(True)})
    q = spark.createDataFrame([("x", 0, 10), ("x", 5, 10), ("x", 11, 20), ("y", 5, 5), ("z", 0, 9)], "chrom string, start long, end long")
    assert [x.barcode for x in features.reached(df, q).collect()] == ["a"]


def test_pairs_are_listed_once_and_do_not_shuffle(spark):
    """Counts of a cell in regions of all lengths, equal ones too: sites shuffle, in one step, and what they make doesn't and isn't grouped."""
    r = random.Random(3)
    sites = _sites(r, 700)
    spots = [(r.choice(["x", "y"]), s := r.choice([-300, 0, 65_200, 130_900]) + r.randrange(500), s + n, i) for i, n in enumerate([1, 30, 400, 400, 65_536, 200_000] * 9)]
    spots += [(*x[:3], 100 + x[3]) for x in spots[::4]]
    df = spark.createDataFrame(sites, SITE).withColumn("strand", F.lit(True))
    q = spark.createDataFrame(spots, "chrom string, start long, end long, peak long")
    want = Counter((b, f) for b, c, at, *_ in sites for g, s, e, f in spots if c == g and s <= at < e)
    m = features.counts(df, q, "peak")
    assert Counter({(x.barcode, x.peak): x["count"] for x in m.collect()}) == want and m.count() == len(want)
    plan = m._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan and "BroadcastHashJoin" in plan


def test_open_rows_equal_the_matrix(spark, monkeypatch):
    """A cell's open features as by the counts, with equal regions, features of several regions and of none; in one row for a cell and chunk, and by the counts where regions are many."""
    from peakloom.plans import embed

    r = random.Random(4)
    df = spark.createDataFrame(_sites(r, 500), SITE).withColumn("strand", F.lit(True))
    spots = [(r.choice(["x", "y"]), s := r.choice([0, 65_200, 130_900]) + r.randrange(500), s + r.choice([0, 30, 400, 90_000]), i % 70) for i in range(90)] + [("x", 0, 500, None), ("x", 0, 500, 3)]
    q = spark.createDataFrame(spots, "chrom string, start long, end long, peak long")
    known = q.filter("peak is not null")
    want = {(x.cell, *x.on) for x in embed.packed(features.counts(df, known, "peak"), "barcode", "peak").collect()}
    got = features.open_rows(df, q, "peak")
    assert {(x.cell, *x.on) for x in got.collect()} == want and "Join" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(features, "BROADCAST_ROWS", 5)
    assert {(x.cell, *x.on) for x in features.open_rows(df, q, "peak").collect()} == want


def test_a_matrix_of_samples_makes_no_sums(spark, monkeypatch):
    from peakloom.plans import queries as Q

    for name in ("region_depths", "region_sums"):
        monkeypatch.setattr(features, name, lambda *a, **k: pytest.fail("not asked for"))
    assert Q.QUERIES["c11_feature_matrix"](spark, "/root/testdata/sf0.001").columns == ["cell", "feature", "count"]


def test_deviations_of_equal_peaks_as_by_the_matrix(spark, monkeypatch):
    """Peaks of the same region are one column, a peak of two regions is in two; a motif at a time; no counts meet sets in a join."""
    from peakloom.operators.intervals import running
    from peakloom.plans import motifs

    r = random.Random(5)
    df = spark.createDataFrame([x for x in _sites(r, 600) if x[0]], SITE).withColumn("strand", F.lit(True))
    spots = [("x", 100 * (i % 5), 100 * (i % 5) + 90 + 400 * (i % 2), i) for i in range(20)] + [("y", 0, 300, 3)]
    q = spark.createDataFrame(spots, "chrom string, start long, end long, peak long")
    m = features.counts(df, q, "peak").withColumnRenamed("barcode", "cell")
    p = m.groupBy("peak").agg(F.sum("count").alias("reads")).withColumn("gc", F.lit(0.5))
    pairs, back = p.select(F.concat(F.lit("M"), F.col("peak") % 3).alias("motif"), "peak"), motifs.backgrounds(p, 6)
    spans = q.join(p.select("peak"), "peak", "left_semi")
    columns = running(spans.select("chrom", "start", "end").distinct(), [], ["chrom", "start", "end"], "column")
    monkeypatch.setattr(motifs, "AT_ONCE", 1)
    rows = features.counted_rows(df, columns)
    got = motifs.deviations_of(rows, spans.join(columns, ["chrom", "start", "end"]).select("peak", "column"), motifs.expectation(m), pairs, back)
    pick = lambda x: {(a.motif, a.cell): (a.deviation, a.z) for a in x.collect()}
    want, have = pick(motifs.deviations(m, pairs, back)), pick(got)
    assert have.keys() == want.keys() and len(want) >= 6 and all(have[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert max(len(x.on) for x in rows.collect()) <= columns.count()
