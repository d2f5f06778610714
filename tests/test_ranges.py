"""Islands and coverage by ranges of rows, zoom levels, the range index, and neighbours by lists."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom.operators import intervals, runs, tracks
from peakloom.plans import embed
from peakloom.sources import ranges


def dense(spark, n=4000):
    """One chromosome whose intervals lie in a few places, half of them the same."""
    return spark.range(n).selectExpr("'chr1' AS chrom", "IF(id % 2 = 0, 500L, id * 37 % 9000) AS start", "IF(id % 2 = 0, 900L, id * 37 % 9000 + 1 + id % 5) AS end", "id")


def test_no_range_holds_a_dense_chromosome(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = intervals.in_ranges(dense(spark), ["start", "end"])
        parts = [r["count"] for r in rows.groupBy("__part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4 and max(parts) <= 2 * 4000 / 4


@pytest.mark.parametrize("adjacent", [True, False])
def test_islands_over_ranges_equal_one_pass(spark, adjacent):
    df = dense(spark).union(dense(spark, 200).withColumn("chrom", F.lit("chr2")))
    got = {r.id if r.chrom == "chr1" else -1 - r.id: r.island for r in intervals.islands(df, adjacent).collect()}
    for chrom in ("chr1", "chr2"):
        at, reach = -1, -1
        for r in sorted((r for r in df.collect() if r.chrom == chrom), key=lambda r: (r.start, r.end)):
            if r.start > reach or (r.start == reach and not adjacent):
                at += 1
            reach = max(reach, r.end)
            assert got[r.id if chrom == "chr1" else -1 - r.id] == at
    assert intervals.islands(df.filter("false")).columns == [*df.columns, "island"]


def test_coverage_over_ranges_equals_counting(spark):
    got = intervals.coverage(dense(spark)).collect()
    depth = np.zeros(10_000, int)
    for r in dense(spark).collect():
        depth[r.start : r.end] += 1
    found = np.zeros(10_000, int)
    for r in got:
        assert (found[r.start : r.end] == 0).all() and r.start < r.end
        found[r.start : r.end] = r.depth
    assert (found == depth).all()


def test_a_view_reads_one_level(spark, tmp_path):
    path = str(tmp_path / "z")
    stretches = spark.createDataFrame([("chr1", i * 10, i * 10 + 7, i % 5 + 1) for i in range(1000)] + [("chr2", 0, 5000, 2)], "chrom string, start long, end long, depth long")
    tracks.write_zooms(stretches, path, base=16, levels=4)
    assert tracks.spans(spark, path) == [16, 64, 256, 1024]
    depth = np.zeros(10_240)
    for i in range(1000):
        depth[i * 10 : i * 10 + 7] = i % 5 + 1
    for start, end, most, span in ((0, 10_000, 1000, 16), (0, 10_000, 100, 256), (100, 9000, 2, 1024), (320, 640, 20, 16)):
        seen = tracks.view(spark, path, "chr1", start, end, most)
        assert all(f"span={span}/" in f for f in seen.inputFiles()) or {r.span for r in seen.collect()} == {span}
        rows = seen.withColumns({"mean": tracks.mean_depth(), "sd": tracks.spread()}).collect()
        assert sorted(r.start for r in rows) == list(range(start // span * span, end, span))
        for r in rows:
            own = depth[r.start : r.end]
            own = own[own > 0]
            assert (r.covered, r.low, r.high, r.total, r.squares) == (len(own), own.min(), own.max(), own.sum(), (own**2).sum())
            assert r.mean == pytest.approx(own.mean()) and r.sd == pytest.approx(own.std(), abs=1e-6)


def scanned(df):
    """Rows that the scan of a plan gave."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_range_index_reads_what_it_needs(spark, tmp_path):
    r = random.Random(3)
    rows = [(f"chr{1 + i % 2}", s := r.randrange(10_000_000), s + r.choice([1, 50, 400, 90_000]), i) for i in range(40_000)]
    sites = spark.createDataFrame(rows, "chrom string, start long, end long, site int")
    path = str(tmp_path / "ix")
    ranges.write_ranges(sites, path, group=500)
    queries = spark.createDataFrame([("chr1", 1_000_000, 1_010_000), ("chr2", 9_000_000, 9_000_400), ("chr2", 9_000_100, 9_000_500), ("chr9", 5, 6)], "chrom string, start long, end long")
    got = sorted((x.chrom, x.start, x.site) for x in ranges.read_ranges(spark, path, queries).collect())
    want = sorted((q.chrom, q.start, i) for q in queries.collect() for c, s, e, i in rows if c == q.chrom and s < q.end and q.start < e)
    assert got == want and want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        near = ranges.sites_near(spark, path, queries)
        n = near.count()
        assert n <= 500 * len(ranges.groups(spark, path, queries)) < 8000
        assert scanned(near) < 20_000  # row groups and pages of other groups aren't decoded
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert ranges.read_ranges(spark, path, queries.filter("chrom = 'chr9'")).collect() == []


def test_stretches_cover_the_groups():
    r = random.Random(1)
    for _ in range(100):
        found = sorted(r.sample(range(500), r.randrange(0, 60)))
        most = r.randrange(1, 12)
        runs = ranges.stretches(found, most)
        assert len(runs) <= most and all(any(a <= x <= b for a, b in runs) for x in found)
        assert all(a in found and b in found for a, b in runs) and all(b < c for (_, b), (c, _) in zip(runs, runs[1:]))


@pytest.mark.parametrize("spread", [0.2, 5.0])
def test_near_neighbours_have_the_recall(spread, spark):
    """Of cells in groups, and of cells nearly without structure, at least 0.95 of the neighbours are found, with their distances; groups ask few blocks."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((12, 6))[rng.integers(0, 12, 900)] * 4 + spread * rng.standard_normal((900, 6))
    x[:300] = np.where(np.arange(300)[:, None] % 3 == 0, x[0], x[:300])  # repeated vectors
    v = spark.createDataFrame([(f"c{i:03d}", row.tolist()) for i, row in enumerate(x)], "cell string, vec array<double>").repartition(3)
    exact, near = (embed.neighbours(v, 10, block=64, **more).collect() for more in ({}, {"recall": 0.95}))
    true = {}
    for r in exact:
        true.setdefault(r.src, set()).add(round(r.distance, 6))
    far = {s: max(d) for s, d in true.items()}
    assert len(exact) == 9000
    d = {r.src: [] for r in exact}
    for r in near:
        assert r.distance == pytest.approx(np.linalg.norm(x[int(r.src[1:])] - x[int(r.dst[1:])]), abs=1e-6) and r.src != r.dst
        d[r.src].append(r.distance)
    hit = sum(sum(y <= far[s] + 1e-6 for y in ys) for s, ys in d.items())
    assert hit >= 0.93 * 9000 and len({(r.src, r.dst) for r in near}) == len(near)
    lists = embed.lists_for(v, 900, 64)
    assert 8 <= len(lists.centres()) <= 32 and (lists.of(x) < len(lists.centres())).all()


def test_runs_go_on_over_ranges(spark):
    """A key whose run is most of the rows, null keys, and keys that come again; sorted rows give the groups of the keys."""
    r = random.Random(2)
    keys = [r.choice([None, "a", "b"]) for _ in range(300)] + ["a"] * 2000 + [None] * 50 + [r.choice("ab") for _ in range(300)]
    rows = list(enumerate(keys))
    want, at = {}, -1
    for i, k in rows:
        at += i == 0 or k != keys[i - 1]
        want[i] = at
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "at long, name string")
    got = runs.runs(df, "name", "at")
    assert got.columns == ["at", "name", "run"] and {x.at: x.run for x in got.collect()} == want
    ordered = sorted(k or "" for k in keys)
    grouped = runs.runs(spark.createDataFrame(list(enumerate(ordered)), "at long, name string"), "name", "at").groupBy("run", "name").count().collect()
    assert {x.name: x["count"] for x in grouped} == {k: ordered.count(k) for k in set(ordered)} and len(grouped) == len(set(ordered))
    assert runs.runs(df.filter("false"), "name", "at").collect() == []


def test_pairs_in_ranges_are_dealt_before_they_are_counted(spark, tmp_path, monkeypatch):
    """A task counts the pairs of few sites, and no task holds a table of counts before the shuffle."""
    monkeypatch.setattr(ranges, "COUNTED", 10)
    rows = spark.createDataFrame([("x", 5 * i, 5 * i + 12, f"b{i % 3}") for i in range(200)], "chrom string, start long, end long, barcode string")
    path = str(tmp_path / "r")
    ranges.write_ranges(rows, path, group=16)
    q = spark.createDataFrame([("x", 0, 300, 1), ("x", 299, 301, 2), ("y", 0, 9, 3)], "chrom string, start long, end long, feature long")
    got = ranges.counted(spark, path, q, ["feature", "barcode"])
    want = {(f, f"b{b}"): n for f, s, e in ((1, 0, 300), (2, 299, 301)) for b in range(3) if (n := sum(5 * i < e and s < 5 * i + 12 and i % 3 == b for i in range(200)))}
    assert {(r.feature, r.barcode): r.n for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    above = plan.split("REPARTITION_BY_NUM")[0]
    assert "hashpartitioning(feature" in above and above.count("Exchange") == 1 and ", 20)" in above
