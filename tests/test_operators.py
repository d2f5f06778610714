import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom.config import QcCutoffs
from peakloom.operators import clusters, demultiplex, features, fragments, intervals, peaks, qc
from peakloom.plans import cluster, doublets, embed, motifs
from tests.plain_clusters import connected

FRAGMENT = "barcode string, chrom string, start long, end long, score long, strand boolean"


@pytest.mark.parametrize(("n", "value"), [(1, 10 / 11), (2, 20 / 11), (3, 30 / 11)])
def test_enrichment_of_sites_in_one_place(spark, n, value):
    promoters = spark.createDataFrame([("chr1", 0, 4001)] * 2, "chrom string, start long, end long")
    f = spark.createDataFrame([("a", "chr1", 2000, 90000 + i, 1, None) for i in range(n)] + [("b", "chr9", 5, 60, 1, None)], FRAGMENT)
    got = {r.barcode: r for r in qc.cell_metrics(f, promoters).collect()}
    assert got["a"].tsse == pytest.approx(value, abs=1e-9)
    assert got["b"].tsse == 0.0


def test_cell_metrics_of_odd_cells(spark):
    promoters = spark.createDataFrame([("chr1", 0, 4001)], "chrom string, start long, end long")
    f = spark.createDataFrame([("m", "chrM", 10, 100, 2, None), ("n", "chr1", 10, 100, 2, None), ("n", "chr1", 20, 100, None, None), ("d", "chr1", 1, 50, 3, None), ("d", "M", 1, 50, 1, None)], FRAGMENT)
    got = {r.barcode: r for r in qc.cell_metrics(f, promoters).collect()}
    assert (got["m"].uniq, got["m"].mito_rate, got["m"].tsse, got["m"].dup_rate) == (0, 1.0, 0.0, 1.0)
    assert got["n"].dup_rate is None
    assert (got["d"].uniq, got["d"].dup_rate, got["d"].mito_rate) == (1, 0.75, 0.5)


def test_cutoffs_are_inclusive(spark):
    m = spark.createDataFrame([("a", 5.0, 100, 0.5), ("b", 4.9, 100, 0.5), ("c", 5.0, 99, 0.5), ("d", 5.0, 100, 0.51), ("e", 5.0, 100, None)], "barcode string, tsse double, uniq long, doublet double")
    assert {r.barcode for r in qc.passing(m, QcCutoffs(5.0, 100, 0.5)).collect()} == {"a", "e"}


def test_fragment_lengths(spark):
    df = spark.createDataFrame([(x,) for x in (30, 31, -31, 999, 1000)], "tlen long")
    assert [r.tlen for r in df.filter(fragments.is_normal_length(F.col("tlen"))).collect()] == [31, -31, 999]


def test_duplicates_keep_the_best_then_the_first(spark):
    schema = "name string, flag int, chrom string, start long, end long, tlen long, mapq int, quality long, order long"
    rows = [("A:1", 99, "chr1", 100, 150, 200, 60, 5, 1), ("A:2", 99, "chr1", 100, 150, 200, 60, 9, 2), ("A:3", 99, "chr1", 100, 150, 200, 60, 9, 3), ("B:4", 99, "chr1", 100, 150, 200, 60, 1, 4), ("A:5", 99, "chr1", 100, 150, 2000, 60, 1, 5)]
    got = sorted((r.barcode, r.start, r.end, r.score) for r in fragments.deduplicated(spark.createDataFrame(rows, schema)).collect())
    assert got == [("A", 104, 295, 3), ("B", 104, 295, 1)]


@pytest.mark.parametrize("width", [7, 100, 5000])
def test_interval_join_equals_all_pairs(spark, width):
    r = random.Random(width)
    make = lambda n: [(r.choice("ab"), s := r.randrange(600), s + r.choice([1, 1, 5, 30, 200]), i) for i in range(n)]
    left, right = make(120) + [("a", 5, 6, 900), ("a", 5, 6, 901)], make(90)
    l = spark.createDataFrame(left, "chrom string, start long, end long, l long")  # noqa: E741
    q = spark.createDataFrame(right, "chrom string, start long, end long, r long")
    want = {(a[3], b[3]) for a in left for b in right if a[0] == b[0] and a[1] < b[2] and b[1] < a[2]}
    got = [(x.l, x.r) for x in intervals.interval_join(l, q, width=width).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    hit = {a for a, _ in want}
    assert {x.l for x in intervals.interval_join(l, q, "semi", width).collect()} == hit
    assert {x.l for x in intervals.interval_join(l, q, "anti", width).collect()} == {a[3] for a in left} - hit
    assert {(x.l, x.r) for x in intervals.interval_join(l, q, "left", width).collect()} == want | {(a[3], None) for a in left if a[3] not in hit}


def test_islands_across_bins(spark):
    rows = [("a", 0, 3_500_000), ("a", 1_500_000, 1_500_100), ("a", 3_500_000, 3_600_000), ("a", 3_600_001, 3_700_000), ("b", 5, 6)]
    df = spark.createDataFrame(rows, "chrom string, start long, end long")
    assert sorted(map(tuple, intervals.merged(df).select("chrom", "start", "end", "n").collect())) == [("a", 0, 3_600_000, 3), ("a", 3_600_001, 3_700_000, 1), ("b", 5, 6, 1)]
    assert len(intervals.merged(df, merge_adjacent=False).collect()) == 4


def test_merged_peaks(spark):
    schema = "chrom string, start long, end long, name string, pvalue double, summit long, signal double"
    chain = lambda ps, at: [("chr1", at + i * 300, at + i * 300 + 400, f"n{at + i}", p, 200, 1.0) for i, p in enumerate(ps)]
    df = spark.createDataFrame(chain([1.0, 5.0, 1.0], 1000) + chain([5.0, 1.0, 4.0], 9000) + [("chr2", 0, 300, "z", 1.0, 50, 1.0)], schema)
    got = [(r.name, r.start, r.end, r.summit) for r in peaks.merge_peaks(df).orderBy(F.expr("cast(substring(name, 2) as int)")).collect()]
    assert got == [("p0", 1300, 1700, 200), ("p1", 9000, 9400, 200), ("p2", 9600, 10000, 200), ("p3", 0, 250, 200)]


def test_suppression_equals_greedy(spark):
    r = random.Random(3)
    rows = [("a", s := r.randrange(3000), s + 60, float(r.randrange(9)), i) for i in range(150)]
    df = spark.createDataFrame(rows, "chrom string, start long, end long, p double, i long")
    kept, left = [], sorted(rows, key=lambda x: (x[3], x[1], x[2], x[4]), reverse=True)
    while left:
        kept.append(left[0])
        left = [x for x in left if x[2] <= kept[-1][1] or kept[-1][2] <= x[1]]
    assert {x.i for x in intervals.suppressed(df, "p", ["start", "end", "i"]).collect()} == {x[4] for x in kept}


def test_sites_count_in_all_regions_and_cells_without_any(spark):
    sites = spark.createDataFrame([("a", "chr1", 15, 16, None), ("b", "chr1", 900, 901, None)], "barcode string, chrom string, start long, end long, strand boolean")
    regions = spark.createDataFrame([("chr1", 10, 20, "r1"), ("chr1", 14, 30, "r2")], "chrom string, start long, end long, feature string")
    m = features.counts(sites, regions, "feature")
    assert sorted(map(tuple, m.collect())) == [("a", "r1", 1), ("a", "r2", 1)]
    assert sorted(map(tuple, features.depths(m, sites).collect())) == [("a", 2), ("b", 0)]


def test_counts_and_sums_without_a_matrix(spark):
    """Short, long, empty, equal and repeated regions, features of several regions and of none, cells in several clusters: counts as by brute force, and all that is summed from them. Counts don't shuffle."""
    r = random.Random(4)
    sites = [(r.choice("abcde"), r.choice(["x", "y"]), s := r.randrange(70_000), s + r.randrange(1, 4), r.choice([None, True, False])) for _ in range(1500)]
    sites += sites[:80] + [("f", "z", 5, 6, None)]
    regions = [(r.choice(["x", "y"]), s := r.randrange(70_000), s + n, i) for i, n in enumerate([0, 1, 2, 400, 512, 513, 4001, 16_384, 16_385, 40_000] * 4)]
    regions += [(*x[:3], 100 + x[3]) for x in regions] + regions[3:20:3] + [(*regions[7][:3], None), (*regions[13][:3], None)]
    cl = [("a", "C1"), ("a", "C2"), ("b", "C1"), ("c", "C2"), ("f", "C1"), ("g", "C1"), ("b", "C1")]
    df = spark.createDataFrame(sites, "barcode string, chrom string, start long, end long, strand boolean")
    q = spark.createDataFrame(regions, "chrom string, start long, end long, peak long")
    k = spark.createDataFrame(cl, "barcode string, cluster string")
    want = Counter()
    for b, chrom, s, e, plus in sites:
        at = e - 1 if plus is False else s
        for g, x, y, f in regions:
            if g == chrom and x <= at < y:
                want[b, f] += 1
    m = features.counts(df, q, "peak")
    assert Counter({(x.barcode, x.peak): x["count"] for x in m.collect()}) == want and m.count() == len(want)
    key = lambda row: tuple((x is None, x) for x in row)
    same = lambda a, b: sorted(map(tuple, a.select(b.columns).collect()), key=key) == sorted(map(tuple, b.collect()), key=key)
    assert same(features.region_sums(df, q, "peak"), features.feature_sums(m, "peak")) and same(features.region_depths(df, q), features.depths(m, df))
    known = q.filter("peak is not null")
    mk = features.counts(df, known, "peak")
    assert same(features.filtered_counts(df, known, "peak"), features.filtered_by_cells(mk, "peak")) and same(features.reindexed_counts(df, known, "peak"), features.reindexed(mk, "peak"))
    got, by = peaks.accessibility_of_sites(df, known, k, "peak"), peaks.relative_accessibility(mk, k, "peak")
    distinct = {(x.cluster, x.peak): x.ras for x in by.collect()}
    assert {(x.cluster, x.peak): x.ras for x in got.collect()} == pytest.approx(distinct)
    plan = features.counts(df, known.dropDuplicates(["peak"]).filter("end - start < 10000"), "peak")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "Exchange" not in plan.split("Join")[0]


def test_sums_of_regions_shuffle_sites_once_and_make_no_lists(spark):
    """Many cells with the same sites: as by counts, by cluster too; sites reach a region as one row for each base and distance, and depths shuffle no more than their cells."""
    r = random.Random(5)
    sites = [(f"c{i % 60}", r.choice(["a", "b"]), s := r.randrange(0, 700, 70), s + 1, i % 2) for i in range(900)]
    spots = [(r.choice(["a", "b", "c"]), s := r.randrange(700), s + r.choice([1, 40, 300, 20_000]), i) for i in range(60)]
    df = spark.createDataFrame(sites, "barcode string, chrom string, start long, end long, k long").withColumn("strand", F.lit(True))
    q = spark.createDataFrame(spots, "chrom string, start long, end long, peak long")
    m = features.counts(df, q, "peak", also=("k",))
    sums = features.region_sums(df, q, "peak", by=("k",))
    assert {tuple(x) for x in sums.collect()} == {tuple(x) for x in m.groupBy("peak", "k").agg(F.sum("count"), F.count("*")).collect()}
    totals = features.region_totals(df, q.unionByName(q.limit(5)), "peak", ("k",))
    assert {tuple(x) for x in totals.collect()} == {tuple(x) for x in features.counts(df, q.unionByName(q.limit(5)), "peak", "k").select("k", "peak", "count").collect()}
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan(sums) and "collect_list" not in plan(totals)
    depths = features.region_depths(df, q)
    assert plan(depths).count("Exchange hashpartitioning") == 1 and {tuple(x) for x in depths.collect()} == {tuple(x) for x in features.depths(features.counts(df, q, "peak"), df).collect()}


def test_counts_shuffle_sites_once_and_meet_equal_regions_as_one(spark, monkeypatch):
    """Sites shuffle to their cells alone if regions are few; the same counts with regions in a shuffle, in short lists of equals and in short stretches; a hot cell, cells and features without a name."""
    r = random.Random(6)
    sites = [(r.choice(["a", "a", "b", None]), r.choice(["x", "y"]), s := r.randrange(3000), s + 1) for _ in range(900)] + [("a", "x", 512, 513)] * 40
    spots = [(r.choice(["x", "y"]), s := 64 * r.randrange(40), s + n, i) for i, n in enumerate([1, 30, 64, 65, 700] * 6)]
    spots += [(*x[:3], 100 * k + x[3]) for x in spots for k in (1, 2, 3)] + [("x", 500, 600, None)]
    df = spark.createDataFrame(sites, "barcode string, chrom string, start long, end long").withColumn("strand", F.lit(True))
    q = spark.createDataFrame(spots, "chrom string, start long, end long, peak long")
    want = Counter((b, f) for b, c, at, _ in sites for g, s, e, f in spots if c == g and s <= at < e)
    plan = features.counts(df, q, "peak")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for few, stretch, equals in ((1_000_000, 1024, 256), (1_000_000, 1, 2), (0, 2, 3)):
        for name, value in (("BROADCAST_ROWS", few), ("STRETCH", stretch), ("EQUALS", equals)):
            monkeypatch.setattr(features, name, value)
        m = features.counts(df, q, "peak")
        assert Counter({(x.barcode, x.peak): x["count"] for x in m.collect()}) == want and m.count() == len(want)


def test_totals_count_sites_by_stretch(spark, monkeypatch):
    """Where few stretches of regions hold sites, these are counted by stretch, whatever lies beyond the sites; otherwise by base. Adjacent, equal, nested, empty and far regions."""
    r = random.Random(7)
    sites = [(r.choice("abc"), r.choice(["x", "y"]), s := r.randrange(500, 3000), s + 1, r.choice(["C1", None])) for _ in range(700)]
    spots = [("x", 500, 600, 1), ("x", 600, 700, 2), ("x", 500, 600, 3), ("x", 550, 2600, 4), ("y", 0, 501, 5), ("y", 900, 900, 6), ("y", 2990, 9000, 2), ("x", 50_000, 90_000, 7), ("z", 0, 9000, 8)]
    df = spark.createDataFrame(sites, "barcode string, chrom string, start long, end long, cluster string").withColumn("strand", F.lit(True))
    q = spark.createDataFrame(spots, "chrom string, start long, end long, peak long")
    want = Counter((k, f) for _, c, at, _, k in sites for g, s, e, f in spots if c == g and s <= at < e)
    for few in (1000, 0):
        monkeypatch.setattr(features, "BROADCAST_ROWS", few)
        got = features.region_totals(df, q, "peak", ("cluster",))
        assert Counter({(x.cluster, x.peak): x["count"] for x in got.collect()}) == want
        assert (features._held_by_stretches(df, q.select("chrom", "start", "end").distinct(), ("cluster",)) is None) == (not few)


def test_specificity_is_made_once_for_equal_regions(spark):
    """Equal regions, a feature of two regions and one without a name, a cell in two clusters: as by the matrix; the window over clusters has a row for each different region, not for each feature."""
    sites = [(f"c{i % 9}", "a", i * 7 % 400, True) for i in range(60)]
    df = spark.createDataFrame(sites, "barcode string, chrom string, start long, strand boolean").withColumn("end", F.col("start") + 1)
    spots = [("a", 100 * (i % 3), 100 * (i % 3) + 90, None if i == 4 else i) for i in range(12)] + [("a", 350, 390, 5)]
    q = spark.createDataFrame(spots, "chrom string, start long, end long, peak long")
    k = spark.createDataFrame([(f"c{i % 8}", f"C{i % 3}") for i in range(10)], "barcode string, cluster string")
    ras = peaks.relative_accessibility(features.counts(df, q, "peak"), k, "peak")
    pairs = lambda x, of: {(r.cluster, r.peak): r[of] for r in x.collect()}
    got = peaks.specificity_of_sites(df, q, k, "peak")
    assert pairs(peaks.accessibility_of_sites(df, q, k, "peak"), "ras") == pytest.approx(pairs(ras, "ras"))
    assert pairs(got, "ss") == pytest.approx(pairs(peaks.specificity(ras, "peak"), "ss"), abs=1e-6) and len(pairs(got, "ss")) == got.count()
    assert "windowspecdefinition(__of" in got._jdf.queryExecution().optimizedPlan().toString()


def test_incidence_and_best_sites(spark):
    """Overlapping, adjacent, empty and equal sites and peaks as by brute force; a motif's sites are in no window."""
    r = random.Random(8)
    sites = [(r.choice(["a", "b", None]), s := r.randrange(9000), s + r.choice([0, 1, 30, 5000 if i % 50 == 0 else 9]), r.choice(["M1", "M2", 'x",y'])) for i in range(300)]
    spots = [(r.choice(["a", "b", "c"]), s := r.randrange(9000), s + r.choice([0, 1, 40]), i) for i in range(200)]
    spots += [(*x[:3], 900 + x[3]) for x in spots[:50]] + [(*spots[3][:3], 4)]
    s = spark.createDataFrame(sites, "chrom string, start long, end long, motif string")
    p = spark.createDataFrame(spots, "chrom string, start long, end long, peak long")
    got = [tuple(x) for x in motifs.incidence(p, s).select("motif", "peak").collect()]
    assert len(set(got)) == len(got) and set(got) == {(m, k) for c, x, y, m in sites for g, a, b, k in spots if c == g and x < b and a < y}
    scored = s.withColumn("score", F.col("start") % 7)
    best = motifs.best_sites(scored)
    assert sorted(x.score for x in best.collect()) == [6] * scored.filter("score = 6").count() and "Window" not in best._jdf.queryExecution().toString()


def test_clusters(spark):
    sites = spark.createDataFrame([("a", 1)], "barcode string, start long")
    twice = spark.createDataFrame([("a", "C1"), ("a", "C2")], "barcode string, cluster string")
    with pytest.raises(Exception, match="several clusters"):
        clusters.routed(sites, twice).collect()
    cells = spark.createDataFrame([(f"c{i}", f"S{i % 2}", f"C{i % 3}") for i in range(60)], "barcode string, sample string, cluster string")
    shares = clusters.cluster_composition(cells).groupBy("sample").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in shares)


def test_demultiplexing(spark):
    index = spark.createDataFrame([(i, s) for i, s in enumerate(["ACGT"] * 50 + ["TTTT"] * 40 + ["ACGA", "GGGG"])], "n long, seq string")
    reads = spark.createDataFrame([(i, f"r{i}", "A", "I") for i in range(92)], "n long, id string, seq string, quality string")
    counts = demultiplex.barcode_counts(index, 4)
    table = demultiplex.corrections(counts, 2)
    got = demultiplex.demultiplexed(reads, index, table, 4).collect()
    assert len(got) == 91 and {r.id.split(":")[0] for r in got} == {"ACGT", "TTTT"}
    curve = spark.createDataFrame([(1000,)] * 30 + [(2,)] * 3000, "n long")
    assert demultiplex.threshold(curve) == 30


def test_numerical_operators(spark):
    rng = np.random.default_rng(0)
    rows = [(f"c{i:03d}", int(f), 1) for i in range(90) for f in rng.choice(60, 25, replace=False) + 60 * (i % 3)]
    m = spark.createDataFrame(rows, "cell string, feature long, count long")
    v = embed.spectral(m, 5).cache()
    near = embed.neighbours(v, 8, block=40).cache()
    x = {r.cell: np.array(r.vec) for r in v.collect()}
    for r in near.filter("src = 'c004'").collect():
        assert r.distance == pytest.approx(np.linalg.norm(x[r.src] - x[r.dst]), abs=1e-6)
    assert near.count() == 90 * 8
    found = cluster.clusters(embed.with_weights(near), 0.1).collect()
    groups = {}
    for r in found:
        groups.setdefault(int(r.cell[1:]) % 3, set()).add(r.cluster)
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == 3
    n, silhouette, _ = cluster.metrics(spark.createDataFrame(found), v, [spark.createDataFrame(found)])
    assert n == 3 and silhouette > 0.3
    scores, _ = doublets.doublet_scores(m, k=10, dims=5)
    assert all(0 <= r.doublet <= 1 for r in scores.collect())
    assert embed.layout(v).count() == 90
    b = v.select("cell", F.concat(F.lit("b"), F.substring("cell", 4, 1).cast("int") % 2).alias("batch"))
    assert embed.corrected(v, b).count() == embed.centred(v, b).count() == 90


def test_motif_cutoff_and_sites(spark):
    table = motifs.log_odds([[0.97, 0.01, 0.01, 0.01]] * 3)
    scores = sorted((sum(table[i][x[i]] for i in range(3)) for x in np.ndindex(4, 4, 4)), reverse=True)
    least = motifs.cutoff(table, 1 / 64)
    assert scores[0] >= least > scores[1]
    s = spark.createDataFrame([("chr1", 100, "GGAAAGGTTTN"), ("chr2", 0, None)], "chrom string, start long, seq string")
    got = sorted((r.start, r.strand) for r in motifs.scan(s, [("a", [[0.97, 0.01, 0.01, 0.01]] * 3)], 1 / 64).collect())
    assert got == [(102, True), (107, False)]


def test_called_peaks_are_where_sites_gather(spark):
    rows = [("C1", "chr1", 50_000 + i % 50) for i in range(200)] + [("C1", "chr1", i * 997 % 1_000_000) for i in range(300)]
    sites = spark.createDataFrame([(c, k, p, p + 1, True) for c, k, p in rows], "cluster string, chrom string, start long, end long, strand boolean")
    got = peaks.call_peaks(sites, 1_000_000).collect()
    assert len(got) == 1 and got[0].start < 50_000 + 50 and got[0].end > 50_000


def test_clusters_honour_the_resolution(spark):
    """A ring of cliques: all of them at a high resolution, fewer clusters at a low one."""
    rows = [(f"n{c}_{i}", f"n{c}_{j}", 1.0) for c in range(12) for i in range(4) for j in range(i + 1, 4)] + [(f"n{c}_0", f"n{(c + 1) % 12}_1", 1.0) for c in range(12)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double").coalesce(1)
    n = {}
    for resolution in (0.05, 1.0):
        found = cluster.clusters(edges, resolution)
        assert dict(found.dtypes)["cluster"] == "int"
        label = {r.cell: r.cluster for r in found.collect()}
        n[resolution] = len(set(label.values()))
        assert connected(rows, label) and len(label) == 48
    assert n[0.05] < 12 == n[1.0]


def test_doublet_threshold_weighs_scores_by_cells(spark, monkeypatch):
    rng = np.random.default_rng(2)
    for _ in range(50):
        x, n = np.sort(rng.random(8)), rng.integers(1, 1000, 8)
        every = np.repeat(x, n)
        at = min(np.cumsum(n)[:-1], key=lambda i: every[:i].var() * i + every[i:].var() * (len(every) - i))
        assert doublets._between(x, n) == pytest.approx((every[at - 1] + every[at]) / 2)
    seen, between = [], doublets._between
    monkeypatch.setattr(doublets, "_between", lambda x, n: seen.append((x, n)) or between(x, n))
    rows = [(f"c{i}", f"f{g}", 1) for i in range(120) for g in sorted({*rng.choice(20, 6) + (i % 2) * 20})]
    m = spark.createDataFrame(rows, "cell string, feature string, count long")
    scores, cut = doublets.doublet_scores(m, k=10, dims=5)
    (x, n), = seen
    assert n.sum() == doublets.simulated(embed.packed(m)).count() > len(x)
    every = np.repeat(x, n.astype(int))
    for r in scores.collect():
        assert r.doublet == pytest.approx(1 / (1 + np.exp(-(r.score - cut) / every.std() * 4)))


def brute_corrected(cells, z, b, n, k, first, rounds=5):
    """Harmony's rounds over all cells at once; first(round) are the cells that the centres begin at."""
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    count = np.bincount(b, minlength=n).astype(float)
    for turn in range(rounds):
        c, seen = unit(z[first(turn)]), np.tile(count / k, (k, 1))
        for _ in range(10):
            r = np.exp(-20 * (1 - unit(z) @ c.T))
            r = r / r.sum(axis=1, keepdims=True) * (count / count.sum() * (seen + 1).sum(axis=1, keepdims=True) / (seen + 1)).T[b]
            r /= r.sum(axis=1, keepdims=True)
            c, seen = unit(r.T @ unit(z)), r.T @ np.eye(n)[b]
        moved = z.copy()
        for j in range(k):
            mean = r[:, j] @ z / r[:, j].sum()
            for i in range(n):
                w = r[:, j] * (b == i)
                moved -= np.outer(w, (w @ z - w.sum() * mean) / (w.sum() + 1))
        z = moved
    return z


def test_batch_correction_is_of_all_cells(spark):
    """Equal to brute force over all cells, with a batch of few cells; cells without a batch stay."""
    rng = np.random.default_rng(5)
    b = np.array([0] * 300 + [1] * 300 + [2] * 6)
    z = rng.standard_normal((606, 4)) * 0.3 + np.eye(4)[rng.integers(0, 3, 606)] * 3 + np.array([0.0, 1.0, -2.0])[b][:, None]
    cells = [f"c{i}" for i in range(606)]
    v = spark.createDataFrame([*((c, x.tolist()) for c, x in zip(cells, z)), ("none", [1.0, 2.0, 3.0, 4.0])], "cell string, vec array<double>")
    batches = spark.createDataFrame([(c, f"b{i}") for c, i in zip(cells, b)], "cell string, batch string")
    got = {r.cell: np.array(r.vec) for r in embed.corrected(v, batches).collect()}
    order = {t: sorted(r.cell for r in batches.orderBy(F.xxhash64("cell", F.lit(t)), "cell").limit(20).collect()) for t in range(5)}
    want = brute_corrected(cells, z.copy(), b, 3, 20, lambda t: [cells.index(c) for c in order[t]])
    assert got["none"].tolist() == [1.0, 2.0, 3.0, 4.0]
    assert np.abs(np.array([got[c] for c in cells]) - want).max() < 1e-6
    centre = lambda x, i: x[b == i].mean(axis=0)
    assert np.linalg.norm(centre(want, 2) - centre(want, 0)) < 0.7 * np.linalg.norm(centre(z, 2) - centre(z, 0))


def test_batch_correction_query_returns_vectors(spark):
    from peakloom.plans import queries

    got = queries.QUERIES["m5_batch_correction"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes)["vec"] == "array<double>" and all(np.isfinite(r.vec).all() and len(r.vec) == 64 for r in got.collect())


def test_deviations_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (7, 12))
    x[:, 0] = 1
    m = spark.createDataFrame([(f"c{i}", j, int(x[i, j])) for i in range(7) for j in range(12) if x[i, j]], "cell string, peak long, count long")
    sets = {"A": [0, 2, 5], "B": [1, 7, 8, 9]}
    pairs = spark.createDataFrame([(k, p) for k, v in sets.items() for p in v], "motif string, peak long")
    p = spark.createDataFrame([(j, j % 3 / 3, int(x[:, j].sum())) for j in range(12)], "peak long, gc double, reads long")
    other = {(r.peak, r.i): r.background for r in motifs.backgrounds(p, 6).collect()}
    assert set(other) == {(j, i) for j in range(12) for i in range(1, 7)}
    log = np.floor(np.log10(x.sum(axis=0) + 1) * 4)
    assert all(j % 3 == o % 3 and log[j] == log[o] for (j, _), o in other.items())
    share, depth = x.sum(axis=0) / x.sum(), x.sum(axis=1)
    y = lambda at: x[:, at].sum(axis=1) / (share[at].sum() * depth) - 1
    got = {(r.motif, r.cell): (r.deviation, r.z) for r in motifs.deviations(m, pairs, motifs.backgrounds(p, 6)).collect()}
    assert len(got) == 14
    for k, at in sets.items():
        law = np.array([y([other[j, i] for j in at]) for i in range(1, 7)])
        d, sd = y(at) - law.mean(axis=0), law.std(axis=0, ddof=1)
        for i in range(7):
            assert got[k, f"c{i}"] == pytest.approx((d[i], d[i] / sd[i] if sd[i] > 0 else 0.0), abs=1e-9)
