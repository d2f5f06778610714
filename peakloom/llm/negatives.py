"""Hard-negative mining by dual-tree search: trees over anchors and over candidates.

A node of a tree holds vectors around a centre, within a radius, so the inner products of two nodes' vectors lie in an interval, known from the centres'
product, their lengths and the radii. A pair of nodes is dropped, for all anchors under it at once, if that interval misses what its anchors can still use; else
the larger node is opened, down to pairs of leaves, whose products are made exactly.

Two searches run so. The first finds each anchor's best rows of its own label (its positives); what it can use is a score of at least
its k-th best so far. The second finds, for each positive, the best rows of other labels in the positive's band of scores; what it can use lies between the k-th best of
the band so far and the band's upper end. Both start from what a bounded sample of rows gives, as rows below it can't be among the best.

The candidates' upper tree is planes fitted to the sample; every row goes down it to its leaf, and rows are dealt by ranges of label, leaf and a hash, so
repeated vectors are split as well. A task builds the lower tree over each Arrow batch. Anchors come in blocks of at most ANCHORS, whose trees are broadcast, one
block after another; a task returns what it found for an anchor, at most k rows each, and the best of those are ranked. No pairs are written.

Result of mine(), one row per anchor, positive and negative: anchor_id, positive_id, rank (of the negative, from 1), negative_id, positive_score, negative_score.
Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; vectors of different lengths are filled up with zeros (an empty one is all
zeros); of equal scores the smaller id comes first; repeated rows are rows of their own, so a row's copy can be its positive; anchors without positives, and positives with an empty
band (their score is negative), have no rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import claim, map_arrow, materialise, release, running

POSITIVES, NEGATIVES = 5, 10
#: The band of a positive's score s: LOW * s <= 100 * negative's score <= HIGH * s.
LOW, HIGH = 30, 90
SCALE = 256
#: Rows of the sample that planes are fitted to and searches start from, and of a leaf of it; anchors of a block; vectors of a leaf.
SAMPLE, SAMPLE_LEAF, ANCHORS, LEAF = 4096, 64, 8192, 32
NEVER = np.iinfo(np.int64).max


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: str | Column = "label") -> DataFrame:
    """id, label and q (the components as whole numbers) of the rows that take part."""
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), F.col(f"`{vector_col}`").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(~odd).select("id", "label", F.transform("v", lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long")).alias("q"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows; an OverflowError if one isn't a 64-bit number."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return (a @ b.T) if most < 2**62 else (a.astype(object) @ b.astype(object).T).astype(np.int64)


@dataclass
class Tree:
    """Nodes over vectors: a node's vectors are order[start:end]; left and right are its children, -1 for a leaf."""

    order: np.ndarray
    start: list[int]
    end: list[int]
    left: list[int]
    right: list[int]
    centre: np.ndarray
    length: np.ndarray
    radius: np.ndarray


def direction(x: np.ndarray) -> np.ndarray:
    """From the vector farthest from the mean to the one farthest from that."""
    far = x[((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    return x[((x - far) ** 2).sum(axis=1).argmax()] - far


def build(x: np.ndarray, leaf: int = LEAF) -> Tree:
    """A tree by cuts along directions: in the middle of the vectors' range, or in halves where that leaves less than an eighth on a side. Equal vectors are cut like others."""
    x = x.astype(np.float64)
    order, start, end, left, right, centres, radii = np.arange(len(x)), [], [], [], [], [], []

    def node(a: int, b: int) -> int:
        own = x[order[a:b]]
        at, centre = len(start), own.mean(axis=0)
        start.append(a), end.append(b), left.append(-1), right.append(-1), centres.append(centre)
        radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
        if b - a > leaf:
            along = own @ direction(own)
            by = np.argsort(along, kind="stable")
            order[a:b] = order[a:b][by]
            middle = a + int(np.searchsorted(along[by], (along.min() + along.max()) / 2))
            if min(middle - a, b - middle) < (b - a) / 8:
                middle = (a + b) // 2
            left[at], right[at] = node(a, middle), node(middle, b)
        return at

    node(0, len(x))
    centre = np.array(centres)
    return Tree(order, start, end, left, right, centre, np.sqrt((centre**2).sum(axis=1)), np.array(radii))


def leaf_pairs(a: Tree, b: Tree, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """(leaf of a, leaves of b) whose products may lie between least and most, which are given by node of a."""
    dots = a.centre @ b.centre.T
    about = a.length[:, None] * b.radius + a.radius[:, None] * (b.length + b.radius)
    about += 1 + 1e-9 * ((a.length + a.radius)[:, None] * (b.length + b.radius))  # of rounding
    open_ = (dots + about >= least[:, None]) & (dots - about <= most[:, None])
    found: dict[int, list[int]] = {}
    stack = [(0, 0)]
    while stack:
        i, j = stack.pop()
        if not open_[i, j]:
            continue
        if a.left[i] < 0 and b.left[j] < 0:
            found.setdefault(i, []).append(j)
        elif b.left[j] < 0 or (a.left[i] >= 0 and a.radius[i] > b.radius[j]):
            stack += [(a.left[i], j), (a.right[i], j)]
        else:
            stack += [(i, b.left[j]), (i, b.right[j])]
    yield from found.items()


def over_nodes(tree: Tree, values: np.ndarray, of: np.ufunc) -> np.ndarray:
    """The least or greatest of the values by node."""
    own = values[tree.order]
    return np.array([of.reduce(own[a:b]) for a, b in zip(tree.start, tree.end, strict=True)], np.float64)


@dataclass
class Search:
    """What a block's anchors look for, by anchor and wish (slot): rows whose score is from low to high, the k best. same: of the anchor's label, or of others."""

    ids: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    low: np.ndarray
    high: np.ndarray
    k: int
    same: bool

    def forest(self) -> list[tuple[int, np.ndarray, Tree]]:
        """A tree for each label's anchors that look for anything."""
        wishes = (self.low <= self.high).any(axis=1)
        return [(int(label), own, build(self.q[own])) for label in np.unique(self.labels) if len(own := np.flatnonzero((self.labels == label) & wishes))]


def found_by(search: Search, batches: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[int, int, int, int]]:
    """(anchor, slot, id, score) of the k best of each wish among the batches (id, row, label, q)."""
    forest, low = search.forest(), search.low.copy()
    best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for ids, rows, labels, q in batches:
        for label in np.unique(labels):
            own = np.flatnonzero(labels == label)
            below = build(q[own])
            for other, anchors, tree in forest:
                if (other == label) != search.same:
                    continue
                wanted = low <= search.high
                least = np.where(wanted, low, NEVER)[anchors].min(axis=1)
                most = np.where(wanted, search.high, -NEVER)[anchors].max(axis=1)
                for i, leaves in leaf_pairs(tree, below, over_nodes(tree, least, np.minimum), over_nodes(tree, most, np.maximum)):
                    asks = anchors[tree.order[tree.start[i] : tree.end[i]]]
                    met = own[np.concatenate([below.order[below.start[j] : below.end[j]] for j in leaves])]
                    scores = products(search.q[asks], q[met])
                    apart = search.rows[asks][:, None] != rows[met]
                    for slot in range(low.shape[1]):
                        fits = (scores >= low[asks, slot][:, None]) & (scores <= search.high[asks, slot][:, None]) & apart
                        for n in np.flatnonzero(fits.any(axis=1)):
                            keep(best, low, (int(asks[n]), slot), ids[met[fits[n]]], scores[n][fits[n]], search.k)
    return [(*at, int(i), int(s)) for at, (i, s) in best.items() for i, s in zip(i, s, strict=True)]


def keep(best: dict, low: np.ndarray, at: tuple[int, int], ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    """Adds rows to a wish's best and raises what it can use."""
    if at in best:
        ids, scores = np.concatenate([best[at][0], ids]), np.concatenate([best[at][1], scores])
    order = np.lexsort((ids, -scores))[:k]
    best[at] = ids[order], scores[order]
    if len(order) == k:
        low[at] = max(low[at], scores[order[-1]])


def raised(search: Search, sample: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], rows: int = 256) -> np.ndarray:
    """low, raised to the k-th best score of each wish among the sample: below it nothing is among the k best of all rows."""
    _, numbers, labels, q = sample
    low = search.low.copy()
    for a in range(0, len(search.q) if len(q) >= search.k else 0, rows):
        at = slice(a, a + rows)
        scores = products(search.q[at], q).astype(np.float64)  # rounded down below 2**53 only, where it is exact
        apart = ((search.labels[at][:, None] == labels) == search.same) & (search.rows[at][:, None] != numbers)
        for slot in range(low.shape[1]):
            fit = np.where(apart & (scores >= search.low[at, slot][:, None]) & (scores <= search.high[at, slot][:, None]), scores, -np.inf)
            kth = np.partition(fit, -search.k, axis=1)[:, -search.k]
            known = np.isfinite(kth) & (np.abs(kth) < 2**53)
            low[at, slot] = np.where(known, np.maximum(low[at, slot], np.where(known, kth, 0).astype(np.int64)), low[at, slot])
    return low


def planes(x: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """The upper tree as (direction, cut) by node in level order: children of node i are 2i + 1 and 2i + 2; all leaves are on one level."""
    depth = max(0, int(np.log2(max(len(x), 1) / SAMPLE_LEAF)))
    x, out, level = x.astype(np.float64), [], [np.arange(len(x))]
    for _ in range(depth):
        after = []
        for own in level:
            d = direction(x[own])
            along = x[own] @ d
            cut = float(np.median(along))
            out.append((d, cut))
            order = np.argsort(along, kind="stable")
            after += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
        level = after
    return out


def leaf_of(upper: list[tuple[np.ndarray, float]], q: np.ndarray) -> np.ndarray:
    """The leaf of each row, by the planes."""
    at = np.zeros(len(q), np.int64)
    if upper:
        ds, cuts, x = np.array([d for d, _ in upper]), np.array([c for _, c in upper]), q.astype(np.float64)
        for _ in range((len(upper) + 1).bit_length() - 1):
            at = 2 * at + 1 + ((x * ds[at]).sum(axis=1) > cuts[at])
    return at


def _batch(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "row", "label")), matrix(batch.column("q"), width))


def _together(df: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Some rows on the driver, of which there are a bounded number."""
    return _batch(df.select("id", "row", "label", "q").toArrow().combine_chunks().to_batches()[0] if df.limit(1).count() else pa.RecordBatch.from_pylist([], pa.schema([("id", pa.int64()), ("row", pa.int64()), ("label", pa.int64()), ("q", pa.list_(pa.int64()))])), width)


def dealt(rows: DataFrame, sample: np.ndarray, width: int) -> DataFrame:
    """rows with their leaf, in ranges of label, leaf and a hash, written in that order."""
    shipped = rows.sparkSession.sparkContext.broadcast(planes(sample))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("negatives")
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf_of(shipped.value, matrix(batch.column("q"), width)), pa.int64())], ["id", "row", "label", "q", "leaf"])

    found = map_arrow(rows.select("id", "row", "label", "q"), run, "id long, row long, label long, q array<long>, leaf long")
    found = found.withColumn("mixed", F.xxhash64("row"))
    return materialise(found.repartitionByRange("label", "leaf", "mixed").sortWithinPartitions("label", "leaf", "mixed").drop("mixed"))


def searched(candidates: DataFrame, search: Search, width: int) -> DataFrame:
    """at, slot, id, score: the k best of each wish that a task has."""
    shipped = candidates.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("negatives")
        found = found_by(shipped.value, (_batch(b, width) for b in batches if b.num_rows))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*found, strict=True) if found else [[]] * 4)], ["at", "slot", "id", "score"])
        release()

    return map_arrow(candidates.select("id", "row", "label", "q"), run, "at long, slot long, id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each wish, with their rank."""
    order = Window.partitionBy("at", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: str | Column, positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = (LOW, HIGH)) -> DataFrame:
    """Hard negatives of usable() rows; is_anchor: a condition on them."""
    spark = rows.sparkSession
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()))
    width = rows.agg(F.max(F.size("q"))).first()[0] or 0
    sample = _together(rows.orderBy(F.xxhash64("id", "row"), "row").limit(SAMPLE), width)
    candidates = dealt(rows, sample[3], width)
    anchors = materialise(running(candidates.filter(is_anchor), [], ["label", "leaf", "row"], "n").withColumn("block", F.expr(f"n div {ANCHORS}")))
    out = []
    for block in range(anchors.agg(F.coalesce(F.max("block") + 1, F.lit(0))).first()[0]):
        ids, numbers, labels, q = _together(anchors.filter(F.col("block") == block), width)
        every = np.full((len(ids), 1), -NEVER), np.full((len(ids), 1), NEVER)
        first = Search(ids, numbers, labels, q, *every, positives, same=True)
        first.low = raised(first, sample)
        near = ranked(searched(candidates, first, width), positives).toArrow()  # at most `positives` rows for an anchor of the block
        at, slot = near["at"].to_numpy(), near["rank"].to_numpy() - 1
        scores, named = (np.zeros((len(ids), positives), np.int64) for _ in range(2))
        low, high = np.full(scores.shape, NEVER), np.full(scores.shape, -NEVER)
        scores[at, slot], named[at, slot] = near["score"].to_numpy(), near["id"].to_numpy()
        low[at, slot], high[at, slot] = ([f(int(s)) for s in near["score"].to_numpy()] for f in (lambda s: -(-band[0] * s // 100), lambda s: band[1] * s // 100))
        second = Search(ids, numbers, labels, q, low, high, negatives, same=False)
        second.low = raised(second, sample)
        best = ranked(searched(candidates, second, width), negatives)
        known = spark.createDataFrame(pa.table({"at": at, "slot": slot, "anchor_id": ids[at], "positive_id": named[at, slot], "positive_score": scores[at, slot]}))
        out.append(materialise(best.join(F.broadcast(known), ["at", "slot"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    form = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(form).parquet(*(f for df in out for f in df.inputFiles())) if out else spark.createDataFrame([], form)


ORACLE_SQL = r"""
WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q, row_number() OVER () AS n
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
s AS (SELECT a.id AS anchor_id, a.n AS an, r.id, r.n, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score FROM r AS a JOIN r ON a.n <> r.n WHERE a.id % 100 = 0),
p AS (SELECT an, anchor_id, n AS pn, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY an ORDER BY score DESC, id, n) <= 5),
m AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.an, pn ORDER BY s.score DESC, s.id, s.n) AS rank
  FROM p JOIN s ON s.an = p.an AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 10
"""
