"""N-gram Jaccard join: MinHash banding, verified on full n-gram sets.

Documents are sets of hashed word n-grams (lower case, split at white space; a text of fewer words
than NGRAM is one n-gram of them all). Documents with equal sets form a class. For one representative
per class, bands of MinHash values are hashed; the numbers of bands and rows are chosen for the target recall at the
threshold. Only band hashes that several representatives share lead further: they link their
representatives to the least of them, which gives groups of candidates (connected components). In a group the
full sets of all pairs are compared, so a band that misses a pair loses it only if no chain of
other bands joins the two.

Groups are cut into blocks of about BLOCK representatives with sets of similar size; a task compares two blocks
by a matrix product over the n-grams that at least two of its sets have. Two blocks whose sizes rule out the threshold are not
compared. A representative finds the comparisons of its block from the numbers of its group alone, so blocks aren't joined to each other, and
a large group's rows never meet by its key (common.attach). No pair is written out: tasks give counts of links and the edges of spanning forests.

Result, one row per document: doc_id, class_id (the least id of those linked to it, directly or through
others), copy_id (the least id with an equal set), n_links (documents whose sets have at least the threshold's
similarity with its own, copies included). Defined cases: a null text is an empty text; texts without words have an empty
set and no links; doc_ids are whole numbers, rows with a null one have no links; rows that repeat an id are documents of their own,
with equal or different texts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach, claim, map_arrow, materialise, release, slices, small
from .components import components

NGRAM, THRESHOLD, RECALL = 5, 0.8, 0.999
BLOCK = 256
#: Bytes of text whose n-grams are made at once; values and matrix cells that a comparison holds at once.
TEXT, RANGE, CELLS = 2 << 20, 1 << 18, 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD1342543DE82EF95)


def bands_for(threshold: float, recall: float, rows: int = 6) -> tuple[int, int]:
    """(bands, rows): as many bands of `rows` values as find a pair at the threshold with the target recall."""
    return math.ceil(math.log1p(-recall) / math.log1p(-(threshold**rows))), rows


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values, scattered."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * ODD
        h = (h ^ (h >> np.uint64(29))) * STEP
        return h ^ (h >> np.uint64(32))


def ngrams(texts: pa.Array, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the texts' n-grams, their hashes, distinct and ascending within a text)."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))))
    flat = pc.dictionary_encode(lists.flatten())
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    own = np.array([xxhash.xxh3_64_intdigest(w) if w else 0 for w in flat.dictionary.to_pylist()], dtype=np.uint64)
    codes = flat.indices.to_numpy(zero_copy_only=False)
    words = own[codes] if len(own) else np.empty(0, np.uint64)
    sizes = np.diff(offsets)
    sizes = np.where((sizes == 1) & (words[np.minimum(offsets[:-1], max(len(words) - 1, 0))] == 0), 0, sizes) if len(words) else sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    if len(doc) != len(words):  # texts without words have one empty word
        words = words[words != 0]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(words), np.uint64)
        place = np.arange(len(words)) - starts[doc]
        for i in range(n):
            ahead = np.zeros(len(words), np.uint64)
            ahead[: max(len(words) - i, 0)] = words[i:]
            inside = place + i < sizes[doc]
            rolled = rolled * STEP + np.where(inside, mixed(ahead + np.uint64(i + 1)), np.uint64(0))
    full = (place + n <= sizes[doc]) | ((place == 0) & (sizes[doc] < n))
    doc, rolled = doc[full], mixed(rolled[full])
    order = np.lexsort((rolled, doc))
    doc, rolled = doc[order], rolled[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (rolled[1:] != rolled[:-1])
    doc, rolled = doc[new], rolled[new]
    return np.searchsorted(doc, np.arange(len(sizes) + 1)), rolled


def signatures(offsets: np.ndarray, hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of the non-empty sets, by set and band."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.zeros((len(starts), bands), np.uint64)
    if not len(starts):
        return out
    a = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * ODD) | np.uint64(1)
    with np.errstate(over="ignore"):
        for band in range(bands):
            for r in range(rows):
                k = band * rows + r
                least = np.minimum.reduceat(hashes * a[k] ^ (hashes >> np.uint64(31)), starts)
                out[:, band] = mixed(out[:, band] * STEP + least + np.uint64(k))
    return out


def fingerprints(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Of docs (row, doc_id, text): row, doc_id, fp (of the set, null if it is empty), size, bands (by which sets are found)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngrams")
        for batch in slices(batches, column=2, most=TEXT):
            offsets, hashes = ngrams(batch.column(2))
            some = np.diff(offsets) > 0
            sig = iter(signatures(offsets, hashes, bands, rows).view(np.int64))
            fps = [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) if b > a else None for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.binary()), pa.array(np.diff(offsets), pa.int64()), pa.array([next(sig) if s else None for s in some], pa.list_(pa.int64()))], ["row", "doc_id", "fp", "size", "bands"])
        release()

    return map_arrow(docs.select("row", "doc_id", "text"), run, "row long, doc_id long, fp binary, size long, bands array<long>")


def sets_of(docs: DataFrame) -> DataFrame:
    """Of docs (row, text): node (the row's number) and grams, the set's hashes as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngrams")
        for batch in slices(batches, most=TEXT):
            offsets, hashes = ngrams(batch.column(1))
            grams = [hashes[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.binary())], ["node", "grams"])
        release()

    return map_arrow(docs.select("row", "text"), run, "node long, grams binary")


def common_counts(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of each left set with each right one (None: with each left one); sets are ascending.

    Goes through the hashes by ranges of about RANGE values in all, so the memory it takes doesn't grow with the sets.
    """
    every = [*left, *(right or [])]
    n, total = len(left), np.zeros((len(left), len(right) if right is not None else len(left)), np.float32)
    parts = max(1, sum(map(len, every)) // RANGE)
    inner = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(x, inner), [len(x)]]) for x in every]
    width = max(1, CELLS // max(len(every), 1))
    x = np.zeros((len(every), width), np.float32)
    for k in range(parts):
        own = [v[c[k] : c[k + 1]] for v, c in zip(every, cuts, strict=True)]
        _, codes, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(every)), [len(v) for v in own])
        shared = times > 1
        keep = shared[codes]
        codes, owner = (np.cumsum(shared) - 1)[codes[keep]], owner[keep]
        order = np.argsort(codes, kind="stable")
        codes, owner = codes[order], owner[order]
        for start in range(0, int(shared.sum()), width):
            a, b = np.searchsorted(codes, (start, start + width))
            x[:] = 0
            x[owner[a:b], codes[a:b] - start] = 1
            total += x[:n] @ (x[:n] if right is None else x[n:]).T
    return total


def compare(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """For the two blocks (side 0 and 1, or 0 alone) of a group: each one's links to the other, and a spanning forest of the links."""
    sides = [group[group.side == s] for s in (0, 1)]
    alone = sides[1].empty
    if sides[0].empty:
        return pd.DataFrame({"node": group.node, "links": 0, "parent": group.node})
    a = sides[0]
    b = a if alone else sides[1]
    grams = [[np.frombuffer(x, np.uint64) for x in s.grams] for s in ((a,) if alone else (a, b))]
    both = common_counts(grams[0], None if alone else grams[1])
    na, nb = (np.array([len(x) for x in g], np.float64) for g in (grams[0], grams[-1]))
    linked = both >= threshold * (na[:, None] + nb[None, :] - both) - 1e-6
    if alone:
        np.fill_diagonal(linked, False)
    ids = np.unique(np.concatenate([a.node, b.node]))
    at = [np.searchsorted(ids, s.node.to_numpy()) for s in (a, b)]
    links = np.zeros(len(ids), np.int64)
    links[at[0]] += linked @ b.copies.to_numpy()
    if not alone:
        links[at[1]] += linked.T @ a.copies.to_numpy()
    root = np.arange(len(ids))
    x, y = (at[k][i] for k, i in enumerate(np.nonzero(linked)))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
    return pd.DataFrame({"node": ids, "links": links, "parent": ids[root]})


def classes_of(prints: DataFrame) -> DataFrame:
    """The classes of equal sets: fp, node (the number of the row that stands for it), rep (the least doc_id), copies."""
    usable = prints.filter("fp is not null and doc_id is not null")
    return usable.groupBy("fp").agg(F.min(F.struct("doc_id", "row")).alias("least"), F.count("*").alias("copies")).select("fp", F.col("least.row").alias("node"), F.col("least.doc_id").alias("rep"), "copies")


def candidates(reps: DataFrame) -> DataFrame:
    """(node, comp): groups of representatives (node, bands) that share band hashes, directly or through others; only of two or more."""
    hashes = reps.select("node", F.posexplode("bands").alias("band", "h"))
    shared = hashes.groupBy("band", "h").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1")
    n = (shared := materialise(shared)).count()
    stars = hashes.join(F.broadcast(shared), ["band", "h"]) if n <= BROADCAST_ROWS else attach(hashes, shared, ["band", "h"], "n", hashes.count())
    edges = stars.filter("node <> least").select("node", "least").distinct()
    return components(edges, "node", "least").select(F.col("node"), F.col("component").alias("comp"))


def comparisons(members: DataFrame, threshold: float, total: int) -> DataFrame:
    """(node, copies, pair, side) of members (node, copies, size, comp): a row for each comparison that a block takes part in.

    A set links only to sets of its own class of sizes or the next ones. The numbers of a group's members by class are a small map; from it each
    member knows the blocks of its own class and of its neighbours.
    """
    step = -math.log(threshold)
    rows = materialise(members.withColumn("sizes", F.floor(F.log("size") / step + 1e-9).cast("int")))
    counts = rows.groupBy("comp", "sizes").agg(F.count("*").alias("n"))
    groups = materialise(counts.groupBy("comp").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("sizes", "n"))).alias("by")))
    met = attach(rows, groups, "comp", "all", total)
    blocks = lambda at: F.coalesce(F.expr(f"cast((by[sizes + {at}] + {BLOCK - 1}) div {BLOCK} as int)"), F.lit(0))
    met = met.withColumns({"before": blocks(-1), "own": blocks(0), "after": blocks(1)}).withColumn("block", F.pmod(F.xxhash64("node"), F.col("own")).cast("int"))
    small_group = F.col("all") <= BLOCK
    upto = lambda a, b: f"if({b} >= {a}, sequence({a}, {b}), array())"
    pair = "concat_ws(':', comp, {}, {}, {}, {})"
    first = F.expr(f"transform({upto('block', 'own - 1')}, b -> struct({pair.format('sizes', 'block', 'sizes', 'b')} as pair, 0 as side))")
    second = F.expr(f"transform({upto('0', 'block - 1')}, b -> struct({pair.format('sizes', 'b', 'sizes', 'block')} as pair, 1 as side))")
    larger = F.expr(f"transform({upto('0', 'after - 1')}, b -> struct({pair.format('sizes', 'block', 'sizes + 1', 'b')} as pair, 0 as side))")
    lesser = F.expr(f"transform({upto('0', 'before - 1')}, b -> struct({pair.format('sizes - 1', 'b', 'sizes', 'block')} as pair, 1 as side))")
    whole = F.expr("array(struct(concat_ws(':', comp) as pair, 0 as side))")
    every = F.when(small_group, whole).otherwise(F.concat(first, second, larger, lesser))
    return met.select("node", "copies", F.explode(every).alias("x")).select("node", "copies", "x.pair", "x.side")


def linked(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Of docs (row, doc_id, text), with fixed row numbers: row, doc_id, class_id, copy_id, n_links and stays (whether the row is the first of its class: by id, then row)."""
    bands, rows = bands_for(threshold, recall)
    prints = materialise(fingerprints(docs, bands, rows))
    total = prints.count()
    classes = materialise(classes_of(prints))
    reps = materialise(prints.join(classes.select(F.col("node").alias("row"), "copies"), "row").select(F.col("row").alias("node"), "doc_id", "copies", "size", "bands"))
    groups = materialise(candidates(reps))
    members = materialise(groups.join(reps.select("node", "copies", "size"), "node"))
    # The members' sets are made again from their texts.
    grams = materialise(sets_of(docs.select("row", "text").join(small(members.select(F.col("node").alias("row"))), "row")))
    tasks = comparisons(members.select("node", "copies", "size", "comp"), threshold, total).join(grams, "node").select("pair", "side", "node", "copies", "grams")
    found = materialise(tasks.groupBy("pair").applyInPandas(lambda g: compare(g, threshold), "node long, links long, parent long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    merged = materialise(components(found.filter("node <> parent").select("node", "parent"), "node", "parent"))
    # A class is named by the least id of its members, which needn't be that of its least node, and may be that of another class where ids repeat.
    ids = merged.join(classes.select("node", "rep"), "node")
    names = ids.groupBy("component").agg(F.min(F.struct("rep", "node")).alias("first"), F.count("*").alias("n"))
    named = attach(ids, materialise(names), "component", "n", total).select("node", "first")
    own = F.struct("rep", "node")
    final = classes.join(links, "node", "left").join(named, "node", "left")
    final = materialise(final.select("fp", "rep", "copies", F.coalesce("first", own).alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    result = attach(prints.select("row", "doc_id", "fp"), final, "fp", "copies", total)
    real, usable = F.col("doc_id").isNotNull(), F.col("doc_id").isNotNull() & F.col("first").isNotNull()
    return result.select(
        "row", "doc_id", F.when(real, F.coalesce("first.rep", "doc_id")).alias("class_id"), F.when(real, F.coalesce("rep", "doc_id")).alias("copy_id"),
        F.when(real, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), (~usable | (F.col("row") == F.col("first.node"))).alias("stays"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, copy_id, n_links."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return linked(materialise(rows), threshold, recall).select("doc_id", "class_id", "copy_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, with their columns, but of each class only one row, the first by id (null ids and texts without words all stay)."""
    names = docs.columns
    own = [f"__c{i}" for i in range(len(names))]  # no name of docs can clash with what is added
    column = dict(zip(names, own, strict=True))
    whole = materialise(docs.toDF(*own).withColumn("__row", F.monotonically_increasing_id()))
    rows = whole.select(F.col("__row").alias("row"), F.col(column[id_col]).cast("long").alias("doc_id"), F.col(column[text_col]).cast("string").alias("text"))
    gone = materialise(linked(rows).filter("not stays").select(F.col("row").alias("__row")))
    return whole.join(small(gone), "__row", "left_anti").select(*(F.col(column[c]).alias(c) for c in names))
