"""Toxicity: maximum-scoring segments of token log-odds, aggregated by extreme-value calibration.

fit() counts, over labelled training documents, in how many toxic and other documents each feature occurs;
features are words and their first PREFIXES letters. A feature's score is the log-odds ratio of
the two classes under Dirichlet priors (in proportion to the feature's overall frequency, at least
PRIOR); kept are features whose score is at least ODDS_LEAST and whose likelihood ratio G exceeds
2 log(number of features), so that about none gets there by chance. All other tokens share
one negative score, from the share of tokens that are such features in either class.

score() finds in linear time all maximal scoring segments of each text (Ruzzo and Tompa), and turns their
scores into the chance that a clean text of that length has such segments: single segments by the
extreme-value law 1 - exp(-K n e^(-lambda S)), several by the sum statistics of Karlin and Altschul.
lambda solves sum p e^(lambda s) = 1 over the clean training tokens; K is fitted to the high segments of
clean training documents. The document's score is TOLERATED / (TOLERATED + chance).

Labels are never inputs of a score; fit() takes rows whose crc32(doc_id) modulo 5 is not 0, the MAX_TRAINING
with the smallest hashes if there are more. Defined cases: a null or empty text has no tokens and score
TOLERATED / (TOLERATED + 1); documents with several labels count as toxic if one says so, null labels
don't count; without toxic training documents no feature is kept and nothing is predicted toxic;
repeated rows are scored alike; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import claim, map_arrow, materialise, release, slices

PREFIXES = (4, 5)
PRIOR, PRIOR_WEIGHT = 0.5, 10.0
ODDS_LEAST = 3.5
TOLERATED = 0.005
#: The bound of the model: labelled documents that it learns from, whose words bound its features.
MAX_TRAINING = 400_000
FOLDS = 5
#: Bytes of text that a worker takes apart at once, about.
TEXT = 1 << 20
WORDS = re.compile(r"[^\W_]+")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0


@dataclass(frozen=True)
class Model:
    features: dict[str, float]
    rest: float
    scale: float
    k: float

    def token(self, chunk: str) -> float:
        """The score of what stands between white space."""
        best = self.rest
        for word in WORDS.findall(chunk.lower()):
            for feature in features_of(word):
                best = max(best, self.features.get(feature, self.rest))
        return best


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(offsets of the texts' tokens, token codes, the distinct tokens)."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat = pc.dictionary_encode(lists.flatten())
    return lists.offsets.to_numpy(), flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.to_pylist()


def segments(scores: list[tuple[int, float]], rest: float, n: int) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of n tokens of score `rest`, but for those at the given places (ascending, positive)."""
    found: list[tuple[int, int, float, float]] = []  # start, end, sums before it and up to its end
    total, at = 0.0, 0
    for place, s in scores:
        total += rest * (place - at)
        start, left, right = place, total, total + s
        total, at, end = right, place + 1, place + 1
        # Joins the latest segment that starts lower than this one, unless that also ends as high.
        while found:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= left:
                k -= 1
            if k < 0 or found[k][3] >= right:
                break
            start, left = found[k][0], found[k][2]
            del found[k:]
        found.append((start, end, left, right))
    return [(a, b, r - x) for a, b, x, r in found]


def chance(parts: list[tuple[int, int, float]], n: int, scale: float, k: float) -> float:
    """The chance that clean text of n tokens has segments like the best r of these, for the r that makes it least."""
    if not parts:
        return 1.0
    size = math.log(max(k * n, 1e-9))
    least, total = 1.0, 0.0
    for r, s in enumerate(sorted((p[2] for p in parts), reverse=True), 1):
        total += scale * s - size
        if r == 1:
            p = -math.expm1(-math.exp(min(-total, 50.0)))
        elif total <= r:
            continue
        else:
            p = math.exp(-total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r))
        least = min(least, p * 2.0 ** min(r - 1, 1) if p < 1 else 1.0)
    return least


def training(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> DataFrame:
    """(text, toxic) of the documents to learn from."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label).alias("__y")).filter("__id is not null and __y is not null").filter(~held_out(F.col("__id")))
    known = known.groupBy("__id").agg((F.max("__y") > 0).alias("toxic"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(MAX_TRAINING)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(known), "__id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, **names: str) -> Model:
    rows = training(docs, labels, **names)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        for batch in slices(batches, column=0, most=TEXT):
            toxic = pc.fill_null(batch.column(1), False).to_numpy(zero_copy_only=False)
            offsets, codes, words = tokens(batch.column(0))
            doc = np.repeat(np.arange(len(toxic)), np.diff(offsets))
            index: dict[str, int] = {}
            pairs = [(c, index.setdefault(f, len(index))) for c, w in enumerate(words) for f in {f for x in WORDS.findall(w.lower()) for f in features_of(x)}]
            names_, out = list(index), np.zeros((2, len(index)), dtype=np.int64)
            if pairs:
                token, feature = np.array(pairs, dtype=np.int64).T
                order = np.argsort(token, kind="stable")
                token, feature = token[order], feature[order]
                first, last = np.searchsorted(token, np.arange(len(words))), np.searchsorted(token, np.arange(len(words)), side="right")
                once = np.unique(doc * len(words) + codes)
                d, c = once // len(words), once % len(words)
                n = (last - first)[c]
                each = np.repeat(first[c] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                both = np.unique(np.repeat(d, n) * len(index) + feature[each])
                for y in (0, 1):
                    out[y] = np.bincount((both % len(index))[toxic[both // len(index)] == y], minlength=len(index))
            sizes = np.bincount(toxic.astype(int), weights=np.diff(offsets), minlength=2).astype(np.int64)
            docs_ = np.bincount(toxic.astype(int), minlength=2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*names_, "", " "]), pa.array([*out[0], sizes[0], docs_[0]], pa.int64()), pa.array([*out[1], sizes[1], docs_[1]], pa.int64())], ["feature", "clean", "toxic"]
            )
        release()

    counts = materialise(map_arrow(rows, count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    whole = {r.feature: (r.clean, r.toxic) for r in counts.filter(F.col("feature").isin("", " ")).collect()}
    (n0, n1), (d0, d1) = whole.get("", (0, 0)), whole.get(" ", (0, 0))
    if not d0 or not d1:
        return Model({}, -0.01, 1.0, 1.0)
    prior = F.lit(PRIOR) + PRIOR_WEIGHT * (F.col("clean") + F.col("toxic")) / (d0 + d1)
    odds = lambda y, n: F.log((y + prior) / F.greatest(n + PRIOR_WEIGHT + 2 * PRIOR - y - prior, F.lit(PRIOR)))
    delta = odds(F.col("toxic"), d1) - odds(F.col("clean"), d0)
    many = math.log(max(counts.count(), 2))
    base = d1 / (d0 + d1)
    n = F.col("clean") + F.col("toxic")
    g = 2 * sum(F.when(y > 0, y * F.log(y / (n * share))).otherwise(0.0) for y, share in ((F.col("toxic"), base), (F.col("clean"), 1 - base)))
    scored = counts.filter(~F.col("feature").isin("", " ") & (F.col("toxic") > 1)).select("feature", "clean", "toxic", delta.alias("s"), g.alias("z")).filter((F.col("s") >= ODDS_LEAST) & (F.col("z") >= 2 * many))
    kept = scored.orderBy(F.desc("z"), "feature").collect()
    features = {r.feature: r.s for r in kept}
    words = [r for r in kept if not r.feature.endswith("*")] or kept
    q, p = sum(r.toxic for r in words) / max(n1, 1), sum(r.clean for r in words) / max(n0, 1)
    rest = min(math.log1p(-min(q, 0.5)) - math.log1p(-min(p, 0.4)), -1e-3)
    # The clean law of token scores, with half an occurrence for a feature that clean documents never have.
    law = np.array([[(r.clean + 0.5) / (n0 + 1.0), r.s] for r in words] or [[1e-6, 1.0]])
    scale = _scale(law[:, 0], law[:, 1], rest)
    draft = Model(features, rest, scale, 1.0)
    shipped = docs.sparkSession.sparkContext.broadcast(draft)
    high = 4.0 / scale

    def exceed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        m, memo = shipped.value, {}
        for batch in slices(batches, column=0, most=TEXT):
            found = expected = 0.0
            for n, parts in scan_batch(batch.column(0), m, memo):
                found += sum(s >= high for _, _, s in parts)
                expected += n * math.exp(-m.scale * high)
            yield pa.RecordBatch.from_arrays([pa.array([found]), pa.array([expected])], ["found", "expected"])

    found, expected = map_arrow(rows.filter("not toxic"), exceed, "found double, expected double").agg(F.sum("found"), F.sum("expected")).first()
    k = min(1.0, max(0.01, ((found or 0.0) + 1) / ((expected or 0.0) + 1)))
    return Model(features, rest, scale, k)


def _scale(p: np.ndarray, s: np.ndarray, rest: float) -> float:
    """The positive root of sum p e^(x s) + (1 - sum p) e^(x rest) = 1."""
    other = max(1 - p.sum(), 0.0)
    f = lambda x: float((p * np.exp(np.minimum(x * s, 600))).sum() + other * math.exp(x * rest) - 1)
    if p @ s + other * rest >= 0:
        return 0.05  # clean text has no drift: no root
    low, up = 1e-6, 1.0
    while f(up) < 0 and up < 64:
        up *= 2
    for _ in range(80):
        mid = (low + up) / 2
        low, up = (mid, up) if f(mid) < 0 else (low, mid)
    return low


def scan_batch(texts: pa.Array, model: Model, memo: dict[str, float]) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """(tokens, segments) of each text."""
    if len(memo) > 300_000:
        memo.clear()
    offsets, codes, words = tokens(texts)
    worth = np.empty(len(words))
    for i, w in enumerate(words):
        if (s := memo.get(w)) is None:
            s = memo[w] = model.token(w)
        worth[i] = s
    scores = worth[codes] if len(words) else np.empty(0)
    places = np.flatnonzero(scores > 0)
    cut = np.searchsorted(places, offsets - offsets[0])
    for i in range(len(offsets) - 1):
        start = int(offsets[i] - offsets[0])
        n = int(offsets[i + 1] - offsets[i])
        yield n, segments([(int(x) - start, float(scores[x])) for x in places[cut[i] : cut[i + 1]]], model.rest, n)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", passages: bool = False) -> DataFrame:
    """One row per document: doc_id, score; with passages also its significant ones (first token, end, score)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        m, memo = shipped.value, {}
        for batch in slices(batches, most=TEXT):
            out, where = [], []
            for n, parts in scan_batch(batch.column(1), m, memo):
                out.append(TOLERATED / (TOLERATED + chance(parts, n, m.scale, m.k)))
                where.append([{"first": a, "end": b, "score": s} for a, b, s in parts if chance([(a, b, s)], n, m.scale, m.k) <= TOLERATED])
            columns = [batch.column(0), pa.array(out, pa.float64())] + ([pa.array(where, kind)] if passages else [])
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "passages"][: len(columns)])
        release()

    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    form = f"doc_id {ids.schema[0].dataType.simpleString()}, score double"
    return map_arrow(ids, run, form + ", passages array<struct<first: long, end: long, score: double>>" * passages)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs, with their columns, but for those that are predicted toxic."""
    model = fit(docs, labels)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        m, memo = shipped.value, {}
        for batch in slices(batches, column=place, most=TEXT):
            clean = [TOLERATED / (TOLERATED + chance(parts, n, m.scale, m.k)) < 0.5 for n, parts in scan_batch(batch.column(place), m, memo)]
            yield batch.filter(pa.array(clean, pa.bool_()))
        release()

    return map_arrow(docs, run, docs.schema)
