"""Filter interaction audit: Walsh-Hadamard sums of failure masks.

A document's mask says which of five filters it fails. A part's documents are aggregated to 32 signed parity sums for each class of labels (for a set s of
filters the sum of +1 or -1 by whether it fails an even or odd number of s): what shuffles is 32 sums for each task, part and class. The
transform is its own inverse but for a factor of 32, so the counts of all masks come back exactly; whatever depends on the filters' order is then
a sum over masks, for all 120 orders, in a part's own row. A document that fails n filters is removed by each of them first in 120 / n orders,
which gives Shapley values without the orders.

Texts are read once. A text stands for itself by its SHA-256; those that are there more than once are found by hash, with partial counts, and the
hashes of frequent texts meet a broadcast table (common.attach), so no task holds all copies of a text.

Result of audit(), one row per part, order and step: see COLUMNS. Defined cases: a null text is an empty text, and a null part the empty string;
a row with a null id never fails E (it has no smaller id's text) and is no smaller id for others; rows that repeat an id are documents of their own; of labels that
repeat an id any 1 counts, null labels are 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach, materialise

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
WORD, CAPITAL, ODD_SIGN = r"[^\x20\x09-\x0D]+", "[A-Z]", "[#$%&*|]"
MASKS = 1 << len(FILTERS)
ORDERS = 120
COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: The classes of documents that are counted.
CLASSES = ("every", "good", "toxic")


def text_mask(text: Column) -> Column:
    """The bits of A to D for a text."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    # A lambda's variable keeps the words from being found twice.
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    few = F.transform(F.array(counts), lambda c: F.when(c["n"] < LEAST_WORDS, 1).otherwise(0) + F.when(100 * c["distinct"].cast("long") < DISTINCT_PERCENT * c["n"].cast("long"), 2).otherwise(0))[0]
    capitals = F.regexp_count(text, F.lit(CAPITAL)).cast("long") * 100 > F.length(text).cast("long") * CAPITAL_PERCENT
    return (few + F.when(capitals, 4).otherwise(0) + F.when(text.rlike(ODD_SIGN), 8).otherwise(0)).cast("int")


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, part, mask (of all five filters)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = materialise(rows.select("doc_id", "part", text_mask(F.col("text")).alias("own"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("hash")))
    texts = rows.groupBy("hash").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    met = attach(rows, materialise(texts), "hash", "n", rows.count())
    again = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return met.select("doc_id", "part", (F.col("own") + F.when(again, 16).otherwise(0)).alias("mask"))


def classified(found: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic and n. Labels are broadcast if they are few; else equal documents of an id meet them together."""
    few = labels.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    known = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("__id")).agg(one("quality"), one("toxic"))
    rows = found.withColumn("n", F.lit(1).cast("long")) if few else found.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    known = F.broadcast(known) if few else known
    met = rows.join(known, rows["doc_id"] == known["__id"], "left")
    return met.select("part", "mask", "n", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def sign(a: Column, b: Column) -> Column:
    return 1 - 2 * (F.bit_count(a.bitwiseAND(b)) % 2)


def parity_sums(rows: DataFrame) -> DataFrame:
    """One row per part: for each class an array of the signed sums, by set of filters."""
    sums = [F.sum(sign(F.col("mask"), F.lit(s)) * F.col("n")).alias(f"s{s}") for s in range(MASKS)]
    by = rows.groupBy("part", "good", "toxic").agg(*sums).select("part", "good", "toxic", F.array(*(f"s{s}" for s in range(MASKS))).alias("w"))
    of = lambda c, s: F.sum(F.col("w")[s] * (F.lit(1) if c == "every" else F.col(c)))
    return by.groupBy("part").agg(*(F.array(*(of(c, s) for s in range(MASKS))).alias(c) for c in CLASSES))


def cells(sums: DataFrame) -> DataFrame:
    """One row per part: for each class an array of documents, by mask. The inverse of parity_sums."""
    sets = F.sequence(F.lit(0), F.lit(MASKS - 1))
    back = lambda w: F.transform(sets, lambda m: F.aggregate(sets, F.lit(0).cast("long"), lambda a, s: a + sign(m, s) * F.get(w, s), lambda a: F.shiftright(a, len(FILTERS))))
    return sums.select("part", *(back(F.col(c)).alias(c) for c in CLASSES))


def steps() -> Column:
    """All orders and steps, a constant: filter_order, step, own (the filter's bit), before (those of the filters before it)."""
    bits = {letter: 1 << i for i, letter in enumerate(FILTERS)}
    rows = [{"filter_order": "".join(o), "step": k + 1, "own": bits[o[k]], "before": sum(bits[x] for x in o[:k])} for o in permutations(FILTERS) for k in range(len(FILTERS))]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, own: int, before: int>>")


def evaluate(counts: DataFrame) -> DataFrame:
    """COLUMNS from cells()."""
    sets = F.sequence(F.lit(0), F.lit(MASKS - 1))
    per = counts.withColumn("x", F.explode(steps())).select("*", "x.*")
    own, before = F.col("own"), F.col("before")
    total = lambda c, at: F.aggregate(F.filter(sets, at), F.lit(0).cast("long"), lambda a, m: a + F.get(F.col(c), m))
    fails, passed = lambda m: m.bitwiseAND(own) != 0, lambda m: m.bitwiseAND(before) == 0
    first = lambda m: fails(m) & passed(m)
    shapley = F.aggregate(F.filter(sets, fails), F.lit(0).cast("long"), lambda a, m: a + F.get(F.col("every"), m) * (F.lit(ORDERS) / F.bit_count(m)).cast("long"))
    found = {
        "kept": total("every", lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0),
        "removed": total("every", first),
        "redundant": total("every", lambda m: fails(m) & ~passed(m)),
        "unique_fails": F.get(F.col("every"), own),
        "good_lost": total("good", first),
        "toxic_lost": total("toxic", first),
        "shapley": shapley,
    }
    return per.select("part", "filter_order", "step", *(c.alias(name) for name, c in found.items()))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step (COLUMNS)."""
    return evaluate(cells(parity_sums(classified(masks(docs), labels))))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
d AS (SELECT part, len(words) < 100 AS fa, 100 * len(list_distinct(words)) < 80 * len(words) AS fb,
  100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) AS fc, regexp_matches(text, '[#$%&*|]') AS fd, coalesce(doc_id > least, false) AS fe,
  coalesce(l.quality, 0) = 1 AS good, coalesce(l.toxic, 0) = 1 AS toxic
  FROM w LEFT JOIN (SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS quality, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id) l ON l.id = w.doc_id),
c AS (SELECT part, {'A': fa, 'B': fb, 'C': fc, 'D': fd, 'E': fe} AS f, fa::INT + fb::INT + fc::INT + fd::INT + fe::INT AS n, count(*) AS every, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT o AS filter_order, CAST(step AS INT) AS step, substr(o, step, 1) AS own, substr(o, 1, step - 1) AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)),
e AS (SELECT part, filter_order, step, n, every, good, toxic, CASE own WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END AS fails,
  (f.A AND contains(before, 'A')) OR (f.B AND contains(before, 'B')) OR (f.C AND contains(before, 'C')) OR (f.D AND contains(before, 'D')) OR (f.E AND contains(before, 'E')) AS gone FROM c, s)
SELECT part, filter_order, step, CAST(coalesce(sum(every) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept, CAST(coalesce(sum(every) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(every) FILTER (fails AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(every) FILTER (fails AND n = 1), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(every * (120 // greatest(n, 1))) FILTER (fails), 0) AS BIGINT) AS shapley
FROM e GROUP BY ALL
"""
