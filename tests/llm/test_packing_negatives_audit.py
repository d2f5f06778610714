"""Packing, hard negatives and the filter audit against brute force and on odd inputs."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from peakloom.llm import audit, bpe, negatives, packing
from peakloom.llm import queries as Q
from tests.llm.test_operators import empty_docs, odd_docs

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def check_packed(rows, texts, window=1024):
    """rows hold every id of the texts in one piece, gapless in sequences that need no padding."""
    library = Tokenizer.from_file(TOKENIZER)
    want = Counter(((i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in texts))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, own in pieces.items():
        whole = [ids for (j, ids), n in want.items() for _ in range(n) if j == i]
        assert sum(r.length for r in own) == sum(map(len, whole)) and {r.doc_tokens for r in own} == set(map(len, whole))
        for r in own:
            of = [ids for ids in whole if len(ids) == r.doc_tokens]
            assert any(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == zlib.crc32(bytes(r.ids)) for ids in of)
        if len(whole) == 1:
            at = 0
            for start, length in sorted((r.start, r.length) for r in own):
                assert start == at
                at += length
            assert at == len(whole[0])
    assert set(pieces) == {i for i, _ in texts}
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert sum(1 for own in sequences.values() if sum(n for _, n in own) < window) <= 10


def test_packing_holds_every_id_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7, "doc_id").cache()
    rows = packing.pack(docs).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()])
    key = lambda r: tuple(r)
    assert sorted(map(key, rows)) == sorted(map(key, packing.pack(docs).collect()))  # reruns agree
    found = {(r.doc_id, r.start): r for r in packing.digests(docs).collect()}
    assert all(found[r.doc_id, r.start].ids_crc32 == zlib.crc32(bytes(r.ids)) for r in rows)


def test_packing_odd_documents(spark, monkeypatch):
    docs = odd_docs(spark)
    check_packed(packing.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert packing.pack(empty_docs(spark)).count() == 0
    from peakloom import storage

    monkeypatch.setattr(storage, "BROADCAST_ROWS", 0)  # the tasks' counts shuffle
    check_packed(packing.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_packing_one_frequent_length(spark):
    """A third of all documents, and then all, have one length that doesn't divide the window."""
    docs = spark.range(0, 900, numPartitions=5).select(F.col("id").alias("doc_id"), F.expr("repeat(' the', if(id % 3 > 0, 599, int(id % 1000) + 1))").alias("text"))
    check_packed(packing.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    same = docs.filter("doc_id % 3 > 0")
    check_packed(packing.pack(same).collect(), [(r.doc_id, r.text) for r in same.collect()])


def best_total(lengths, room):
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= room}
    return max(sums)


def test_filling_is_nearest_to_the_room():
    r = random.Random(3)
    for _ in range(300):
        lengths = [r.randrange(1, 60) for _ in range(r.randrange(12))]
        have, room = Counter(lengths), r.randrange(0, 130)
        used = packing.fill(dict(have), room)
        assert all(n <= have[x] for x, n in used.items())
        assert sum(x * n for x, n in used.items()) == best_total(lengths, room)


@pytest.mark.parametrize("counts", [{}, {1: 7}, {600: 5}, {600: 50_000, 3: 4}, {1023: 10}, {513: 3, 1024: 2}, dict.fromkeys(range(1, 1025), 3)])
def test_plan_uses_every_length_up(counts):
    taken, filled = Counter(), Counter()
    for length, first, n, cut, size, at, times, sequence, _ in packing.windows_for(counts):
        for i in range(n):
            taken[length, first + i] += size
            filled[sequence + (at + i) // times] += size
        assert cut + size <= length
    assert taken == {(x, i): x for x, n in counts.items() for i in range(n)}
    assert all(n == 1024 or n & (n - 1) == 0 for n in filled.values()) and sum(n < 1024 for n in filled.values()) <= 10


def test_fast_encoder_equals_the_library():
    library, encode = Tokenizer.from_file(TOKENIZER), bpe.fast_encoder(open(TOKENIZER, encoding="utf-8").read())
    r = random.Random(1)
    odd = "".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x2000, 0x2100), r.randrange(0x3000, 0x3100)])) for _ in range(5000))
    for text in ["", " <|endoftext|> x<|endoftext|>", "a" * 20_000, " " * 20_000 + "x", "　\x85\xa0 x\x1c\x1d y", "½²٣Ⅷ ١٢ 12", "\n\n\n  a", odd]:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


# Hard negatives


def brute_negatives(rows, is_anchor, positives=5, negatives_=10):
    """rows: (id, label, vector of whole numbers)."""
    width = max((len(q) for _, _, q in rows), default=0)
    rows = [(i, l, [*q, *[0] * (width - len(q))]) for i, l, q in rows]
    out = Counter()
    for a, (ia, la, qa) in enumerate(rows):
        if not is_anchor(ia):
            continue
        scores = [(sum(x * y for x, y in zip(qa, q, strict=True)), i, l, n) for n, (i, l, q) in enumerate(rows)]
        for s, p, _, _ in sorted((x for x in scores if x[3] != a and x[2] == la), key=lambda x: (-x[0], x[1]))[:positives]:
            fit = sorted((x for x in scores if x[2] != la and 30 * s <= 100 * x[0] <= 90 * s), key=lambda x: (-x[0], x[1]))[:negatives_]
            for rank, x in enumerate(fit, 1):
                out[ia, p, rank, x[1], s, x[0]] += 1
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, row int, q string")


@pytest.mark.parametrize("sample", [0, 64])
def test_negatives_equal_brute_force(spark, monkeypatch, sample):
    monkeypatch.setattr(negatives, "ANCHORS", 16)  # several blocks
    monkeypatch.setattr(negatives, "LEAF", 8)
    monkeypatch.setattr(negatives, "SAMPLE", sample)
    r = np.random.default_rng(2)
    centres = r.normal(size=(6, 8))
    x = (centres[r.integers(0, 6, 700)] + 0.3 * r.normal(size=(700, 8))).astype(np.float32)
    x[100:330] = x[100]  # a third of the rows are the same
    rows = [(i, v.tolist(), int(r.integers(0, 3)), "", 1, "") for i, v in enumerate(x)]
    rows += [(700, [0.0] * 8, 1, "", 1, ""), (20, rows[20][1], 1, "", 1, ""), (40, [], 2, "", 1, ""), (60, [1.5], 0, "", 1, "")]
    rows += [(None, x[0].tolist(), 1, "", 1, ""), (80, None, 1, "", 1, ""), (100, x[3].tolist(), None, "", 1, ""), (120, [math.nan] * 8, 1, "", 1, ""), (140, [math.inf, 1.0], 1, "", 1, ""), (160, [None, 1.0], 1, "", 1, "")]
    usable = negatives.usable(vectors(spark, rows).repartition(5))
    got = Counter(tuple(g) for g in negatives.mine(usable, F.col("id") % 20 == 0).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    own = [(i, l, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, l, *_ in rows if None not in (i, l, v) and all(c is not None and math.isfinite(c) for c in v)]
    assert got == brute_negatives(own, lambda i: i % 20 == 0)


def test_negatives_of_no_rows(spark):
    usable = negatives.usable(vectors(spark, []))
    assert negatives.mine(usable, F.col("id") % 20 == 0).collect() == []
    one = negatives.usable(vectors(spark, [(0, [1.0], 1, "", 1, ""), (1, [2.0], 2, "", 1, "")]))
    assert negatives.mine(one, F.col("id") % 20 == 0).collect() == []


def test_node_pairs_are_pruned_and_none_is_lost():
    """Of well separated groups most pairs of leaves are dropped, and every pair within the bounds is in a pair that is kept."""
    r = np.random.default_rng(0)
    centres = 1000 * r.normal(size=(20, 16))
    a, b = (np.round(centres[r.integers(0, 20, n)] + 10 * r.normal(size=(n, 16))).astype(np.int64) for n in (300, 2000))
    ta, tb = negatives.build(a, 16), negatives.build(b, 16)
    scores = negatives.products(a, b)
    low = np.sort(scores, axis=1)[:, -10]
    pairs = list(negatives.leaf_pairs(ta, tb, negatives.over_nodes(ta, low, np.minimum), negatives.over_nodes(ta, np.full(300, negatives.NEVER), np.maximum)))
    met = np.zeros(scores.shape, bool)
    for i, leaves in pairs:
        for j in leaves:
            met[np.ix_(ta.order[ta.start[i] : ta.end[i]], tb.order[tb.start[j] : tb.end[j]])] = True
    assert met[scores >= low[:, None]].all()
    assert met.mean() < 0.5


def test_products_are_exact():
    a = np.array([[2**31, 3], [-(2**30), 5]], np.int64)
    assert negatives.products(a, a).tolist() == [[2**62 + 9, -(2**61) + 15], [-(2**61) + 15, 2**60 + 25]]
    with pytest.raises(OverflowError):
        negatives.products(a * 4, a)


def test_matrix_fills_up_with_zeros():
    column = pa.array([[1, 2], [], [3]], pa.list_(pa.int64()))
    assert negatives.matrix(column, 2).tolist() == [[1, 2], [0, 0], [3, 0]]
    assert negatives.matrix(column.slice(1), 2).tolist() == [[0, 0], [3, 0]]


# Filter audit


def brute_audit(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    failed = []
    for i, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and t in least and i > least[t]}
        failed.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in failed}:
        own = [x for x in failed if x[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            gone = [False] * len(own)
            for step, f in enumerate(order, 1):
                removed = [n for n, x in enumerate(own) if f in x[1] and not gone[n]]
                redundant = sum(f in x[1] and gone[n] for n, x in enumerate(own))
                for n in removed:
                    gone[n] = True
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [len(own) - sum(gone), len(removed), redundant, sum(x[1] == {f} for x in own), sum(own[n][2] for n in removed), sum(own[n][3] for n in removed)]
        for (p, o, s), row in out.items():
            if p == part:
                row.append(shapley[o[s - 1]])
    return out


def test_audit_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in audit.audit(docs, labels).collect()}
    assert got == brute_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_audit_odd_documents(spark, monkeypatch, broadcast):
    monkeypatch.setattr(audit, "BROADCAST_ROWS", broadcast)
    long = "Wort " * 5000 + "End"
    rows = [(1, "A b #", "de"), (2, "A b #", None), (2, "A b #", "de"), (None, "A b #", ""), (None, None, None), (3, "", "de"), (4, None, "fr"), (5, long, "fr"), (6, long, "fr"), (7, " \t\x0b ", "fr"), (8, "é" * 9 + "A", "fr"), (9, "é" * 8 + "A", "x"), (10, " ".join(f"w{i}" for i in range(100)), "x")]
    docs = spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], "doc_id long, text string, lang string, part string, mask int, n int, hash int")
    marks = [(1, 1, 0), (2, 0, None), (2, None, 1), (2, 1, 1), (None, 1, 1), (5, 1, 1), (99, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in audit.audit(docs, labels).collect()}
    assert got == brute_audit(rows, marks)
    assert audit.audit(docs.filter("false"), labels).columns == list(audit.COLUMNS)
    assert audit.audit(docs.filter("false"), labels).collect() == []


def test_queries_run(spark):
    got = Q.op12_hard_negatives(spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and got.count()
    assert Q.op11_packing(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
