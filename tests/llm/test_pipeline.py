"""The corpus queries against their SQL, and the pipeline against brute force on a small fixture."""

import hashlib
import re
from collections import Counter

import pytest

import corpus_pipeline
from peakloom.llm import queries as Q
from peakloom.llm.common import made
from tests.llm.test_operators import brute_links, norm, odd_docs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(Q.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    rel = duck.sql(Q.ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    at = [rel.columns.index(c) for c in names]
    assert sorted(repr([r[c] for c in names]) for r in df.collect()) == sorted(repr([r[i] for i in at]) for r in rel.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "source_mix", "bpe_encode"]
    (_, toxic), (_, exact), (_, near), (_, mix), (_, encode) = corpus_pipeline.STAGES
    a = toxic(spark, docs, SF)
    scores = {r.doc_id for r in Q.op2_toxicity(spark, SF).filter("predicted = 0").collect()}
    assert {r.doc_id for r in a.collect()} == scores
    b = exact(spark, a, SF).cache()
    first = {}
    for r in a.collect():
        first[norm(r.text)] = min(r.doc_id, first.get(norm(r.text), r.doc_id))
    assert {r.doc_id for r in b.collect()} == set(first.values())
    rows = [(r.doc_id, r.text) for r in b.collect()]
    c = near(spark, b, SF).cache()
    assert {r.doc_id for r in c.collect()} == {x for x, _ in brute_links(rows).values()}
    d = mix(spark, c, SF).cache()
    assert a.columns == b.columns == c.columns == d.columns == docs.columns
    taken = {r.doc_id: r.taken for r in Q.mixing.mixed_sizes(c).collect() if r.taken}
    words = Counter()
    for r in d.collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.n_chars == len(r.text)
    assert words == taken
    e = encode(spark, d, SF)
    assert sorted(r.decoded_sha256 for r in e.collect()) == sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in d.collect())


def tables(spark, folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_run_on_odd_documents(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeats and clashing columns through all stages, against a plain statement of them."""
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    sf = tables(spark, tmp_path, odd_docs(spark), labels)
    before = made()
    got = corpus_pipeline.run(spark, sf).collect()
    assert len(made()) == len(before) + 1  # what the last stage reads
    # Exact copies of 1 (2, 2 and the null id) and of 3 (4 and the null row) go; 6 is near 5, and 8 near 7.
    sizes = {1: 3, 3: 0, 5: 60_000, 7: 3}
    seen = Counter()
    for r in got:
        assert r.n_tokens > 0 and r.doc_id in sizes
        seen[r.doc_id] += 1
    mixed = {r.doc_id: r.taken for r in Q.mixing.mixed_sizes(odd_docs(spark).filter("doc_id in (1, 3, 5, 7)")).collect()}
    assert {i for i, n in mixed.items() if n} == set(seen)
    assert seen[5] >= mixed[5] // 1024 and all(n <= 3 * sizes[i] for i, n in mixed.items())


def test_run_keeps_other_documents_of_an_id(spark, tmp_path):
    """Near copies go by row: a document that only shares its id with one stays."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    docs = spark.createDataFrame([(3, a, "s"), (7, a + " tail", "s"), (7, b, "s"), (9, c, "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r.decoded_sha256 for r in corpus_pipeline.run(spark, tables(spark, tmp_path, docs, labels)).collect()}
    assert got == {hashlib.sha256(t.encode()).hexdigest() for t in (a, b, c)}


def test_run_on_empty_tables(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, odd_docs(spark).filter("false"), labels)).collect() == []
