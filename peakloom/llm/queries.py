"""The queries of the corpus operators and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, exact_dedup, licenses, media, mixing, negatives, ngram_join, packing, quotes, secret_scan, toxicity, url_filter

#: The rules of op8 as (verdict, host, path).
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions")


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(_table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op9_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(_table(spark, sf_dir, "conversations"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.usable(_table(spark, sf_dir, "embeddings"), label=label), F.col("id") % 100 == 0)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_ngram_jaccard_join, op2_toxicity, op3_bpe_codec, op4_exact_dedup, op5_license_scan, op6_media_columns, op7_source_mix, op8_url_filter, op9_quote_links, op10_secret_scan, op11_packing, op12_hard_negatives, op13_filter_audit, pipeline)
}

_OP4 = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

_OP7 = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS src FROM docs GROUP BY source),
s1 AS (SELECT *, CAST(src % 3 + 1 AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s0),
s2 AS (SELECT *, cap / weight AS stop FROM s1),
s3 AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY stop, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY stop, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM s2),
s4 AS (SELECT *, coalesce((SELECT lev FROM s3 AS x WHERE x.lev <= x.stop ORDER BY x.stop, x.src LIMIT 1), 0) AS level FROM s3),
s AS (SELECT source, src, source_size, least(cap, level * weight) AS target, least(3 * source_size, CAST(floor(least(cap, level * weight) + 0.5) AS BIGINT)) AS words FROM s4),
k AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * blocks + ((words % source_size) + 1023) // 1024 END AS slots FROM (SELECT *, (source_size + 1023) // 1024 AS blocks FROM s)),
total AS (SELECT CAST(coalesce(sum(slots), 0) AS BIGINT) AS total FROM k),
parts AS (SELECT src, CAST(floor(CAST(cum - slots AS DOUBLE) / greatest(total, 1)::DOUBLE * 2147483648) AS BIGINT) AS lo, CAST(floor(CAST(cum AS DOUBLE) / greatest(total, 1)::DOUBLE * 2147483648) AS BIGINT) AS hi
  FROM (SELECT *, sum(slots) OVER (ORDER BY src) AS cum FROM k), total),
points AS (SELECT slot, ((slot % 2147483648) * 1327217885) % 2147483648 AS u FROM (SELECT unnest(range(total)) AS slot FROM total)),
drawn AS (SELECT slot, src, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS rank FROM points JOIN parts ON u >= lo AND u < hi),
got AS (SELECT src, count(*) AS got FROM drawn GROUP BY src),
short AS (SELECT src, unnest(range(coalesce(got, 0), slots)) AS rank FROM k LEFT JOIN got USING (src)),
slots AS (SELECT slot, src, rank FROM drawn JOIN k USING (src) WHERE rank < slots
  UNION ALL SELECT total + row_number() OVER (ORDER BY rank, src) - 1, src, rank FROM short, total),
takes AS (SELECT slot, src, rank % blocks AS block, least(1024, source_size - (rank % blocks) * 1024, words - (rank // blocks) * source_size - (rank % blocks) * 1024) AS takes FROM slots JOIN k USING (src)),
p AS (SELECT d.rid, d.doc_id, d.size, s.src, s.source_size, s.target,
  CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size, d.rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM docs d JOIN s ON s.source IS NOT DISTINCT FROM d.source),
cut AS (SELECT rid, src, place, size, unnest(range(place // 1024, (place + size - 1) // 1024 + 1)) AS block FROM p WHERE size > 0),
met AS (SELECT rid, slot, least(place + size, (block + 1) * 1024, block * 1024 + takes) - greatest(place, block * 1024) AS n FROM cut JOIN takes USING (src, block)),
sums AS (SELECT rid, CAST(sum(n) AS BIGINT) AS taken, min(slot) AS first_slot, count(*) AS n_slots FROM met WHERE n > 0 GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, CAST(first_slot AS BIGINT) AS first_slot, coalesce(n_slots, 0) AS n_slots FROM p LEFT JOIN sums USING (rid)
"""

_OP8 = r"""
WITH rules(rule, verdict, rh, rp) AS (VALUES ('com/en/', 'block', 'com', '/en/'), ('example.com/en/7', 'allow', 'example.com', '/en/7'),
  ('net/de/', 'block', 'net', '/de/'), ('example.net/de/8', 'block', 'example.net', '/de/8'), ('org/es/', 'block', 'org', '/es/')),
u AS (SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM p LEFT JOIN rules r ON (p.host = r.rh OR ends_with(p.host, '.' || r.rh)) AND starts_with(p.path, r.rp)
QUALIFY row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.rule) DESC NULLS LAST, r.rule) = 1
"""

ORACLE_SQL: dict[str, str] = {"op4_exact_dedup": _OP4, "op7_source_mix": _OP7, "op8_url_filter": _OP8, "op9_quote_links": quotes.ORACLE_SQL, "op12_hard_negatives": negatives.ORACLE_SQL, "op13_filter_audit": audit.ORACLE_SQL}
