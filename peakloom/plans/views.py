"""The given tables as tables of this domain: fragments, peaks, promoters, cells, clusters, reads.

VIEWS has the same in DuckDB's SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, barcode, chrom, start, end, score, strand (null)."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag AS sample", "CAST(l_partkey AS STRING) AS barcode", "IF(l_suppkey % 6 = 0, 'chrM', concat('chr', l_suppkey % 6)) AS chrom", "CAST(floor(l_extendedprice * 10) AS BIGINT) AS start",
        "CAST(floor(l_extendedprice * 10) AS BIGINT) + 31 + CAST(l_quantity * 10 AS BIGINT) AS end", "CAST(l_linenumber AS BIGINT) AS score", "CAST(NULL AS BOOLEAN) AS strand",
    )


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, flag, chrom, start, end, tlen, mapq, quality, order."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_partkey, ':', l_orderkey, ':', l_linenumber) AS name", "CASE l_linenumber % 4 WHEN 0 THEN 99 WHEN 1 THEN 163 WHEN 2 THEN 73 ELSE 1123 END AS flag",
        "concat('chr', l_suppkey % 3) AS chrom", "CAST(floor(l_extendedprice / 2000) AS BIGINT) * 100 AS start", "CAST(floor(l_extendedprice / 2000) AS BIGINT) * 100 + 50 AS end",
        "CAST(l_quantity AS BIGINT) % 3 * 480 + 40 AS tlen", "CAST(l_discount * 1000 AS INT) AS mapq", "CAST(l_tax * 100 AS BIGINT) AS quality", "l_orderkey * 10 + l_linenumber AS order",
    )


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """peak, cluster, chrom, start, end, name, signal, pvalue, summit."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS peak", "concat('C', o_custkey % 4 + 1) AS cluster", "concat('chr', o_custkey % 5 + 1) AS chrom", "CAST(floor(o_totalprice * 2) AS BIGINT) AS start", "CAST(floor(o_totalprice * 2) AS BIGINT) + 400 AS end",
        "lpad(CAST(o_orderkey AS STRING), 12, '0') AS name", "o_totalprice / 1000 AS signal", "CAST(o_orderkey % 97 AS DOUBLE) AS pvalue", "o_orderkey % 400 AS summit",
    )


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("concat('chr', c_custkey % 5 + 1) AS chrom", "c_custkey * 450 AS start", "c_custkey * 450 + 700 AS end")


def promoters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """feature, gene, chrom, start, end, strand."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS feature", "p_brand AS gene", "concat('chr', p_partkey % 5 + 1) AS chrom", "p_partkey * 500 - 2000 AS start", "p_partkey * 500 + 2001 AS end", "p_size % 2 = 0 AS strand")


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, chrom, strand, left, right, transcripts."""
    t = "transform(sequence(0, p_size % 3), i -> struct(p_partkey * 500 + i * 40 AS left, p_partkey * 500 + i * 40 + 90 AS right, p_size % 2 = 0 AS strand, IF((p_partkey + i) % 3 = 0, 'Coding', 'NonCoding') AS type)) AS transcripts"
    return table(spark, sf_dir, "part").selectExpr("concat('Gene', p_partkey) AS gene", "concat('chr', p_partkey % 5 + 1) AS chrom", "p_size % 2 = 0 AS strand", "p_partkey * 500 AS left", "p_partkey * 500 + 300 AS right", t)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """barcode, sample, cluster, x, y: a cell for each customer. There are fewer of them than barcodes, which are parts."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS barcode", "concat('S', c_custkey % 3) AS sample", "concat('C', c_custkey * c_custkey % 7 + 1) AS cluster", "CAST(c_custkey % 50 AS DOUBLE) AS x", "c_acctbal AS y"
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """barcode, sample, dup_rate, mito_rate, tsse, uniq, doublet."""
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS barcode", "concat('S', p_partkey % 3) AS sample", "IF(p_partkey % 5 = 0, NULL, (p_partkey % 50) / 100.0D) AS dup_rate", "(p_partkey % 20) / 100.0D AS mito_rate",
        "p_retailprice / 100 AS tsse", "p_partkey % 900 AS uniq", "IF(p_partkey % 4 = 0, NULL, (p_partkey % 10) / 10.0D) AS doublet",
    )


VIEWS: dict[str, str] = {
    "fr": """SELECT l_returnflag AS sample, CAST(l_partkey AS VARCHAR) AS barcode, CASE WHEN l_suppkey % 6 = 0 THEN 'chrM' ELSE 'chr' || (l_suppkey % 6) END AS chrom, CAST(floor(l_extendedprice * 10) AS BIGINT) AS cstart,
      CAST(floor(l_extendedprice * 10) AS BIGINT) + 31 + CAST(l_quantity * 10 AS BIGINT) AS cend, CAST(l_linenumber AS BIGINT) AS score FROM lineitem""",
    "rd": """SELECT l_partkey || ':' || l_orderkey || ':' || l_linenumber AS name, CAST(CASE l_linenumber % 4 WHEN 0 THEN 99 WHEN 1 THEN 163 WHEN 2 THEN 73 ELSE 1123 END AS INT) AS flag, 'chr' || (l_suppkey % 3) AS chrom,
      CAST(floor(l_extendedprice / 2000) AS BIGINT) * 100 AS cstart, CAST(floor(l_extendedprice / 2000) AS BIGINT) * 100 + 50 AS cend, CAST(l_quantity AS BIGINT) % 3 * 480 + 40 AS tlen,
      CAST(trunc(l_discount * 1000) AS INT) AS mapq, CAST(trunc(l_tax * 100) AS BIGINT) AS quality, l_orderkey * 10 + l_linenumber AS ord FROM lineitem""",
    "pk": """SELECT o_orderkey AS peak, 'C' || (o_custkey % 4 + 1) AS cluster, 'chr' || (o_custkey % 5 + 1) AS chrom, CAST(floor(o_totalprice * 2) AS BIGINT) AS cstart, CAST(floor(o_totalprice * 2) AS BIGINT) + 400 AS cend,
      lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS name, o_totalprice / 1000 AS signal, CAST(o_orderkey % 97 AS DOUBLE) AS pvalue, o_orderkey % 400 AS summit FROM orders""",
    "bl": "SELECT 'chr' || (c_custkey % 5 + 1) AS chrom, c_custkey * 450 AS cstart, c_custkey * 450 + 700 AS cend FROM customer",
    "pr": "SELECT p_partkey AS feature, p_brand AS gene, 'chr' || (p_partkey % 5 + 1) AS chrom, p_partkey * 500 - 2000 AS cstart, p_partkey * 500 + 2001 AS cend, p_size % 2 = 0 AS strand FROM part",
    "gn": "SELECT 'Gene' || p_partkey AS gene, 'chr' || (p_partkey % 5 + 1) AS chrom, p_size % 2 = 0 AS strand, p_partkey * 500 AS lft, p_partkey * 500 + 300 AS rgt, p_partkey, p_size FROM part",
    "tx": "SELECT gene, chrom, strand, p_partkey * 500 + i * 40 AS lft, p_partkey * 500 + i * 40 + 90 AS rgt, (p_partkey + i) % 3 = 0 AS coding FROM (SELECT *, unnest(range(0, p_size % 3 + 1)) AS i FROM gn)",
    "cl": "SELECT CAST(c_custkey AS VARCHAR) AS barcode, 'S' || (c_custkey % 3) AS sample, 'C' || (c_custkey * c_custkey % 7 + 1) AS cluster, CAST(c_custkey % 50 AS DOUBLE) AS x, c_acctbal AS y FROM customer",
    "qc": """SELECT CAST(p_partkey AS VARCHAR) AS barcode, 'S' || (p_partkey % 3) AS sample, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE (p_partkey % 50) / 100.0::DOUBLE END AS dup_rate, (p_partkey % 20) / 100.0::DOUBLE AS mito_rate,
      p_retailprice / 100 AS tsse, p_partkey % 900 AS uniq, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE (p_partkey % 10) / 10.0::DOUBLE END AS doublet FROM part""",
    "cut": "SELECT sample, barcode, chrom, unnest([cstart, cend - 1]) AS pos FROM fr WHERE chrom <> 'chrM'",
    "hit": "SELECT c.sample, c.barcode, k.peak, k.cluster AS pcluster FROM cut c JOIN pk k ON c.chrom = k.chrom AND c.pos >= k.cstart AND c.pos < k.cend",
    "mat": "SELECT barcode, peak, count(*) AS n FROM hit GROUP BY ALL",
    "gmat": "SELECT c.barcode, p.feature, count(*) AS n FROM cut c JOIN pr p ON c.chrom = p.chrom AND c.pos >= p.cstart AND c.pos < p.cend GROUP BY ALL",
}
