"""Scalar functions, all on the JVM but chi2_quantile."""

from __future__ import annotations

from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..config import MITOCHONDRIAL


def barcode_of(name: Column) -> Column:
    """The text before the first colon of a read's name."""
    return F.substring_index(name, ":", 1)


def tagged(barcode: Column, read: Column) -> Column:
    return F.concat_ws(":", barcode, read)


def region_name(chrom: Column, start: Column, end: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def cell_id(sample: Column, replicate: Column, barcode: Column) -> Column:
    """sample_replicate+barcode, the key of a cell across samples."""
    return F.concat(sample, F.lit("_"), replicate.cast("string"), F.lit("+"), barcode.cast("string"))


def sample_of(cell: Column) -> Column:
    """The text before the last plus sign, empty if there is none."""
    return F.regexp_extract(cell, r"^(.*)\+", 1)


def experiment_of(cell: Column) -> Column:
    return F.regexp_extract(sample_of(cell), r"^(.*)_[^_]*$", 1)


def replicate_of(cell: Column) -> Column:
    return F.regexp_extract(sample_of(cell), r"_([^_]*)$", 1)


def is_mitochondrial(chrom: Column) -> Column:
    return chrom.isin(*MITOCHONDRIAL)


def round3(x: Column) -> Column:
    """Three digits, half to even."""
    return F.bround(x, 3)


def gene_key(name: Column) -> Column:
    return F.upper(name)


def dna_to_int(seq: Column, k: int | None = None) -> Column:
    """The number that a sequence of A, C, G, T is in base 4; null if it has other letters."""
    s = F.substring(seq, 1, k) if k else seq
    return F.when(s.rlike("^[ACGT]+$"), F.conv(F.translate(s, "ACGT", "0123"), 4, 10).cast("long"))


def int_to_dna(n: Column, k: int) -> Column:
    return F.translate(F.lpad(F.conv(n.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def gc_content(seq: Column) -> Column:
    """The share of G and C, 0.5 where there is no sequence."""
    n = F.length(seq)
    return F.coalesce(F.when(n > 0, F.length(F.regexp_replace(F.upper(seq), "[^GC]", "")) / n), F.lit(0.5))


def renamed_cluster(parent: Column, name: Column) -> Column:
    """parent.n for cluster Cn of a subclustering."""
    return F.concat(parent, F.lit("."), F.regexp_replace(name, r"^.", ""))


def specificity_input(accessibility: Column) -> Column:
    return F.log2(accessibility + 1)


def rpkm(count: Column, size: Column, total: Column) -> Column:
    return count / (size / 1000.0) / (total / 1000000.0)


def empirical_p(x: Column, cdf: Column, step: Column, n: Column) -> Column:
    """The chance beyond x in a table with one entry a step; 1/n where that says 0."""
    at = F.least(F.size(cdf) - 1, F.floor(x / step).cast("int"))
    p = F.element_at(cdf, at + 1)
    return F.when(p == 0, 1.0 / n).otherwise(p)


@F.pandas_udf(DoubleType())
def chi2_quantile(q: pd.Series) -> pd.Series:
    """The quantile of the chi-squared law with one degree of freedom."""
    normal = NormalDist()
    return q.map(lambda x: None if pd.isna(x) else 0.0 if x <= 0 else float("inf") if x >= 1 else normal.inv_cdf((1 + x) / 2) ** 2)
