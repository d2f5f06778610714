"""Exact dedup (native): two-pass Bloom filtering of text hashes.

The Bloom filter has CELLS_A_ROW cells a row, in blocks of 64; a hash has one block and two cells of it. Pass 1 reads
the hashes and finds the pairs of cells that two or more rows reach, with map-side combining, so a task sends a number for each distinct
hash it has and a hot text is combined before it shuffles; the cells of those pairs are the filter, packed into pages of
PAGE bits. Pass 2 looks every row up in the broadcast pages. Rows with a cell outside them are unique and
pass straight through; only the rest shuffle, by their full SHA-256, so false positives cost a little work and
never a wrong result.

A filter is at most FILTER_BYTES long. More rows than that allows are filtered in slices of the hashes, one after another, each with a filter
of its own, which is broadcast in the slice's own job and let go after it; the hashes are sorted by slice within their files, so a slice reads little else. There is no other path for large inputs.

Defined cases: a null text is an empty text; equal texts are those identical after each run of
space and \\t..\\r becomes one space; the smallest doc_id stays, null ids after all others; of rows
that repeat an id and a text, one stays; an empty table gives an empty result; extra columns pass
through, and result columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach, materialise, one_by_one

CELLS_A_ROW = 16
BLOCK, PAGE = 64, 32768
FILTER_BYTES = 128 << 20
#: Slices are ranges of so many parts of the hashes.
PARTS = 4096
#: The hashes' files have small row groups, so that a slice can skip the others.
NARROW = {"parquet.block.size": str(1 << 20)}
SPACE = r"[\x20\x09-\x0D]+"
RESULT = ("text_sha256", "keep_id", "group_size", "kept")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def blocks_for(rows: int) -> int:
    """The number of blocks of a filter for so many rows: at most FILTER_BYTES."""
    return max(PAGE // BLOCK, min(-(-CELLS_A_ROW * rows // BLOCK), FILTER_BYTES * 8 // BLOCK))


def _cells(sha: str, blocks: int) -> tuple[Column, Column, Column]:
    """The block of a hash, and its two cells of the 64."""
    spare = F.pmod(F.xxhash64(sha, F.lit(1)), F.lit(BLOCK * (BLOCK - 1)))
    first = F.pmod(spare, F.lit(BLOCK))
    return F.pmod(F.xxhash64(sha), F.lit(blocks)), first, F.pmod(first + 1 + F.expr(f"pmod(xxhash64({sha}, 1), {BLOCK * (BLOCK - 1)}) div {BLOCK}"), F.lit(BLOCK))


def filter_pages(shas: DataFrame, blocks: int, least: int, name: str = "text_sha256") -> DataFrame:
    """The filter of the hashes (in column name) that so many rows have at least, as rows (page, bits) of PAGE cells."""
    block, first, second = _cells(name, blocks)
    pairs = shas.select((block * BLOCK * BLOCK + first * BLOCK + second).alias("pair"))
    pairs = pairs.groupBy("pair").count().filter(F.col("count") >= least) if least > 1 else pairs
    cells = pairs.select(F.explode(F.expr(f"array(pair div {BLOCK * BLOCK} * {BLOCK} + pair div {BLOCK} % {BLOCK}, pair div {BLOCK * BLOCK} * {BLOCK} + pair % {BLOCK})")).alias("cell"))
    return cells.groupBy(F.expr(f"cell div {PAGE}").alias("page")).agg(F.bitmap_construct_agg(F.col("cell") % PAGE).alias("bits"))


def tested(rows: DataFrame, pages: DataFrame, blocks: int, name: str = "text_sha256") -> DataFrame:
    """rows with a column __maybe, false only where no row of the filter has the hash (in column name). pages has at most FILTER_BYTES."""
    block, first, second = _cells(name, blocks)
    rows = rows.withColumns({"__page": F.expr(f"pmod(xxhash64({name}), {blocks}) div {PAGE // BLOCK}"), "__base": F.pmod(block, F.lit(PAGE // BLOCK)) * BLOCK, "__a": first, "__b": second})
    met = rows.join(F.broadcast(pages.withColumnRenamed("page", "__page")), "__page", "left")
    has = lambda c: F.expr(f"(cast(conv(hex(substring(bits, cast((__base + {c}) div 8 + 1 as int), 1)), 16, 10) as int) & shiftleft(1, cast({c} % 8 as int))) <> 0")
    return met.withColumn("__maybe", F.coalesce(has("__a") & has("__b"), F.lit(False))).drop("__page", "__base", "__a", "__b", "bits")


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """__id, text_sha256, __row and the part of the hashes that a row is in, sorted by it within each file. Texts are read once and don't shuffle."""
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), text_sha256(F.col(f"`{text_col}`")).alias("text_sha256")).withColumn("__row", F.monotonically_increasing_id())
    return materialise(rows.withColumn("__part", F.pmod(F.xxhash64("text_sha256", F.lit(2)), F.lit(PARTS)).cast("int")).sortWithinPartitions("__part"), **NARROW)


def n_slices(total: int) -> int:
    """The number of slices that so many rows are filtered in."""
    return min(PARTS, max(1, -(-CELLS_A_ROW * total // (FILTER_BYTES * 8))))


def slices(rows: DataFrame, total: int) -> Iterator[tuple[DataFrame, DataFrame, int]]:
    """(rows of the slice, its filter of hashes that are possibly repeated, the filter's blocks), each made when it is asked for."""
    n = n_slices(total)
    for i in range(n):
        mine = rows.filter((F.col("__part") >= i * PARTS // n) & (F.col("__part") < (i + 1) * PARTS // n)) if n > 1 else rows
        blocks = blocks_for(total // n)
        yield mine, materialise(filter_pages(mine, blocks, 2)), blocks


def _first() -> Column:
    return F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("id"), F.col("__row").alias("row"))


def _groups(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(rows that the filter clears, the others, the groups of equal texts among those, number of rows)."""
    rows = hashed(docs, id_col, text_col)
    total = rows.count()
    found = one_by_one(tested(mine.select("__id", "text_sha256", "__row"), pages, blocks) for mine, pages, blocks in slices(rows, total))
    straight, maybe = (found.filter(x).drop("__maybe") for x in ("not __maybe", "__maybe"))
    groups = maybe.groupBy("text_sha256").agg(F.min(_first()).alias("__keep"), F.count("*").alias("group_size"))
    return straight, maybe, materialise(groups), total


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text_sha256, keep_id, group_size, kept."""
    straight, maybe, groups, total = _groups(docs, id_col, text_col)
    joined = attach(maybe, groups, "text_sha256", "group_size", total).select("__id", "text_sha256", F.col("__keep.id").alias("keep_id"), "group_size", (F.col("__row") == F.col("__keep.row")).alias("kept"))
    straight = straight.select("__id", "text_sha256", F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return straight.unionByName(joined).withColumnRenamed("__id", id_col)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, whole, with their columns.

    Whole rows are looked up in a filter of the texts that are there more than once, and pass straight through if it clears them. The others
    meet their group's row, by broadcast if groups are few; they shuffle only if they aren't, and where rows repeat both id and text.
    """
    names = docs.columns
    _, maybe, groups, total = _groups(docs, id_col, text_col)
    firsts = attach(maybe, groups.filter("group_size > 1"), "text_sha256", "group_size", total).filter(F.col("__id").eqNullSafe(F.col("__keep.id")) & F.col("group_size").isNotNull())
    several = materialise(firsts.groupBy("text_sha256").agg(F.min("__keep.id").alias("__least"), F.max("group_size").alias("__n"), F.count("*").alias("__same")))
    blocks = blocks_for(n := several.count())
    pages = materialise(filter_pages(several, blocks, 1))
    whole = tested(docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("__doc"), text_sha256(F.col(f"`{text_col}`")).alias("text_sha256")), pages, blocks)
    rest = whole.filter("__maybe")
    met = rest.join(F.broadcast(several), "text_sha256", "left") if n <= BROADCAST_ROWS else attach(rest, several, "text_sha256", "__n", total)
    met = met.filter(F.col("__same").isNull() | F.col("__doc")[id_col].eqNullSafe(F.col("__least")))
    again = met.filter("__same > 1").groupBy("text_sha256").agg(F.first("__doc").alias("__doc"))
    every = whole.filter("not __maybe").select("__doc").unionByName(met.filter("__same is null or __same = 1").select("__doc"))
    return (every.unionByName(again.select("__doc")) if several.filter("__same > 1").limit(1).count() else every).select("__doc.*")
