"""Readers and writers of the formats around an analysis. Everything is read by Spark, so paths may be in any store it knows."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import materialise

BED3 = "chrom string, start long, end long"
BED = f"{BED3}, name string, score long, sign string"
NARROW_PEAK = f"{BED3}, name string, score long, sign string, signal double, pvalue double, qvalue double, summit long"
QC = "barcode string, dup_rate double, mito_rate double, tsse double, uniq long, doublet double"
QC_HEADER = ["barcode", "duplication_rate", "chrM_rate", "TSSe", "unique_fragment", "doublet_likelihood"]
MATRIX = "cell string, feature long, count long"


def _tab(spark: SparkSession, path: str | list[str], schema: str, **options) -> DataFrame:
    return spark.read.csv(path, schema=schema, sep="\t", comment="#", **options)


# Manifest


def read_manifest(spark: SparkSession, path: str, assay: str = "scATAC-seq", lines: bool = False) -> DataFrame:
    """(sample_id, replicate, path, format, tags, role): a row per file of a JSON manifest keyed by assay. lines: a manifest on each line, so that large ones are read in splits.

    {"scATAC-seq": [{"id": ..., "replicates": [{"rep": 1, "files": [{"path": ..., "format": "Bed", "tags": [...], "role": ...}]}]}]}
    """
    schema = f"`{assay}` array<struct<id: string, replicates: array<struct<rep: int, files: array<struct<path: string, format: string, tags: array<string>, role: string>>>>>>"
    raw = spark.read.json(path, schema=schema, multiLine=not lines)
    reps = raw.select(F.explode(f"`{assay}`").alias("e")).select("e.id", F.explode("e.replicates").alias("r"))
    files = reps.select(F.col("id").alias("sample_id"), F.col("r.rep").alias("replicate"), F.explode("r.files").alias("f"))
    return files.select("sample_id", "replicate", "f.path", "f.format", F.coalesce("f.tags", F.array().cast("array<string>")).alias("tags"), "f.role")


def fastq_sets(manifest: DataFrame) -> DataFrame:
    """Experiments with exactly one index file and one pair of reads: (sample_id, replicate, index, read1, read2)."""
    fq = manifest.filter((F.col("format") == "Fastq") & ~F.array_contains("tags", "Demultiplexed"))
    by = fq.groupBy("sample_id", "replicate").agg(*(F.count_if(F.col("role") == r).alias(f"n_{r}") for r in ("index", "read1", "read2")), *(F.max(F.when(F.col("role") == r, F.col("path"))).alias(r) for r in ("index", "read1", "read2")))
    return by.filter("n_index = 1 and n_read1 = 1 and n_read2 = 1").select("sample_id", "replicate", "index", "read1", "read2")


def demultiplexed_fastq(manifest: DataFrame) -> DataFrame:
    return manifest.filter((F.col("format") == "Fastq") & F.array_contains("tags", "Gzip") & F.array_contains("tags", "Demultiplexed"))


def bams(manifest: DataFrame, name_sorted: bool) -> DataFrame:
    """BAM files that are (not) sorted by name, with paired."""
    tagged = F.array_contains("tags", "NameSorted")
    return manifest.filter((F.col("format") == "Bam") & (tagged if name_sorted else ~tagged)).withColumn("paired", F.array_contains("tags", "PairedEnd"))


def beds(manifest: DataFrame) -> DataFrame:
    return manifest.filter(F.col("format") == "Bed")


def matrix_files(manifest: DataFrame) -> DataFrame:
    """(sample_id, replicate, rows, columns, matrix) of given matrices; an incomplete or repeated set is an error."""
    roles = {"RowName": "rows", "ColumnName": "columns", "Matrix": "matrix"}
    m = manifest.filter(F.col("role").isin(*roles))
    by = m.groupBy("sample_id", "replicate").agg(*(F.count_if(F.col("role") == r).alias(f"n_{c}") for r, c in roles.items()), *(F.max(F.when(F.col("role") == r, F.col("path"))).alias(c) for r, c in roles.items()))
    ok = F.expr("n_rows = 1 and n_columns = 1 and n_matrix = 1")
    checked = F.when(ok, F.col("matrix")).otherwise(F.raise_error(F.concat(F.lit("incomplete or several matrices: "), F.col("sample_id"))))
    return by.select("sample_id", "replicate", "rows", "columns", checked.cast("string").alias("matrix"))


# Intervals


def read_bed3(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _tab(spark, path, BED3)


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """chrom, start, end, barcode, score, strand (null: a fragment); plain or gzip. Gzip files don't split, so they are dealt out after."""
    df = _tab(spark, path, BED, nullValue=".")
    return df.select("chrom", "start", "end", F.col("name").alias("barcode"), "score", F.when(F.col("sign") == "+", True).when(F.col("sign") == "-", False).alias("strand"))


def write_bed(df: DataFrame, path: str, compression: str = "gzip") -> None:
    sign = F.when(F.col("strand").isNull(), ".").when(F.col("strand"), "+").otherwise("-") if "strand" in df.columns else F.lit(".")
    name = next((c for c in ("barcode", "name") if c in df.columns), None)
    rows = df.select("chrom", "start", "end", F.col(name) if name else F.lit("."), F.col("score") if "score" in df.columns else F.lit("."), sign)
    rows.write.csv(path, sep="\t", nullValue=".", compression=compression)


def read_narrow_peaks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    df = _tab(spark, path, NARROW_PEAK, nullValue=".")
    return df.select("chrom", "start", "end", "name", "signal", F.when(F.col("pvalue") >= 0, F.col("pvalue")).alias("pvalue"), F.when(F.col("summit") >= 0, F.col("summit")).alias("summit"))


def write_narrow_peaks(df: DataFrame, path: str, compression: str = "gzip") -> None:
    none = F.lit(-1)
    rows = df.select("chrom", "start", "end", "name", F.lit(0), F.lit("."), "signal", F.coalesce("pvalue", none.cast("double")), F.lit(-1), F.coalesce("summit", none.cast("long")))
    rows.write.csv(path, sep="\t", nullValue=".", compression=compression)


def write_bedgraph(coverage: DataFrame, path: str, blacklist: DataFrame | None = None) -> None:
    from ..operators.intervals import interval_join

    df = interval_join(coverage, blacklist.select("chrom", "start", "end"), "anti") if blacklist is not None else coverage
    df.select("chrom", "start", "end", "depth").write.csv(path, sep="\t", compression="gzip")


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return _tab(spark, path, "chrom string, length long")


def write_by_key(df: DataFrame, key: str, path: str) -> None:
    """Parquet in a folder per key (chromosome, cluster, sample), rows sorted inside. Rows are dealt by ranges of the key and of the other columns, so a hot key has several files."""
    others = [c for c in ("start", "barcode", "name") if c in df.columns] or [F.xxhash64(*df.columns)]
    df.repartitionByRange(key, *others).sortWithinPartitions(key, *others).write.partitionBy(key).parquet(path)


# Quality


def read_qc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=QC, sep="\t", header=True, nullValue="NA", enforceSchema=True)


def write_qc(metrics: DataFrame, path: str) -> None:
    names = [c.split()[0] for c in QC.split(", ")]
    df = metrics if "doublet" in metrics.columns else metrics.withColumn("doublet", F.lit(None).cast("double"))
    df.select(*(F.col(a).alias(b) for a, b in zip(names, QC_HEADER, strict=True))).write.csv(path, sep="\t", header=True, nullValue="NA")


def write_table(wide: DataFrame, path: str) -> None:
    wide.write.csv(path, sep="\t", header=True, nullValue="NA")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """(sample, batch, group): group may be absent."""
    return _tab(spark, path, "sample string, batch string, group string")


# Annotation


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """Genes of a GTF file: (gene, chrom, strand, left, right, transcripts); positions from 0."""
    names = "chrom string, source string, kind string, first long, last long, score string, sign string, frame string, attributes string"
    attribute = lambda name: F.nullif(F.regexp_extract("attributes", rf'{name} "([^"]*)"', 1), F.lit(""))
    rows = _tab(spark, path, names, quote="").select("chrom", "kind", (F.col("sign") != "-").alias("strand"), (F.col("first") - 1).alias("left"), (F.col("last") - 1).alias("right"), attribute("gene_name").alias("gene"), attribute("transcript_type").alias("type"))
    genes = rows.filter("kind = 'gene' and gene is not null").groupBy("gene", "chrom", "strand").agg(F.min("left").alias("left"), F.max("right").alias("right"))
    kind = F.when(F.col("type") == "protein_coding", "Coding").otherwise("NonCoding")
    t = rows.filter("kind = 'transcript'").groupBy("gene", "chrom", "strand").agg(F.array_sort(F.collect_list(F.struct("left", "right", "strand", kind.alias("type")))).alias("transcripts"))
    empty = F.array().cast("array<struct<left: bigint, right: bigint, strand: boolean, type: string>>")
    return genes.join(t, ["gene", "chrom", "strand"], "left").withColumn("transcripts", F.coalesce("transcripts", empty))


def read_fasta(spark: SparkSession, path: str, chunk: int = 1 << 20) -> DataFrame:
    """(chrom, start, seq): sequences in pieces of about `chunk` bases. Files are read by record, split at the header mark, and a record is cut once."""
    records = spark.read.text(path, lineSep=">").filter("length(trim(value)) > 0")
    bases = F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n", ""), r"\s", ""))
    parts = records.select(F.regexp_extract("value", r"^(\S+)", 1).alias("chrom"), F.posexplode(F.regexp_extract_all(bases, F.lit(f"[^\\s]{{1,{chunk}}}"), F.lit(0))).alias("i", "seq"))
    return parts.select("chrom", (F.col("i").cast("long") * chunk).alias("start"), "seq")


def sequences(regions: DataFrame, genome: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Regions with seq, the genome's bases (null where it has none); regions may span pieces."""
    r = regions.withColumn("__at", F.explode(F.sequence(F.floor(F.col("start") / chunk), F.floor((F.col("end") - 1) / chunk))))
    g = genome.select(F.col("chrom").alias("__c"), F.floor(F.col("start") / chunk).alias("__at"), F.col("start").alias("__g"), "seq")
    part = F.expr("substring(seq, cast(greatest(start - __g, 0) + 1 as int), cast(end - greatest(start, __g) as int))")
    met = r.join(g, (F.col("chrom") == F.col("__c")) & (r["__at"] == g["__at"]), "left").select(*regions.columns, "__g", part.alias("part"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("__g", "part")))), lambda x: x["part"]), "")
    return met.groupBy(*regions.columns).agg(F.nullif(whole, F.lit("")).alias("seq"))


def read_motifs(spark: SparkSession, path: str) -> list[tuple[str, list[list[float]]]]:
    """(name, rows of A, C, G, T) of the motifs of a MEME file; brought to the driver, as there are a few thousand at most."""
    out: list[tuple[str, list[list[float]]]] = []
    reading = False
    for (line,) in spark.read.text(path, wholetext=True).selectExpr("explode(split(value, '\n'))").toLocalIterator():
        words = line.split()
        if words[:1] == ["MOTIF"]:
            out.append((words[1], []))
            reading = False
        elif line.startswith("letter-probability"):
            reading = True
        elif reading and len(words) == 4:
            out[-1][1].append([float(x) for x in words])
        elif reading and words:
            reading = False
    return out


# Sequencing


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id, seq, quality, file, n): n is the record's number in its file.

    Files are read by lines, gzip ones as streams and plain ones in blocks; a first pass counts the lines of each block, so that every line knows
    its number in the file. Records that lie in one block are cut from Arrow's columns as the lines go by; only the lines that a block's ends part from their record meet in a shuffle.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("m"), F.min("at").alias("first")).withColumn("start", F.coalesce(F.sum("m").over(before), F.lit(0)))
    blocks = blocks.withColumn("f", F.dense_rank().over(Window.orderBy("file"))).withColumn("low", F.expr("(start + 3) div 4 * 4")).withColumn("high", F.expr("(start + m) div 4 * 4"))
    blocks = materialise(blocks.drop("m"))  # a row per block of a file, whose whole records are the lines from low to high

    def frame(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the lines of the record that isn't complete
        for batch in batches:
            if held is not None and len(held):
                batch = pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(held.columns, batch.columns, strict=True)], schema=batch.schema)
            n = len(batch) // 4
            held = batch.slice(4 * n)
            rows = pa.array(4 * np.arange(n))
            texts = [batch.column(0).take(pc.add(rows, r)).cast(pa.string()) for r in (0, 1, 3)]
            yield pa.RecordBatch.from_arrays([*texts, batch.column(1).take(rows), pc.divide(batch.column(2).take(rows), 4)], ["head", "seq", "quality", "f", "n"])

    numbered = lines.join(F.broadcast(blocks), ["file", "block"])
    numbered = numbered.withColumn("k", F.col("start") + F.col("at") - F.col("first"))
    inner = (F.col("k") >= F.col("low")) & (F.col("k") < F.col("high"))
    files = F.broadcast(blocks.select("f", "file").distinct())
    name = lambda head: F.regexp_extract(head, r"(?Us)^.[\s\x1c-\x1f]*([^\s\x1c-\x1f]*)", 1).alias("id")
    whole = numbered.filter(inner).select("value", "f", "k").mapInArrow(frame, "head string, seq string, quality string, f int, n long")
    whole = whole.join(files, "f").select(name("head"), "seq", "quality", "file", "n")
    if not blocks.filter("start > 0").limit(1).count():
        return whole
    part = lambda r: F.max(F.when(F.col("k") % 4 == r, F.col("value")))
    cut = numbered.filter(~inner).groupBy("f", F.expr("k div 4").alias("n")).agg(name(part(0)), part(1).alias("seq"), part(3).alias("quality")).filter("id is not null and quality is not null")
    return whole.unionByName(cut.join(files, "f").select("id", "seq", "quality", "file", "n"))


def write_fastq(reads: DataFrame, path: str, compression: str = "gzip") -> None:
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "id"), "seq", F.lit("+"), "quality").alias("value")).write.text(path, compression=compression)


def read_bam(spark: SparkSession, path: str | list[str], split: int | None = None) -> DataFrame:
    """The alignments of BAM files: name, flag, chrom, start, end, mapq, tlen, quality (the sum of those of at least 15), ms, order (by their place in the file).

    A task reads a range of a file of `split` bytes (by default from 64 KB to 32 MB, by the number of cores); files are in a store that pyarrow.fs knows.
    """
    from .bam import BamSource

    spark.dataSource.register(BamSource)
    options = {"paths": json.dumps([path] if isinstance(path, str) else path), "tasks": str(spark.sparkContext.defaultParallelism), **({"split": str(split)} if split else {})}
    return spark.read.format("bam").options(**options).load()


def write_bam(reads: DataFrame, folder: str) -> None:
    """A BAM file per partition of reads (name, flag, chrom, start, end, mapq, tlen, ms; one matching stretch each). Reference names are taken from the rows, of which there are few."""
    from .bam import write

    names = [r.chrom for r in reads.select("chrom").filter("chrom is not null").distinct().orderBy("chrom").collect()]
    columns = ["name", "flag", "chrom", "start", "end", "mapq", "tlen", "ms"]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        yield pd.DataFrame({"n": [write(f"{folder}/part-{TaskContext.get().partitionId():05d}.bam", names, batches)]})

    reads.select(*columns).mapInPandas(run, "n long").agg(F.sum("n")).collect()


def read_edges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(src, dst, distance) of a neighbour graph as text: a line per edge, separated by tabs."""
    return _tab(spark, path, "src string, dst string, distance double")


def write_edges(edges: DataFrame, path: str) -> None:
    edges.select("src", "dst", "distance").write.csv(path, sep="\t", compression="gzip")


def resolved(spark: SparkSession, given: str | None, known: dict[str, str], assembly: str) -> str:
    """The path of a genome, annotation or motif file: the given one if something is there, else that of the assembly; nothing is fetched."""
    for path in filter(None, (given, known.get(assembly))):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return path
    raise FileNotFoundError(f"neither {given} nor a file of {assembly}")


# Matrices


def write_matrix(matrix: DataFrame, path: str, by: list[str] | None = None) -> None:
    w = matrix.write
    (w.partitionBy(*by) if by else w).parquet(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A long matrix from Parquet."""
    return spark.read.parquet(path)


def read_text_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A sparse matrix as text: cell, then feature,count pairs, by tabs; a first line of sizes is left out."""
    rows = spark.read.text(path).filter(~F.col("value").startswith("Sparse matrix")).select(F.split("value", "\t").alias("p"))
    pairs = rows.select(F.col("p")[0].alias("cell"), F.explode(F.expr("slice(p, 2, greatest(size(p) - 1, 0))")).alias("x")).select("cell", F.split("x", ",").alias("x"))
    return pairs.select("cell", F.col("x")[0].cast("long").alias("feature"), F.col("x")[1].cast("long").alias("count"))


def write_text_matrix(matrix: DataFrame, path: str) -> None:
    """A line per cell. A cell's counts are one row here, as its features are bounded by the feature set."""
    pair = F.concat_ws(",", "feature", "count")
    rows = matrix.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("feature", pair.alias("p")))).alias("ps"))
    rows.select(F.concat_ws("\t", "cell", F.array_join(F.transform("ps", lambda x: x["p"]), "\t")).alias("value")).write.text(path, compression="gzip")


#: Rows that a task sorts into one file, on average.
FILE_ROWS = 1_000_000


def write_cut_index(sites: DataFrame, path: str, files: int = 16) -> None:
    """An index of positions by cell: Parquet dealt and sorted by cell, so that a look-up reads few row groups. There are at least so many files, and more if they had too many rows."""
    rows = sites.select("barcode", "chrom", F.when(~F.coalesce("strand", F.lit(True)), F.col("end")).otherwise(F.col("start")).alias("position"))
    rows.repartitionByRange(max(files, -(-rows.count() // FILE_ROWS)), "barcode").sortWithinPartitions("barcode", "chrom", "position").write.parquet(path)


def look_up(spark: SparkSession, path: str, barcode: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("barcode") == barcode)
