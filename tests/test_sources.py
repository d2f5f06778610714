import contextlib
import gzip
import json
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from peakloom.sources import bam, tables
from peakloom.streaming import fragments as stream


def write(path, text):
    (gzip.open if str(path).endswith(".gz") else open)(path, "wt").write(text)
    return str(path)


def test_bed_round_trip(spark, tmp_path):
    path = write(tmp_path / "a.bed.gz", "chr1\t1\t5\tAA\t2\t+\nchr1\t2\t9\tBB\t.\t.\nchr2\t3\t4\tCC\t1\t-\n")
    df = tables.read_bed(spark, path)
    rows = [("chr1", 1, 5, "AA", 2, True), ("chr1", 2, 9, "BB", None, None), ("chr2", 3, 4, "CC", 1, False)]
    assert sorted(map(tuple, df.collect())) == rows
    tables.write_bed(df, str(tmp_path / "out"))
    assert sorted(map(tuple, tables.read_bed(spark, str(tmp_path / "out")).collect())) == rows


def test_qc_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.1, None, 5.0, 10, None)], tables.QC)
    tables.write_qc(df, str(tmp_path / "qc"))
    text = "".join(p.read_text() for p in (tmp_path / "qc").glob("*.csv"))
    assert text.split("\n")[0].split("\t") == tables.QC_HEADER and "NA" in text
    assert [tuple(r) for r in tables.read_qc(spark, str(tmp_path / "qc")).collect()] == [("a", 0.1, None, 5.0, 10, None)]


def test_narrow_peaks(spark, tmp_path):
    df = spark.createDataFrame([("chr1", 1, 9, "p", 2.5, 3.5, 4), ("chr1", 1, 9, "q", 2.5, None, None)], "chrom string, start long, end long, name string, signal double, pvalue double, summit long")
    tables.write_narrow_peaks(df, str(tmp_path / "p"))
    assert sorted(map(str, tables.read_narrow_peaks(spark, str(tmp_path / "p")).collect())) == sorted(map(str, df.collect()))


def test_manifest(spark, tmp_path):
    files = [{"path": "i", "format": "Fastq", "tags": ["Gzip"], "role": "index"}, {"path": "a", "format": "Fastq", "role": "read1"}, {"path": "b", "format": "Fastq", "role": "read2"}, {"path": "x", "format": "Bam", "tags": ["NameSorted", "PairedEnd"]}, {"path": "y", "format": "Bed"}, {"path": "r", "format": "Other", "role": "RowName"}]
    path = write(tmp_path / "m.json", json.dumps({"scATAC-seq": [{"id": "s", "replicates": [{"rep": 1, "files": files}]}]}))
    m = tables.read_manifest(spark, path)
    assert [r["index"] for r in tables.fastq_sets(m).collect()] == ["i"]
    assert [r.paired for r in tables.bams(m, True).collect()] == [True] and not tables.bams(m, False).count()
    assert tables.beds(m).count() == 1 and not tables.demultiplexed_fastq(m).count()
    with pytest.raises(Exception, match="incomplete"):
        tables.matrix_files(m).collect()


def test_genes_fasta_motifs(spark, tmp_path):
    gtf = '#x\nchr1\tt\tgene\t11\t50\t.\t-\t.\tgene_name "Ab"; x "y";\nchr1\tt\ttranscript\t11\t40\t.\t-\t.\tgene_name "Ab"; transcript_type "protein_coding";\n'
    (g,) = tables.read_genes(spark, write(tmp_path / "g.gtf", gtf)).collect()
    assert (g.gene, g.strand, g.left, g.right, len(g.transcripts), g.transcripts[0].type) == ("Ab", False, 10, 49, 1, "Coding")
    genome = tables.read_fasta(spark, write(tmp_path / "g.fa", ">chr1 x\nACGT\nacgtAA\n>chr2\nTT\n"), chunk=4)
    regions = spark.createDataFrame([("chr1", 2, 9), ("chr2", 0, 2), ("chr9", 0, 2)], "chrom string, start long, end long")
    assert {(r.chrom, r.seq) for r in tables.sequences(regions, genome, chunk=4).collect()} == {("chr1", "GTACGTA"), ("chr2", "TT"), ("chr9", None)}
    meme = "MEME version 4\n\nMOTIF m1\nletter-probability matrix: alength= 4\n 1 0 0 0\n 0 1 0 0\n\nMOTIF m2\nletter-probability matrix:\n 0 0 0 1\n"
    assert tables.read_motifs(spark, write(tmp_path / "m.meme", meme)) == [("m1", [[1, 0, 0, 0], [0, 1, 0, 0]]), ("m2", [[0, 0, 0, 1]])]


def test_fastq_and_matrix(spark, tmp_path):
    path = write(tmp_path / "r.fastq.gz", "@a x\nACGT\n+\nIIII\n@b\nTT\n+\n@I\n")
    df = tables.read_fastq(spark, path)
    assert [(r.id, r.seq, r.quality, r.n) for r in df.orderBy("n").collect()] == [("a", "ACGT", "IIII", 0), ("b", "TT", "@I", 1)]
    tables.write_fastq(df, str(tmp_path / "fq"))
    assert tables.read_fastq(spark, str(tmp_path / "fq")).count() == 2
    m = spark.createDataFrame([("a", 1, 2), ("a", 3, 1), ("b", 1, 1)], tables.MATRIX)
    tables.write_text_matrix(m, str(tmp_path / "m"))
    assert sorted(map(tuple, tables.read_text_matrix(spark, str(tmp_path / "m")).collect())) == sorted(map(tuple, m.collect()))
    sites = spark.createDataFrame([("a", "chr1", 5, 9, False), ("b", "chr1", 6, 7, None)], "barcode string, chrom string, start long, end long, strand boolean")
    tables.write_cut_index(sites, str(tmp_path / "ix"), 2)
    assert [r.position for r in tables.look_up(spark, str(tmp_path / "ix"), "a").collect()] == [9]


def test_bam(spark, tmp_path):
    name, seq, qual = b"AA:1\0", 4, bytes([20, 10, 30, 40])
    body = struct.pack("<iiBBHHHiiii", 0, 99, len(name), 60, 0, 2, 99, seq, 0, 150, 100) + name + struct.pack("<2I", (3 << 4) | 0, (1 << 4) | 1) + b"\x11\x11" + qual + b"ZZZhi\0" + b"msi" + struct.pack("<i", 77)
    raw = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000) + struct.pack("<i", len(body)) + body
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    (tmp_path / "a.bam").write_bytes(c.compress(raw[:30]) + c.flush() + gzip.compress(raw[30:]))
    (r,) = tables.read_bam(spark, str(tmp_path / "a.bam")).collect()
    assert (r.name, r.flag, r.chrom, r.start, r.end, r.mapq, r.tlen, r.quality, r.ms) == ("AA:1", 99, "chr1", 99, 102, 60, 100, 90, 77)
    (tmp_path / "no.bam").write_bytes(gzip.compress(b"nope"))
    with open_file(tmp_path / "no.bam") as (f, size), pytest.raises(ValueError, match="BAM"):
        bam.references(bam.Inflated(f, size, 0))


@contextlib.contextmanager
def open_file(path):
    from pyarrow import fs

    with fs.LocalFileSystem().open_input_file(str(path)) as f:
        yield f, os.path.getsize(path)


def test_bam_streams_in_bounded_memory(spark, tmp_path):
    """A file of many blocks is read a piece at a time, and what was written comes back."""
    reads = spark.range(30_000).selectExpr("concat('A', id % 50, ':', id) AS name", "99 AS flag", "concat('chr', id % 3) AS chrom", "id * 10 AS start", "id * 10 + 50 AS end", "30 AS mapq", "200L AS tlen", "IF(id % 2 = 0, id, NULL) AS ms")
    tables.write_bam(reads.repartition(3), str(tmp_path / "b"))
    got = tables.read_bam(spark, str(tmp_path / "b")).select(*reads.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, reads.collect()))
    file = next((tmp_path / "b").glob("*.bam"))
    sizes = []
    with open_file(file) as (f, size):
        data = bam.Inflated(f, size, 0)
        _, at = bam.references(data)
        while data.has(at + 4):
            at += 4 + struct.unpack("<i", data.get(at, at + 4))[0]
            data.forget(at)
            sizes.append(len(data.data))
    assert 9000 < len(sizes) < 11_000 and max(sizes) < 400_000


def test_bam_ranges_begin_anywhere(spark, tmp_path):
    """Wherever a file is cut, at every block and inside blocks and alignments, each alignment is in one range, in order; blocks are shorter than some alignments."""
    import pandas as pd

    n = 60
    rows = pd.DataFrame({"name": [f"A{i % 5}:{'x' * (i % 7 * 30 + 1)}{i}" for i in range(n)], "flag": 99, "chrom": [f"chr{i % 3}" for i in range(n)], "start": range(n), "end": [i + 50 for i in range(n)], "mapq": 30, "tlen": 200, "ms": [i if i % 2 else None for i in range(n)]})
    path = str(tmp_path / "one" / "a.bam")
    assert bam.write(path, ["chr0", "chr1", "chr2"], [rows], block=97) == n
    with open_file(path) as (f, size):
        whole = pd.concat(bam.alignments(f, size))
        assert whole["name"].tolist() == rows["name"].tolist() and whole["order"].is_monotonic_increasing and whole["order"].is_unique
        blocks = sorted({x >> 16 for x in whole["order"]})
        for cuts in [[c] for c in {*blocks, *range(1, size, 13)}] + [list(range(step, size, step)) for step in (40, 150, 333, 1000)]:
            parts = [r for a, b in zip([0, *cuts], [*cuts, size], strict=True) for r in bam.alignments(f, size, a, b)]
            assert pd.concat(parts).reset_index(drop=True).equals(whole), cuts
    got = tables.read_bam(spark, path, split=size // 8 + 1)
    assert got.rdd.getNumPartitions() == 8
    assert [r.name for r in got.orderBy("order").collect()] == rows["name"].tolist()


def test_fastq_in_blocks(spark, tmp_path):
    """A plain file that is read in many blocks, which cut records, gives every record once with its number."""
    text = "".join(f"@r{i} x\n{'ACGT' * (i % 9 + 1)}\n+\n{'@III' * (i % 9 + 1)}\n" for i in range(5000))
    path = write(tmp_path / "r.fastq", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = sorted((r.n, r.id, r.seq, r.quality) for r in tables.read_fastq(spark, path).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [(i, f"r{i}", "ACGT" * (i % 9 + 1), "@III" * (i % 9 + 1)) for i in range(5000)]


def test_stream_forgets_old_fragments(spark, tmp_path):
    """A copy within the delay doesn't count; what is kept of fragments goes once the delay has passed."""
    folder = tmp_path / "in"
    folder.mkdir()
    for i, day in enumerate((0, 1, 30, 31, 60)):  # what is old is forgotten at the end of a batch
        path = write(folder / f"{i}.bed", f"chr1\t1\t5\tA\t1\t.\nchr1\t{i + 10}\t{i + 20}\tA\t1\t.\n")
        os.utime(path, (1_700_000_000 + day * 86_400,) * 2)
    q = stream.cell_counts(stream.fragment_stream(spark, str(folder), 1), "2 days").writeStream.outputMode("complete").format("memory").queryName("late").start()
    q.processAllAvailable()
    kept = max(op["numRowsTotal"] for op in q.lastProgress["stateOperators"] if "dedupe" in op["operatorName"].lower())
    q.stop()
    assert spark.table("late").first().uniq == 7 and kept <= 5


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "1.bed", "chr1\t1\t5\tA\t1\t.\nchr1\t1\t5\tA\t1\t.\nchrM\t1\t5\tA\t1\t.\n")
    write(folder / "2.bed", "chr1\t1\t5\tA\t1\t.\nchr1\t9\t12\tB\t1\t.\n")
    q = stream.cell_counts(stream.fragment_stream(spark, str(folder), 1)).writeStream.outputMode("complete").format("memory").queryName("cells").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("cells").collect())) == [("A", 1, 0.5), ("B", 1, 0.0)]


def test_files_of_an_index_grow_with_its_rows(spark, tmp_path, monkeypatch):
    """No file of a cut index, and no task that sorts one, has more rows for there being more of them."""
    monkeypatch.setattr(tables, "FILE_ROWS", 100)
    sites = spark.range(2000).selectExpr("CAST(id % 500 AS STRING) AS barcode", "'chr1' AS chrom", "id AS start", "id + 1 AS end", "true AS strand")
    tables.write_cut_index(sites, str(tmp_path / "index"), 4)
    per = spark.read.parquet(str(tmp_path / "index")).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per) == 2000 and max(r["count"] for r in per) < 300
    assert sorted(r.position for r in tables.look_up(spark, str(tmp_path / "index"), "7").collect()) == [7, 507, 1007, 1507]


def test_fastq_lines_stay_in_arrow(spark, tmp_path):
    """No Python object for a line: records are cut from Arrow's columns, ids read by Spark; in small blocks, with a short last record, blank ids and ids after blanks."""
    text = "".join(f"@ r{i} x\nACGT{'A' * (i % 7)}\n+\n{i}\n" for i in range(400)) + "@\nA\n+\nI\n@last\nAC\n"
    path = tmp_path / "x.fq"
    path.write_text(text)
    want = sorted([(i, f"r{i}", "ACGT" + "A" * (i % 7), str(i)) for i in range(400)] + [(400, "", "A", "I")])
    for size in ("128m", "700b", "40b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            df = tables.read_fastq(spark, str(path))
            assert sorted((r.n, r.id, r.seq, r.quality) for r in df.collect()) == want
            assert "MapInArrow" in df._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
