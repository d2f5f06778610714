"""Queries that write files of the formats around an analysis to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clusters as C
from ..operators import demultiplex as D
from ..operators import features as X
from ..operators import fragments as R
from ..operators import intervals as I
from ..operators import tracks as K
from ..sources import ranges as N
from ..sources import tables as T
from ..sources.tables import FILE_ROWS
from ..storage import materialise, new_path
from . import motifs
from . import views as V
from .queries import _matrix, _routed, _sites, query


def _path(spark, name: str) -> str:
    return f"{new_path(spark)}/{name}"


def _text(spark, rows: DataFrame, name: str) -> str:
    """The folder that a column of lines was written to."""
    path = _path(spark, name)
    rows.write.text(path)
    return path


@query("SELECT chrom, cstart AS s, cend AS e, barcode, score FROM fr")
def s5_s16_k1_bed_files(spark, d):
    path = _path(spark, "bed")
    T.write_bed(V.fragments(spark, d), path)
    return T.read_bed(spark, path).select("chrom", F.col("start").alias("s"), F.col("end").alias("e"), "barcode", "score")


@query("SELECT chrom, cstart AS s, cend AS e, name, signal, pvalue, summit FROM pk")
def s5_k1_narrow_peak_files(spark, d):
    path = _path(spark, "peaks")
    T.write_narrow_peaks(V.peaks(spark, d), path)
    return T.read_narrow_peaks(spark, path).select("chrom", F.col("start").alias("s"), F.col("end").alias("e"), "name", "signal", "pvalue", "summit")


@query("SELECT c.cluster, f.chrom, f.pos AS s FROM cut f JOIN cl c ON c.barcode = f.barcode")
def u3_u4_c14_files_by_cluster(spark, d):
    """Sites written by cluster, as one file set each, read by their paths together."""
    sites = C.routed(_sites(spark, d).drop("sample"), V.clusters(spark, d))
    path = _path(spark, "by_cluster")
    T.write_by_key(sites, "cluster", path)
    return spark.read.parquet(path).select("cluster", "chrom", F.col("start").alias("s"))


@query("SELECT barcode, dup_rate, mito_rate, tsse, uniq, doublet FROM qc")
def s6_k3_quality_files(spark, d):
    path = _path(spark, "qc")
    T.write_qc(V.metrics(spark, d), path)
    return T.read_qc(spark, path)


@query("SELECT g.gene, g.chrom, g.strand, g.lft AS left_, g.rgt AS right_, t.n, t.coding FROM gn g JOIN (SELECT gene, count(*) AS n, count(*) FILTER (WHERE coding) AS coding FROM tx GROUP BY gene) t USING (gene)")
def s7_genes_from_annotation(spark, d):
    g = V.genes(spark, d)
    line = lambda kind, left, right, strand, more: F.concat_ws("\t", "chrom", F.lit("x"), F.lit(kind), (left + 1).cast("string"), (right + 1).cast("string"), F.lit("."), F.when(strand, "+").otherwise("-"), F.lit("."), F.concat(F.lit('gene_name "'), "gene", F.lit('";'), more))
    genes = g.select(line("gene", F.col("left"), F.col("right"), F.col("strand"), F.lit("")).alias("value"))
    kind = F.concat(F.lit(' transcript_type "'), F.when(F.col("t.type") == "Coding", "protein_coding").otherwise("lncRNA"), F.lit('";'))
    transcripts = g.select("chrom", "gene", F.explode("transcripts").alias("t")).select(line("transcript", F.col("t.left"), F.col("t.right"), F.col("t.strand"), kind).alias("value"))
    got = T.read_genes(spark, _text(spark, genes.unionByName(transcripts), "genes.gtf"))
    return got.select("gene", "chrom", "strand", F.col("left").alias("left_"), F.col("right").alias("right_"), F.size("transcripts").cast("long").alias("n"), F.size(F.filter("transcripts", lambda t: t["type"] == "Coding")).cast("long").alias("coding"))


@query('SELECT barcode AS cell, peak AS feature, n AS "count" FROM mat')
def s8_k2_k13_s22_matrix_files(spark, d):
    """A matrix as text and, from that, as Parquet by cluster."""
    text, binary = _path(spark, "text"), _path(spark, "parquet")
    T.write_text_matrix(_matrix(spark, d).select(F.col("barcode").alias("cell"), F.col("peak").alias("feature"), "count"), text)
    T.write_matrix(T.read_text_matrix(spark, text), binary)
    return T.read_matrix(spark, binary)


@query("SELECT DISTINCT c.cluster, m.barcode, m.peak FROM mat m JOIN cl c USING (barcode)")
def u10_matrix_files_by_cluster(spark, d):
    path = _path(spark, "matrix")
    T.write_matrix(X.counts(_routed(spark, d, V.clusters(spark, d)), V.peaks(spark, d), "peak", also=("cluster",)), path, ["cluster"])
    return T.read_matrix(spark, path).select("cluster", "barcode", "peak")


@query("SELECT vec_id AS src, label AS dst, round(vec_id / 8.0::DOUBLE, 6) AS distance FROM embeddings")
def s9_neighbour_edges(spark, d):
    path = _path(spark, "edges")
    e = V.table(spark, d, "embeddings")
    T.write_edges(e.select("vec_id", "label", F.round(F.col("vec_id") / 8, 6)).toDF("src", "dst", "distance"), path)
    return T.read_edges(spark, path).select(F.col("src").cast("long").alias("src"), F.col("dst").cast("int").alias("dst"), "distance")


MEME = "MEME version 4\n\nMOTIF TATA\nletter-probability matrix: alength= 4 w= 4\n 0.02 0.02 0.02 0.94\n 0.94 0.02 0.02 0.02\n 0.02 0.02 0.02 0.94\n 0.94 0.02 0.02 0.02\n\nMOTIF CAT\nletter-probability matrix: alength= 4 w= 3\n 0.01 0.97 0.01 0.01\n 0.97 0.01 0.01 0.01\n 0.01 0.01 0.01 0.97\n"


@query("""WITH s AS (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS q FROM documents), p AS (SELECT doc_id, q, unnest(range(length(q))) AS i FROM s),
  m AS (SELECT doc_id, i, 'TATA' AS motif, substr(q, i + 1, 4) AS w FROM p UNION ALL SELECT doc_id, i, 'CAT', substr(q, i + 1, 3) FROM p)
  SELECT 'chr1' AS chrom, doc_id * 1000000 + i AS s, doc_id * 1000000 + i + length(w) AS e, motif, x.strand FROM m JOIN (VALUES ('TATA', 'TATA', true), ('TATA', 'TATA', false), ('CAT', 'CAT', true), ('CAT', 'ATG', false)) x(name, word, strand) ON x.name = motif AND x.word = w""")
def s10_m18_j22_motif_sites(spark, d):
    """Motifs of a file, with a cut-off that only their best words reach: TATA is its own reverse complement."""
    path = _path(spark, "motifs")
    spark.createDataFrame([(MEME,)], "value string").coalesce(1).write.text(path)
    s = V.table(spark, d, "documents").select(F.lit("chr1").alias("chrom"), (F.col("doc_id") * 1_000_000).alias("start"), F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("seq"))
    found = motifs.scan(s, T.read_motifs(spark, path), 0.02)
    return motifs.best_sites(materialise(found)).select("chrom", F.col("start").alias("s"), F.col("end").alias("e"), "motif", "strand")


@query("""SELECT b.chrom, b.cstart AS s, b.cend AS e, nullif(substr(g.q, b.cstart + 1, b.cend - b.cstart), '') AS seq
  FROM (SELECT 'd' || (c_custkey % 50) AS chrom, c_custkey * 3 AS cstart, c_custkey * 3 + 40 AS cend FROM customer) b LEFT JOIN (SELECT 'd' || doc_id AS chrom, regexp_replace(upper(text), '[^ACGTN]', '', 'g') AS q FROM documents) g USING (chrom)""")
def s11_genome_sequences(spark, d):
    bases = F.regexp_replace(F.upper("text"), "[^ACGTN]", "")
    docs = V.table(spark, d, "documents").select("doc_id", bases.alias("q")).filter("q != ''")
    lines = F.regexp_replace("q", "(.{60})", "$1\n")
    genome = T.read_fasta(spark, _text(spark, docs.select(F.concat(F.lit(">d"), "doc_id", F.lit(" text\n"), lines).alias("value")), "genome.fa"), chunk=100)
    r = V.table(spark, d, "customer").select((F.col("c_custkey") * 3).alias("start"), (F.col("c_custkey") * 3 + 40).alias("end"), F.concat(F.lit("d"), F.col("c_custkey") % 50).alias("chrom"))
    return T.sequences(r, genome, 100).select("chrom", F.col("start").alias("s"), F.col("end").alias("e"), "seq")


@query("SELECT cl.barcode, 'E' || (s_suppkey % 7) AS sample, CASE WHEN s_suppkey % 7 < 5 THEN 'b' || (s_suppkey % 7 % 2) || '1' END AS batch, CASE WHEN s_suppkey % 7 < 5 AND s_suppkey % 7 % 2 = 0 THEN 'g' END AS grp FROM cl JOIN supplier ON s_suppkey = CAST(barcode AS BIGINT)")
def s12_j14_batch_file(spark, d):
    rows = spark.createDataFrame([(f"E{i}\tb{i % 2}" + "\tg" * (i % 2 == 0),) for i in range(5)], "value string")
    cells = V.clusters(spark, d).join(V.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("barcode")), "barcode")
    cells = cells.select("barcode", F.concat(F.lit("E"), F.col("barcode").cast("long") % 7).alias("sample")).withColumn("cell", F.concat("sample", F.lit("_1+"), "barcode"))
    got = C.with_batches(cells, T.read_batches(spark, _text(spark, rows, "batches.tsv")))
    return got.select("barcode", "sample", "batch", F.col("group").alias("grp"))


MANIFEST_SQL = "SELECT 'S' || s_suppkey AS sample_id, CAST(s_suppkey % 3 + 1 AS INT) AS replicate, s_suppkey AS k FROM supplier"


def _manifest(spark, d) -> DataFrame:
    """Experiments with files of all kinds, by the remainders of their keys: a manifest of one experiment on each line."""
    k = F.col("s_suppkey")
    role = lambda r: F.lit(r).cast("string").alias("role")
    file = lambda end, form, tags=(), of=None: F.struct(F.concat(F.lit("p"), k, F.lit(end)).alias("path"), F.lit(form).alias("format"), F.array(*map(F.lit, tags)).cast("array<string>").alias("tags"), role(of))
    some = lambda when, *files: F.when(when, F.array(*files)).otherwise(F.slice(F.array(*files), 1, 0))
    tags = F.filter(F.array(F.when(k % 2 == 1, "PairedEnd"), F.when(k % 3 == 0, "NameSorted")), lambda t: t.isNotNull())
    bam = F.struct(F.concat(F.lit("p"), k, F.lit(".bam")).alias("path"), F.lit("Bam").alias("format"), tags.alias("tags"), role(None))
    reads = F.array(*(file(f"_{x}.fq", "Fastq", ["Gzip"], x) for x in ("index", "read1", "read2")))
    files = F.concat(some(k % 2 == 0, file(".bed.gz", "Bed")), F.slice(reads, F.lit(1), F.when(k % 5 != 0, 3).otherwise(2)), some(k % 7 == 0, file(".dm.fq", "Fastq", ["Gzip", "Demultiplexed"])), F.array(bam), some(k % 11 == 0, *(file(f".{x}", "Other", (), x) for x in ("RowName", "ColumnName", "Matrix"))))
    entry = F.struct(F.concat(F.lit("S"), k).alias("id"), F.array(F.struct((k % 3 + 1).cast("int").alias("rep"), files.alias("files"))).alias("replicates"))
    path = _path(spark, "manifest")
    V.table(spark, d, "supplier").select(F.to_json(F.struct(F.array(entry).alias("scATAC-seq"))).alias("value")).write.text(path)
    return T.read_manifest(spark, path, lines=True)


@query(f"SELECT sample_id, replicate, 'p' || k || '.bed.gz' AS path FROM ({MANIFEST_SQL}) WHERE k % 2 = 0")
def s1_s16_manifest_beds(spark, d):
    return T.beds(_manifest(spark, d)).select("sample_id", "replicate", "path")


@query(f"SELECT sample_id, replicate, 'p' || k || '_index.fq' AS index, 'p' || k || '_read1.fq' AS read1, 'p' || k || '_read2.fq' AS read2 FROM ({MANIFEST_SQL}) WHERE k % 5 <> 0")
def s13_manifest_fastq_sets(spark, d):
    return T.fastq_sets(_manifest(spark, d))


@query(f"SELECT sample_id, replicate, 'p' || k || '.dm.fq' AS path FROM ({MANIFEST_SQL}) WHERE k % 7 = 0")
def s14_manifest_demultiplexed(spark, d):
    return T.demultiplexed_fastq(_manifest(spark, d)).select("sample_id", "replicate", "path")


@query(f"SELECT sample_id, replicate, 'p' || k || '.bam' AS path, k % 2 = 1 AS paired, k % 3 = 0 AS sorted FROM ({MANIFEST_SQL})")
def s15_manifest_bams(spark, d):
    m = _manifest(spark, d)
    both = T.bams(m, True).withColumn("sorted", F.lit(True)).unionByName(T.bams(m, False).withColumn("sorted", F.lit(False)))
    return both.select("sample_id", "replicate", "path", "paired", "sorted")


@query(f"SELECT sample_id, replicate, 'p' || k || '.RowName' AS rows, 'p' || k || '.ColumnName' AS columns, 'p' || k || '.Matrix' AS matrix FROM ({MANIFEST_SQL}) WHERE k % 11 = 0")
def s17_manifest_matrices(spark, d):
    return T.matrix_files(_manifest(spark, d))


@query("SELECT 'genome' AS what, 'given' AS found, count(*) AS lines FROM documents UNION ALL SELECT 'annotation', 'assembly', count(*) FROM part")
def s18_resolved_paths(spark, d):
    """The lines of a genome at its given path, and of an annotation that is only there for the assembly."""
    genome = _text(spark, V.table(spark, d, "documents").select(F.concat(F.lit("d"), "doc_id").alias("value")), "given")
    genes = _text(spark, V.table(spark, d, "part").select(F.concat(F.lit("Gene"), "p_partkey").alias("value")), "assembly")
    found = {"genome": T.resolved(spark, genome, {"GRCh38": genes}, "GRCh38"), "annotation": T.resolved(spark, f"{genome}/none", {"GRCh38": genes}, "GRCh38")}
    one, other = (spark.read.text(path).agg(F.lit(what).alias("what"), F.lit(path.rpartition("/")[2]).alias("found"), F.count("*").alias("lines")) for what, path in found.items())
    return one.unionByName(other)


@query("SELECT barcode, chrom, pos AS position FROM (SELECT barcode, chrom, unnest([cstart, cend]) AS pos FROM fr WHERE chrom <> 'chrM') WHERE barcode = '7'")
def s21_k12_cut_index(spark, d):
    path = _path(spark, "index")
    T.write_cut_index(_sites(spark, d), path, 4)
    return T.look_up(spark, path, "7")


READS_SQL = "SELECT 'r' || l_orderkey || '.' || l_linenumber AS id, substr(translate(md5(CAST(l_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 24) AS seq, substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 24) AS quality FROM lineitem"


def _reads(spark, d) -> DataFrame:
    digest = lambda c: F.md5(F.col(c).cast("string").cast("binary"))
    return V.table(spark, d, "lineitem").select(F.concat(F.lit("r"), "l_orderkey", F.lit("."), "l_linenumber").alias("id"), F.substring(F.translate(digest("l_partkey"), "0123456789abcdef", "ACGTACGTACGTACGT"), 1, 24).alias("seq"), F.substring(digest("l_orderkey"), 1, 24).alias("quality"))


@query(READS_SQL)
def s3_k5_fastq_files(spark, d):
    """Reads written as plain files, which are read in blocks."""
    path = _path(spark, "reads")
    T.write_fastq(_reads(spark, d), path, "none")
    return T.read_fastq(spark, path).select("id", "seq", "quality")


@query('SELECT name, flag, chrom, cstart AS s, cend AS e, mapq, tlen, CASE WHEN ord % 3 > 0 THEN quality END AS ms FROM rd')
def s4_bam_files(spark, d):
    """Each file is read in ranges, by several tasks."""
    path = _path(spark, "bam")
    r = V.reads(spark, d)
    T.write_bam(r.withColumn("ms", F.expr("IF(order % 3 > 0, quality, NULL)")), path)
    return T.read_bam(spark, path).select("name", "flag", "chrom", F.col("start").alias("s"), F.col("end").alias("e"), "mapq", "tlen", "ms")


@query("""WITH e AS (SELECT chrom, cstart AS p, 1 AS v FROM pk UNION ALL SELECT chrom, cend, -1 FROM pk), s AS (SELECT chrom, p, sum(v) AS v FROM e GROUP BY ALL),
  r AS (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS e, CAST(sum(v) OVER (PARTITION BY chrom ORDER BY p ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM s)
  SELECT * FROM r WHERE depth > 0 AND NOT EXISTS (SELECT 1 FROM bl WHERE bl.chrom = r.chrom AND bl.cstart < r.e AND r.s < bl.cend)""")
def k6_coverage_files(spark, d):
    path = _path(spark, "coverage")
    T.write_bedgraph(I.coverage(V.peaks(spark, d)), path, V.blacklist(spark, d))
    return spark.read.csv(path, sep="\t", schema="chrom string, s long, e long, depth long")


ZOOM_SQL = """WITH e AS (SELECT chrom, cstart AS p, 1 AS v FROM pk UNION ALL SELECT chrom, cend, -1 FROM pk), s AS (SELECT chrom, p, sum(v) AS v FROM e GROUP BY ALL),
  r AS (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS e, CAST(sum(v) OVER (PARTITION BY chrom ORDER BY p ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM s),
  z AS (SELECT unnest([1024, 4096, 16384]) AS span), c AS (SELECT span, chrom, s, e, depth, unnest(range(s // span, (e - 1) // span + 1)) AS w FROM r, z WHERE depth > 0),
  n AS (SELECT *, least(e, (w + 1) * span) - greatest(s, w * span) AS n FROM c)
  SELECT span, chrom, w * span AS s, (w + 1) * span AS e, CAST(sum(n) AS BIGINT) AS covered, min(depth) AS low, max(depth) AS high, CAST(sum(n * depth) AS BIGINT) AS total, CAST(sum(n * depth * depth) AS BIGINT) AS squares FROM n GROUP BY span, chrom, w"""


@query(ZOOM_SQL)
def k6_coverage_zooms(spark, d):
    """The coverage of peaks as a pyramid of three levels, each made from the one below."""
    path = _path(spark, "zooms")
    K.write_zooms(I.coverage(V.peaks(spark, d)), path, levels=3)
    return spark.read.parquet(path).select("span", "chrom", F.col("start").alias("s"), F.col("end").alias("e"), *K.SUMMARY)


@query("SELECT p.feature, f.barcode, count(*) AS n FROM pr p JOIN fr f ON f.chrom = p.chrom AND f.cstart < p.cend AND p.cstart < f.cend GROUP BY ALL")
def s20_k7_range_index(spark, d):
    """Fragments over promoters, read through a range index of the fragments."""
    path = _path(spark, "ranges")
    N.write_ranges(V.fragments(spark, d).select("chrom", "start", "end", "barcode"), path)
    return N.counted(spark, path, V.promoters(spark, d).select("chrom", "start", "end", "feature"), ["feature", "barcode"])


@query("SELECT chrom, cstart AS s, cend AS e, peak FROM pk WHERE chrom = 'chr3'")
def k7_peaks_by_chromosome(spark, d):
    path = _path(spark, "peaks")
    T.write_by_key(V.peaks(spark, d).select("chrom", "start", "end", "peak"), "chrom", path)
    return spark.read.parquet(path).filter("chrom = 'chr3'").select("chrom", F.col("start").alias("s"), F.col("end").alias("e"), "peak")


def _index(spark, d) -> DataFrame:
    """Index reads, by number, most of few barcodes."""
    key = F.expr("l_partkey % 40 * ((l_linenumber % 5) div 4 * 1000 + 1)")
    rows = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.substring(F.translate(F.md5(key.cast("string").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGT"), 1, 6).alias("seq"))
    return materialise(rows.select(F.monotonically_increasing_id().alias("n"), F.concat(F.lit("r"), "l_orderkey", F.lit("."), "l_linenumber").alias("id"), "seq", F.lit("I").alias("quality")))


DEMULTIPLEX_SQL = """WITH x AS (SELECT 'r' || l_orderkey || '.' || l_linenumber AS id, substr(translate(md5(CAST(l_partkey % 40 * (l_linenumber % 5 // 4 * 1000 + 1) AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 6) AS obs FROM lineitem),
  c AS (SELECT obs AS barcode, count(*) AS n FROM x GROUP BY 1), g AS (SELECT barcode FROM c ORDER BY n DESC, barcode LIMIT 40), p AS (SELECT unnest(range(1, 7)) AS i), b AS (SELECT unnest(['A', 'C', 'G', 'T', 'N']) AS b),
  v AS (SELECT DISTINCT barcode, substr(barcode, 1, i - 1) || b || substr(barcode, i + 1) AS obs FROM g, p, b),
  t AS (SELECT obs, min(barcode) AS barcode FROM v WHERE obs <> barcode AND obs NOT IN (SELECT barcode FROM g) GROUP BY obs HAVING count(*) = 1 UNION ALL SELECT barcode, barcode FROM g)"""


@query(DEMULTIPLEX_SQL + " SELECT t.barcode || ':' || x.id AS id, x.obs AS seq FROM x JOIN t USING (obs)")
def j6_o6_p20_demultiplexed(spark, d):
    index = _index(spark, d)
    table = D.corrections(D.barcode_counts(index.drop("n"), 6), 40)
    return D.demultiplexed(index.select("n", "id", "seq", "quality"), index, table, 6).select("id", "seq")


CURVE_SQL = """WITH c AS (SELECT n, count(*) AS m FROM (SELECT barcode, count(*) AS n FROM fr GROUP BY barcode) GROUP BY n), r AS (SELECT n, m, sum(m) OVER (ORDER BY n DESC) AS last FROM c), q AS (SELECT DISTINCT CAST(unnest([last - m + 1, last]) AS BIGINT) AS rank, n FROM r),
  f AS (SELECT arg_min(rank, rank) AS r0, arg_min(n, rank) AS n0, arg_max(rank, rank) AS r1, arg_max(n, rank) AS n1 FROM q)"""


@query(CURVE_SQL + " SELECT rank AS keep FROM q, f ORDER BY round((log10(r1) - log10(r0)) * (log10(n) - log10(n0)) - (log10(n1) - log10(n0)) * (log10(rank) - log10(r0)), 9) DESC, rank LIMIT 1")
def m16_barcode_threshold(spark, d):
    keep = D.threshold(V.fragments(spark, d).groupBy("barcode").agg(F.count("*").alias("n")))
    return spark.createDataFrame([(keep,)], "keep long")


@query("""WITH i AS (SELECT *, translate(md5(CAST(l_partkey % 40 AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM lineitem)
  SELECT 'r' || l_orderkey || '.' || l_linenumber AS read, substr(seq, 1, 8) AS barcode FROM i""")
def c1_demultiplexed_files(spark, d):
    """From index and read files to reads named by barcode: all barcodes are alike here, so that the threshold keeps each."""
    digest = F.translate(F.md5((F.col("l_partkey") % 40).cast("string").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGT")
    rows = V.table(spark, d, "lineitem").select(F.concat(F.lit("r"), "l_orderkey", F.lit("."), "l_linenumber").alias("id"), digest.alias("seq"), digest.alias("quality"))
    rows = rows.repartition(max(3, -(-rows.count() // FILE_ROWS)), "id").sortWithinPartitions("id")
    index, reads = _path(spark, "index"), _path(spark, "read1")
    T.write_fastq(rows, index)
    T.write_fastq(rows, reads)
    found, = D.demultiplexed_files(spark, index, [reads], 8, keep=40)
    return found.select(F.substring_index("id", ":", -1).alias("read"), F.substring_index("id", ":", 1).alias("barcode"))


@query("SELECT name, row_number() OVER (ORDER BY name) - 1 AS place FROM (SELECT name FROM rd WHERE (flag & 1804) = 0 AND mapq >= 30)")
def c2_o3_o1_c3_sorted_by_name(spark, d):
    """Usable reads in the order of their names, with their places in it."""
    return R.by_name(R.usable(V.reads(spark, d)), "name").select("name", F.col("place"))
