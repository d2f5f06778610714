"""Mixing sources to target weights (native): a low-discrepancy schedule of equal-token blocks.

Targets: sources in code point order, null last, weigh 1, 2, 3, repeating, and share all words; a
target stops at MAX_EPOCHS times its source's size and the excess goes to the others by weight.
The documents of a source, in the order of a hash of their ids, form a stream of words, cut into blocks
of BLOCK_WORDS. Slot i of the schedule goes to the source whose part of the cumulative
weights holds the golden-ratio point frac(i * phi); the r-th slot of a source takes its block
r modulo the number of blocks. A source gets the slots that fill its target, the last one
partly, and those that the points leave short of it come at the end of the schedule. What a document has
taken of it is summed over the slots that take its blocks.

Running sums and ranks are made in two levels (by ranges of rows, chunks or sources, of as many as partitions, then
over their sums), so no task holds all rows of a hot source, the sums of its parts, or all sources. A mix never takes a document over MAX_EPOCHS times.

Defined cases: a null text has no words; documents without words are in no block and have taken 0;
repeated rows are separate documents; if no document has words all targets are 0; an empty table gives
an empty result; columns other than doc_id, source and text are not read, and mix() passes them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, running, small

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_WORDS = 1024
CHUNK = 1 << 14
#: Slots of a partition of the mix, at most.
RUN_SLOTS = 1 << 14
#: The golden ratio's fractional part times 2**31, made odd: i * GOLDEN modulo 2**31 runs through all points.
POINTS, GOLDEN = 1 << 31, 1327217885
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: source, src (its number), source_size, weight, target, words (the target as a whole number), blocks, slots."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("__none", F.col("source").isNull())
    s = running(sizes, [], ["__none", "source"], "src").drop("__none")
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("src") % len(WEIGHTS) + 1).cast("int")).cast("double"))
    s = materialise(s.withColumn("cap", (MAX_EPOCHS * F.col("source_size")).cast("double")).withColumn("stop", F.col("cap") / F.col("weight")))
    level = _level(s)
    s = s.withColumn("target", F.least("cap", F.lit(level) * F.col("weight")))
    s = s.withColumn("words", F.least((MAX_EPOCHS * F.col("source_size")), F.floor(F.col("target") + 0.5)))
    blocks = F.expr(f"(source_size + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}")
    return s.select("source", "src", "source_size", "weight", "target", "words", blocks.alias("blocks")).withColumn(
        "slots", F.expr(f"if(source_size = 0, 0L, (words div source_size) * blocks + ((words % source_size) + {BLOCK_WORDS - 1}) div {BLOCK_WORDS})")
    )


def _level(s: DataFrame) -> float:
    """Words by weight of the sources that don't stop at their cap: raised until no other source stops below it, an aggregate each time."""
    level = 0.0
    while True:
        low = F.col("stop") < level
        total, stopped, weight = s.agg(F.sum("source_size"), F.sum(F.when(low, F.col("cap"))), F.sum(F.when(~low, F.col("weight")))).first()
        now = (float(total) - (stopped or 0.0)) / weight if total and weight else 0.0
        if now <= level:
            return level
        level = now


def lay_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): every document's size and its place in its source's stream, and targets(). row: a column of row numbers."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"), order_key(F.col(id_col)).alias("key"), F.col(row).alias("row") if row else F.monotonically_increasing_id().alias("row"))
    rows = materialise(rows)
    sources = materialise(targets(rows))
    number = small(sources.select("source", "src"))
    rows = rows.join(number, rows["source"].eqNullSafe(number["source"])).select("doc_id", "row", "src", "size", "key")
    placed = running(rows, ["src"], ["key", "doc_id", "size", "row"], "offset", "size")
    return materialise(placed.select("doc_id", "row", "src", "size", "offset")), sources


def slots(sources: DataFrame) -> DataFrame:
    """The schedule: slot, src, rank (of the slot among its source's), block, words (that the slot takes of the block)."""
    spark = sources.sparkSession
    total, count = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    bits = max(8, 19 - max(0, int(count).bit_length() - 12))  # about as many bins as sources, 4,096 at least
    lo, hi = (F.floor(x / F.lit(float(max(total, 1))) * POINTS) for x in (F.col("cum"), F.col("cum") + F.col("slots")))
    ranges = running(sources.select("src", "slots"), [], ["src"], "cum", "slots").select("src", lo.alias("lo"), hi.alias("hi")).filter("hi > lo")
    ranges = small(materialise(ranges.withColumn("bin", F.explode(F.expr(f"sequence(shiftright(lo, {bits}), shiftright(hi - 1, {bits}))")))))
    points = spark.range(total).select(F.col("id").alias("slot"), F.expr(f"((id % {POINTS}L) * {GOLDEN}L) % {POINTS}L").alias("u"))
    drawn = points.withColumn("bin", F.expr(f"shiftright(u, {bits})")).join(ranges, "bin").filter("u >= lo and u < hi").select("slot", "src", F.expr(f"slot div {CHUNK}").alias("chunk"))
    per = drawn.groupBy("src", "chunk").count()
    starts = running(per, ["src"], ["chunk"], "first", "count").select("src", "chunk", "first")
    rank = F.col("first") + F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    info = small(sources.select("src", "source_size", "words", "blocks", F.col("slots").alias("quota")), count)
    ranked = drawn.join(starts, ["src", "chunk"]).select("slot", "src", rank.alias("rank")).join(info, "src").filter("rank < quota")
    got = per.groupBy("src").agg(F.sum("count").alias("got"))
    short = info.join(got, "src", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < quota").withColumn("rank", F.explode(F.expr("sequence(got, quota - 1)")))
    short = running(short.select("src", "rank", "source_size", "words", "blocks", "quota"), [], ["rank", "src"], "late")
    short = short.select((F.lit(total) + F.col("late")).alias("slot"), "src", "rank", "source_size", "words", "blocks", "quota")
    every = ranked.select(*short.columns).unionByName(short).withColumn("block", F.expr("rank % blocks"))
    full = F.expr(f"least({BLOCK_WORDS}L, source_size - block * {BLOCK_WORDS})")
    left = F.expr(f"words - (rank div blocks) * source_size - block * {BLOCK_WORDS}")
    return every.select("slot", "src", "rank", "block", F.least(full, left).alias("words"))


def pieces(documents: DataFrame) -> DataFrame:
    """The part of each document in each block: src, block, row, size, offset, start and stop in the source's stream."""
    cut = documents.filter("size > 0").withColumn("block", F.explode(F.expr(f"sequence(offset div {BLOCK_WORDS}, (offset + size - 1) div {BLOCK_WORDS})")))
    return cut.select("src", "block", "row", "size", "offset", F.expr(f"greatest(offset, block * {BLOCK_WORDS})").alias("start"), F.expr(f"least(offset + size, (block + 1) * {BLOCK_WORDS})").alias("stop"))


def schedule(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """The mix: slot, start (the order in a slot), row and size of the document, first_word and n_words that the slot takes of it."""
    met = pieces(documents).join(slots(sources).withColumnRenamed("words", "takes"), ["src", "block"])
    n = F.expr(f"least(stop, block * {BLOCK_WORDS} + takes) - start")
    return met.select("slot", "start", "row", "size", (F.col("start") - F.col("offset")).alias("first_word"), n.alias("n_words")).filter("n_words > 0")


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, first_slot (the first that takes words of it), n_slots (that do)."""
    documents, sources = lay_out(docs)
    sums = schedule(documents, sources).groupBy("row").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_slots"))
    per = small(sources.select("src", "source_size", "target"))
    met = documents.join(sums, "row", "left").join(per, "src")
    return met.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"))


def mix(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The mix itself, in order of its slots: a row for each document that a slot takes words of, with docs' columns.

    A document that lies in one block comes whole; one that blocks cut comes in pieces, each with the words that its slot
    takes, and their white space in between. length_col, if docs has it, is the piece's length. The words of all rows of a document
    are mixed_sizes()'s taken.
    """
    names = docs.columns
    own = [f"__c{i}" for i in range(len(names))]  # no name of docs can clash with what is added
    column = dict(zip(names, own, strict=True))
    whole = materialise(docs.toDF(*own).withColumn("__row", F.monotonically_increasing_id()))
    documents, sources = lay_out(whole, column["doc_id"], column[text_col], column["source"], row="__row")
    takes = schedule(documents, sources).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("slot", "start", "first_word", "n_words"))).alias("__takes"), F.first("size").alias("__size"))
    met = whole.join(small(materialise(takes)), F.col("__row") == F.col("row")).drop("__row", "row")
    text = F.col(column[text_col])
    cut = F.exists("__takes", lambda t: t["n_words"] < F.col("__size"))
    words = F.when(cut, F.regexp_extract_all(text, F.lit(f"([\\x20\\x09-\\x0D]*{WORD})"), F.lit(1))).otherwise(F.array().cast("array<string>"))
    # A generator makes each text's words once, however many pieces it has.
    split = met.select(*own, "__takes", "__size", F.explode(F.array(words)).alias("__words"))
    some = lambda t: F.regexp_replace(F.array_join(F.slice("__words", (t["first_word"] + 1).cast("int"), t["n_words"].cast("int")), ""), r"^[\x20\x09-\x0D]+", "")
    parts = F.transform("__takes", lambda t: F.struct(t["slot"].alias("slot"), t["start"].alias("start"), F.when(t["n_words"] < F.col("__size"), some(t)).alias("piece")))
    rows = split.select(*own, F.explode(parts).alias("__t")).withColumns({"__slot": F.col("__t.slot"), "__start": F.col("__t.start"), "__text": F.coalesce("__t.piece", text)})
    made = {text_col: F.col("__text"), **({length_col: F.length("__text").cast(docs.schema[length_col].dataType)} if length_col in names else {})}
    # Partitions are runs of slots, which are known without a look at the rows.
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    run = min(RUN_SLOTS, max(1024, total // 64))
    n = max(1, -(-total // run))
    ordered = rows.repartitionById(n, F.least(F.lit(n - 1), F.expr(f"__slot div {run}")).cast("int")).sortWithinPartitions("__slot", "__start")
    return ordered.select(*(made.get(c, F.col(column[c])).alias(c) for c in names))
