"""Chat formatting (native): quotation linking.

Lines that start with `>` are quotes; the number of `>` is their level. Each quoted line is normalised (markers
removed, white space collapsed, lower case) and hashed, and the hash is joined to the lines that
messages wrote themselves (level 0): first to an earlier message of the same conversation, otherwise to the
first message of another conversation that wrote the line. Quotes that were wrapped anew or cite a part of a line have no such
line; they are linked as passages: runs of quoted lines of one level. A quoted line's words (with the passage's words around it up to
WORDS) are sought as a sequence in the words that a message wrote, across its lines; a passage of fewer
than WORDS words is sought only in its own conversation. Links by whole lines come first. A message's parent is the earlier message of its conversation that
most of its lowest-level quoted lines come from (then the latest). Conversations are ordered by threads: a
thread starts at a message without parent, threads come in the order of their first messages, and messages in
a thread by turn, so that every reply follows what it answers. Bodies have neither quotes nor the
lines that introduce them.

Heavy lines and conversations don't meet in one task: originals are reduced to one row per hash
before the join (see common.attach), and ranks are made in two levels, by ranges of messages. Words of messages
meet the seeds of passages by broadcast or, where these are too many, through Bloom filters, so no row for each word shuffles.

Result, one row per message: conv_id, turn, role, position (from 0), thread (the first turn), parent_turn, n_quoted (lines),
n_linked (found in the conversation), source_conv and source_turn (of the first line found elsewhere), body.
Defined cases: a null text is an empty text; null conv_ids form one conversation; null turns come first in it and
have no links; rows that repeat a turn are separate messages in the order of role and text; lines that are empty after
normalising aren't linked; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage
from .common import attach, materialise, one_by_one, running, small
from .exact_dedup import blocks_for, filter_pages, n_slices, tested

MARKER = r"^(\s*>)+"
INTRODUCTION = r"(?i)^\s*(on|le|am|el|il|op)\b.*\b(wrote|écrit|schrieb|escribió|ha scritto|schreef)\b.*:\s*$"
WHITE = r"[\x20\x09-\x0D]+"
#: Words that a passage needs to be sought in other conversations, and of the seeds by which places are found.
WORDS = 5


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKER, ""), WHITE, " ")))


def lines_of(rows: DataFrame) -> DataFrame:
    """The lines of each message: __row, conv_id, turn, no, level, hash (null if empty), text (normalised)."""
    marks = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKER, 0), r"[^>]", ""))
    split = rows.select("__row", "conv_id", "turn", F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    text = normalised(F.col("line"))
    return split.select("__row", "conv_id", "turn", "no", marks("line").alias("level"), F.when(text != "", F.md5(text.cast("binary"))).alias("hash"), text.alias("text"))


def conv_name() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))


def seed_of(words: Column, short: Column) -> Column:
    """The hash of up to WORDS words by which places are found; those of a short passage are of its conversation."""
    return F.xxhash64(F.when(short, F.concat(F.array(F.lit("short"), conv_name()), words)).otherwise(words))


def place_of(words: Column, short: Column) -> Column:
    """The hash of a sequence of words, unequal to any line's."""
    return F.md5(F.concat(F.when(short, F.concat(F.lit("short:"), conv_name(), F.lit(":"))).otherwise(F.lit("words:")), F.array_join(words, " ")).cast("binary"))


def passages_of(lines: DataFrame) -> DataFrame:
    """The quoted lines that aren't empty, with what is sought of their passage: words (the line's, and those around it up to WORDS), short, seed, place."""
    run = F.col("no") - F.row_number().over(Window.partitionBy("__row", "level").orderBy("no"))
    runs = lines.withColumn("run", run).filter("hash is not null").withColumn("words", F.split("text", " "))
    around = Window.partitionBy("__row", "level", "run").orderBy("no")
    beside = lambda a, b: F.flatten(F.collect_list("words").over(around.rowsBetween(a, b)))
    runs = runs.withColumns({"before": beside(1 - WORDS, -1), "after": beside(1, WORDS - 1)})
    lacks = lambda *x: F.greatest(F.lit(0), F.lit(WORDS) - sum(F.size(y) for y in x))
    last = F.least(F.size("before"), lacks("words"))
    runs = runs.withColumn("words", F.concat(F.slice("before", F.size("before") - last + 1, last), "words"))
    runs = runs.withColumn("words", F.concat("words", F.slice("after", F.lit(1), lacks("words")))).withColumn("short", F.size("words") < WORDS)
    return runs.withColumns({"seed": seed_of(F.slice("words", 1, WORDS), F.col("short")), "place": place_of(F.col("words"), F.col("short"))}).drop("text", "run", "before", "after")


def written(rows: DataFrame) -> DataFrame:
    """The words that each message wrote itself, in a row for each run of lines between quotes: __row, conv_id, turn, run, words."""
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.when(x.rlike(MARKER), F.lit("\0")).otherwise(x))
    runs = F.split(F.lower(F.regexp_replace(F.array_join(lines, "\n"), WHITE, " ")), r"\x00")
    split = rows.select("__row", "conv_id", "turn", F.posexplode(runs).alias("run", "text")).withColumn("text", F.trim("text")).filter("text != ''")
    return split.select("__row", "conv_id", "turn", "run", F.split("text", " ").alias("words"))


def whole_places(places: DataFrame, wanted: DataFrame) -> DataFrame:
    """places (seed and others) joined with wanted (a row a seed). More seeds than can be broadcast are put in Bloom filters, slice by slice of the seeds' hashes, so that
    only places that a filter doesn't clear shuffle, not a row for each word of the messages."""
    n = wanted.count()
    if n <= storage.BROADCAST_ROWS:
        return places.join(F.broadcast(wanted), "seed")
    parts = n_slices(n)
    part = F.pmod(F.xxhash64("seed", F.lit(2)), F.lit(parts))
    blocks = blocks_for(n // parts)
    mine = ((places.filter(part == i), materialise(filter_pages(wanted.filter(part == i), blocks, 1, "seed"))) for i in range(parts))
    kept = one_by_one(tested(some, pages, blocks, "seed").filter("__maybe").drop("__maybe") for some, pages in mine)
    per = materialise(kept.groupBy("seed").agg(F.count("*").alias("__n")).join(wanted, "seed"))
    return attach(kept, per, "seed", "__n", kept.count()).filter("__n is not null").drop("__n")


def sought(rows: DataFrame, quoted: DataFrame) -> DataFrame:
    """Where messages wrote a sequence of words that a passage seeks: conv_id, turn, hash. Places are found by their first words, and of those places the whole sequences are compared."""
    wanted = materialise(quoted.groupBy("seed", "short").agg(F.collect_set(F.size("words")).alias("sizes")))
    runs = written(rows)
    places = F.sequence(F.lit(1), F.size("words"))
    whole = runs.select("__row", "run", F.posexplode(F.transform(places, lambda i: seed_of(F.slice("words", i, WORDS), F.lit(False)))).alias("at", "seed"))
    found = whole_places(whole, wanted.filter("not short"))
    talks = materialise(quoted.filter("short").select(conv_name().alias("name")).distinct())
    own = runs.join(small(talks), conv_name() == F.col("name"), "left_semi")
    short = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(WORDS - 1)), lambda n: F.transform(places, lambda i: F.struct((i - 1).alias("at"), seed_of(F.slice("words", i, n), F.lit(True)).alias("seed")))))
    parts = own.select("__row", "run", F.explode(short).alias("x")).select("__row", "run", "x.at", "x.seed")
    found = found.unionByName(parts.join(small(wanted.filter("short")), "seed")).select("__row", "run", "at", "short", F.explode("sizes").alias("size")).distinct()
    met = runs.join(materialise(found), ["__row", "run"])
    hashes = met.select("conv_id", "turn", place_of(F.slice("words", F.col("at") + 1, F.col("size")), F.col("short")).alias("hash"))
    return hashes.join(quoted.select(F.col("place").alias("hash")).distinct(), "hash", "left_semi").select("conv_id", "turn", "hash")


def body_of(text: Column) -> Column:
    lines = F.split(text, "\n", -1)
    quoted = lambda x: F.coalesce(x, F.lit("")).rlike(MARKER)
    own = F.filter(lines, lambda x, i: ~(quoted(x) | (x.rlike(INTRODUCTION) & quoted(F.get(lines, i + 1)))))
    return F.regexp_replace(F.array_join(own, "\n"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def link(messages: DataFrame) -> DataFrame:
    rows = materialise(
        messages.select("conv_id", "turn", "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("__row", F.monotonically_increasing_id())
    )
    has_quotes = F.col("text").rlike(r"(?m)" + MARKER)
    quoted = materialise(passages_of(lines_of(rows.filter(has_quotes)).filter("level > 0")))
    # Each line is met by its own hash and by its place in its passage.
    keys = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("hash").alias("h")), F.struct(F.lit(1).alias("kind"), F.col("place").alias("h"))))
    asked = materialise(quoted.select("__row", "conv_id", "turn", "no", "level", keys.alias("x")).select("__row", "conv_id", "turn", "no", "level", "x.kind", F.col("x.h").alias("hash")))
    wanted = asked.groupBy("hash").agg(F.count("*").alias("__n"))
    # Only lines and places that someone quotes are kept of the originals.
    own = lines_of(rows).filter("level = 0 and hash is not null")
    own = own.join(wanted.select("hash"), "hash", "left_semi").select("conv_id", "turn", "hash")
    own = materialise(own.unionByName(sought(rows, quoted)))
    total = asked.count()
    key = F.md5(F.concat_ws(":", conv_name(), "hash").cast("binary"))
    near = own.filter("turn is not null").select(key.alias("__key"), "turn").groupBy("__key").agg(F.min("turn").alias("near_turn"))
    # The least originals of two conversations: one of them isn't the quoter's own.
    each = materialise(own.groupBy("hash", "conv_id").agg(F.min(F.struct("conv_id", "turn")).alias("at")))
    far = materialise(each.groupBy("hash").agg(F.min("at").alias("far")))
    other = each.join(far, "hash").filter(~F.col("at.conv_id").eqNullSafe(F.col("far.conv_id"))).groupBy("hash").agg(F.min("at").alias("other"))
    far = far.join(other, "hash", "left")
    with_key = asked.withColumn("__key", key)
    near = near.join(with_key.groupBy("__key").agg(F.count("*").alias("__n")), "__key")
    met = attach(with_key, materialise(near), "__key", "__n", total).drop("__n")
    met = attach(met, materialise(far.join(wanted, "hash")), "hash", "__n", total)
    in_conv = F.col("near_turn") < F.col("turn")
    met = met.withColumns({"near_turn": F.when(in_conv, F.col("near_turn")), "far": F.when(F.col("far.conv_id").eqNullSafe(F.col("conv_id")), F.col("other")).otherwise(F.col("far"))})
    first = lambda x: F.min(F.when(F.col(x).isNotNull(), F.struct("kind", x)))[x].alias(x)
    met = met.groupBy("__row", "no", "level").agg(first("near_turn"), first("far")).withColumn("far", F.when(F.col("near_turn").isNull(), F.col("far")))
    votes = met.filter("near_turn is not null").groupBy("__row", "level", "near_turn").agg(F.count("*").alias("n"))
    parents = votes.groupBy("__row").agg(F.min(F.struct("level", (-F.col("n")).alias("n"), (-F.col("near_turn")).alias("t"))).alias("best")).select("__row", (-F.col("best.t")).alias("parent_turn"))
    facts = met.groupBy("__row").agg(F.count("*").alias("n_quoted"), F.count("near_turn").alias("n_linked"), F.min(F.when(F.col("far").isNotNull(), F.struct("no", "far"))).alias("from"))
    linked = rows.join(facts.select("__row", "n_quoted", "n_linked", F.col("from.far.conv_id").alias("source_conv"), F.col("from.far.turn").alias("source_turn")), "__row", "left").join(parents, "__row", "left")
    linked = materialise(linked.select("__row", "conv_id", "turn", "role", body_of(F.col("text")).alias("body"), *(F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("n_quoted", "n_linked")), "source_conv", "source_turn", "parent_turn"))
    return in_order(with_threads(linked)).select("conv_id", "turn", "role", "position", "thread", "parent_turn", "n_quoted", "n_linked", "source_conv", "source_turn", "body")


def with_threads(linked: DataFrame) -> DataFrame:
    """Adds thread: the turn at the end of the chain of parents, found by doubling the steps."""
    steps = linked.filter("parent_turn is not null").groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("up"))
    steps = materialise(steps)
    if steps.limit(1).count():
        while True:
            up = steps.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("up").alias("upper"))
            joined = steps.join(up, steps["conv_id"].eqNullSafe(up["c"]) & (steps["up"] == up["t"]), "left")
            steps = materialise(joined.select("conv_id", "turn", F.coalesce("upper", "up").alias("up"), F.col("upper").isNotNull().alias("moved")))
            if not steps.filter("moved").limit(1).count():
                break
            steps = steps.drop("moved")
    roots = steps.select(F.col("conv_id").alias("__c"), F.col("turn").alias("__t"), F.col("up").alias("__root"))
    met = linked.join(roots, linked["conv_id"].eqNullSafe(roots["__c"]) & (linked["turn"] == roots["__t"]), "left")
    return met.withColumn("thread", F.when(F.col("parent_turn").isNull(), F.col("turn")).otherwise(F.coalesce("__root", "parent_turn"))).drop("__c", "__t", "__root")


def in_order(df: DataFrame) -> DataFrame:
    """Adds position: the rank in the conversation by thread and turn, in two levels, so that neither a long conversation nor a long thread meets in one task."""
    return running(df, ["conv_id"], ["thread", "turn", "role", "body"], "position", ranges=3)


#: The same in DuckDB's SQL for quotes of whole lines; it has no passages, and of the originals elsewhere only the first.
ORACLE_SQL = r"""
WITH RECURSIVE base AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, row_number() OVER () AS rid FROM conversations),
parts AS (SELECT rid, conv_id, turn, string_split(text, chr(10)) AS ls FROM base),
ln AS (SELECT rid, conv_id, turn, ls, unnest(range(0, len(ls))) AS no FROM parts),
lines AS (SELECT rid, conv_id, turn, no, ls[no + 1] AS line,
  len(regexp_replace(regexp_extract(ls[no + 1], '^(\s*>)+', 0), '[^>]', '', 'g')) AS level,
  lower(trim(regexp_replace(regexp_replace(ls[no + 1], '^(\s*>)+', ''), '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm,
  coalesce(ls[no + 2], '') AS next FROM ln),
own AS (SELECT conv_id, turn, norm FROM lines WHERE level = 0 AND norm <> ''),
quoted AS (SELECT * FROM lines WHERE level > 0 AND norm <> ''),
near AS (SELECT conv_id, norm, min(turn) AS near_turn FROM own WHERE turn IS NOT NULL GROUP BY ALL),
far AS (SELECT norm, min({'c': conv_id, 't': turn}) AS far FROM own GROUP BY ALL),
met AS (SELECT q.rid, q.level, q.no, CASE WHEN n.near_turn < q.turn THEN n.near_turn END AS near_turn,
  CASE WHEN NOT (coalesce(n.near_turn < q.turn, false) OR f.far.c IS NOT DISTINCT FROM q.conv_id) THEN f.far END AS far
  FROM quoted q LEFT JOIN near n ON n.conv_id IS NOT DISTINCT FROM q.conv_id AND n.norm = q.norm LEFT JOIN far f ON f.norm = q.norm),
votes AS (SELECT rid, level, near_turn, count(*) AS n FROM met WHERE near_turn IS NOT NULL GROUP BY ALL),
parents AS (SELECT rid, near_turn AS parent_turn FROM votes QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level, n DESC, near_turn DESC) = 1),
facts AS (SELECT rid, count(*) AS n_quoted, count(near_turn) AS n_linked, arg_min(far, no) FILTER (WHERE far IS NOT NULL) AS far FROM met GROUP BY rid),
bodies AS (SELECT rid, regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY no), ''), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS body FROM lines
  WHERE NOT (level > 0 OR (regexp_matches(line, '(?i)^\s*(on|le|am|el|il|op)\b.*\b(wrote|écrit|schrieb|escribió|ha scritto|schreef)\b.*:\s*$') AND regexp_matches(next, '^(\s*>)+'))) GROUP BY rid),
steps AS (SELECT b.conv_id, b.turn, min(p.parent_turn) AS up FROM base b JOIN parents p USING (rid) GROUP BY ALL),
chain AS (SELECT conv_id, turn, up FROM steps UNION ALL
  SELECT c.conv_id, c.turn, s.up FROM chain c JOIN steps s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.turn = c.up),
roots AS (SELECT conv_id, turn, min(up) AS root FROM chain GROUP BY ALL),
done AS (SELECT b.conv_id, b.turn, b.role, CASE WHEN p.parent_turn IS NULL THEN b.turn ELSE coalesce(r.root, p.parent_turn) END AS thread, p.parent_turn,
  coalesce(f.n_quoted, 0)::BIGINT AS n_quoted, coalesce(f.n_linked, 0)::BIGINT AS n_linked, f.far.c AS source_conv, f.far.t AS source_turn, coalesce(o.body, '') AS body
  FROM base b LEFT JOIN facts f USING (rid) LEFT JOIN parents p USING (rid) LEFT JOIN bodies o USING (rid)
  LEFT JOIN roots r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.turn = b.turn)
SELECT conv_id, turn, role, (row_number() OVER (PARTITION BY conv_id ORDER BY thread NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, body) - 1)::BIGINT AS position,
  thread, parent_turn, n_quoted, n_linked, source_conv, source_turn, body FROM done
"""
