"""Packing documents into token windows by minimum bin slack.

A document's ids, with END after them, are cut into pieces of WINDOW ids and a remaining piece. What is packed are remaining
lengths, not documents: a histogram of at most WINDOW lengths says how many pieces there are of each, whatever the corpus' size.
windows_for() fills one window after another from it: the longest remaining length goes in first, and subset sums over the
other lengths, kept as the bits of an integer (how often a length may be used enters by powers of two), give the total closest to the room that is left.
The counts of the lengths that make it are found by going back through the sums. A filling is used as often as its lengths last, so there are about as many
fillings as lengths. Where no filling is exact, the longest piece that is left is cut to the slack. The last window's ids go
into sequences whose lengths are powers of two, which need no padding, so that nothing is padded at all.

On the cluster: a task cuts its documents and counts its pieces by length; the counts of tasks give each piece its rank among those of its
length, and the plan, a small table of ranges of ranks, its sequence and place. Pieces are not shuffled for it
(unless there are more than BROADCAST_ROWS counts of tasks), and no task holds all pieces of a frequent length.

Result of pack(), one row per piece: doc_id, start (its document's ids before it), length, ids (little-endian unsigned 32-bit),
doc_tokens (the document's, with END), sequence_id, offset (in the sequence). Defined cases: a null text is an empty text, which is END alone; very long texts are
tokenised whole; repeated rows and rows with a null id are documents of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import drop_encoders, fast_encoder, shipped_tokenizer
from .common import claim, map_arrow, materialise, release, slices, small

WINDOW, END = 1024, 0
#: Bytes of text whose pieces are made at once.
TEXT = 2 << 20
PLAN = "length long, first long, n long, cut long, size long, at long, times long, sequence long, place long"


def fill(have: dict[int, int], room: int) -> dict[int, int]:
    """How often to use each length, at most as often as there is one, for the total nearest to room but not above it."""
    sums, steps, whole = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in have if x <= room), reverse=True):
        left, many = min(have[length], room // length), 1
        while left and not sums >> room & 1:
            use = min(many, left)
            steps.append((length, use, sums))
            sums |= sums << length * use & whole
            left, many = left - use, many * 2
        if sums >> room & 1:
            break
    total, out = sums.bit_length() - 1, Counter()
    for length, use, before in reversed(steps):
        if not before >> total & 1:
            out[length] += use
            total -= length * use
    return dict(out)


class Lots:
    """What is left of the pieces: by length, ranges (original length, first rank, number, ids cut off before)."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.have = {x: n for x, n in counts.items() if n}
        self.ranges = {x: deque([(x, 0, n, 0)]) for x, n in self.have.items()}

    def take(self, length: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """n pieces of a length, as ranges."""
        own = self.ranges[length]
        self.have[length] -= n
        if not self.have[length]:
            del self.have[length]
        while n:
            origin, first, many, cut = own.popleft()
            use = min(n, many)
            if use < many:
                own.appendleft((origin, first + use, many - use, cut))
            n -= use
            yield origin, first, use, cut

    def put(self, length: int, lot: tuple[int, int, int, int]) -> None:
        self.ranges.setdefault(length, deque()).append(lot)
        self.have[length] = self.have.get(length, 0) + lot[2]


def windows_for(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, ...]]:
    """The plan (PLAN) for so many pieces of each length: the i-th piece (by rank) of `length`, first <= i < first + n, has its ids [cut, cut + size) as
    item j = at + i - first of `times` a sequence: in sequence + j div times, at place + (j % times) * size."""
    lots, plan, sequence = Lots(counts), [], 0
    while lots.have:
        top = max(lots.have)
        rest = {**lots.have, top: lots.have[top] - 1}
        using = Counter(fill({x: n for x, n in rest.items() if n}, window - top))
        using[top] += 1
        slack = window - sum(x * k for x, k in using.items())
        longer = max((x for x, n in lots.have.items() if n > using[x]), default=0) if slack else 0
        if slack and not longer:  # all that is left is in this window
            plan += last_window(lots, window - slack, sequence)
            return plan
        needs = Counter(using)
        needs[longer] += bool(longer)
        windows = min(lots.have[x] // k for x, k in needs.items() if k)
        place = 0
        for length, k in sorted(using.items(), reverse=True):
            at = 0
            for origin, first, n, cut in lots.take(length, k * windows):
                plan.append((origin, first, n, cut, length, at, k, sequence, place))
                at += n
            place += length * k
        if longer:
            at = 0
            for origin, first, n, cut in list(lots.take(longer, windows)):
                plan.append((origin, first, n, cut, slack, at, 1, sequence, place))
                lots.put(longer - slack, (origin, first, n, cut + slack))
                at += n
        sequence += windows
    return plan


def last_window(lots: Lots, total: int, sequence: int) -> Iterator[tuple[int, ...]]:
    """All that is left, in sequences as long as the powers of two that make up the total."""
    sizes = [1 << b for b in reversed(range(total.bit_length())) if total >> b & 1]
    at = 0
    for length in sorted(lots.have, reverse=True):
        for origin, first, n, cut in list(lots.take(length, lots.have[length])):
            for i in range(n):
                done = 0
                while done < length:
                    use = min(length - done, sizes[0] - at)
                    yield origin, first + i, 1, cut + done, use, 0, 1, sequence, at
                    done, at = done + use, at + use
                    if at == sizes[0]:
                        sizes, sequence, at = sizes[1:], sequence + 1, 0


def cut(docs: DataFrame, id_col: str, text_col: str, tokenizer: str | None, window: int) -> DataFrame:
    """doc_id, doc_tokens, start, length, ids; part (the task) and rank (among the task's pieces of the length), which are fixed once this is written."""
    shipped = shipped_tokenizer(docs, tokenizer)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing", drop_encoders)
        encode, part, ranks = fast_encoder(shipped.value), TaskContext.get().partitionId(), Counter()
        for batch in slices(batches, most=TEXT):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + END.to_bytes(4, "little")
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    rows.append((doc, total, start, length, ids[4 * start : 4 * (start + length)], part, ranks[length]))
                    ranks[length] += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "doc_tokens", "start", "length", "ids", "part", "rank"])
        release()

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id long, doc_tokens long, start long, length long, ids binary, part long, rank long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = materialise(cut(docs, id_col, text_col, tokenizer, window))
    counts = materialise(pieces.groupBy("part", "length").count())
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most `window` rows
    plan = spark.createDataFrame(windows_for(histogram, window), PLAN)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(small(materialise(starts)), ["part", "length"]).withColumn("rank", F.col("before") + F.col("rank"))
    met = ranked.join(F.broadcast(plan.withColumnRenamed("cut", "from")), "length").filter("rank >= first and rank < first + n")
    ids = F.substring(F.col("ids"), (F.col("from") * 4 + 1).cast("int"), (F.col("size") * 4).cast("int"))
    return met.select("doc_id", (F.col("start") + F.col("from")).alias("start"), F.col("size").alias("length"), ids.alias("ids"), "doc_tokens", F.expr("sequence + (at + rank - first) div times").alias("sequence_id"), F.expr("place + (at + rank - first) % times * size").alias("offset"))


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """pack() with ids_crc32 in the place of the ids."""
    packed = pack(docs, tokenizer=tokenizer)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
