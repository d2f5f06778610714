"""Media columns: ISO media containers, written, walked and read back without decoding.

pack() stores a payload as the samples (SAMPLE bytes each) of one raw 8-bit audio track: ftyp, moov with nested
boxes down to the sample tables, mdat. tracks() walks the boxes of any such file, decodes each track's
sample tables and gives codec, duration, number of samples and the byte range and time of each keyframe's run of
samples; inspect() is its first track. unpack() joins the samples' bytes. Sizes over 32 bits take the long forms (64-bit box sizes, co64).

Defined cases: a null payload is an empty one; payloads are padded with zero bytes to a positive multiple of 64;
a box that runs past its parent, nesting over DEEPEST, a file or track without sample tables, and tables that disagree or claim more
samples than the file has bytes raise ValueError; rows are independent,
so ties, repeated rows and other columns don't matter; equal texts give equal files.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

SAMPLE, CHUNK, KEYFRAME, TIMESCALE = 64, 1024, 16, 8000
DEEPEST = 16
CONTAINERS = frozenset([b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf"])
UNITY = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _box(kind: bytes, *parts: bytes) -> bytes:
    size = 8 + sum(map(len, parts))
    return (struct.pack(">I4s", size, kind) if size < 1 << 32 else struct.pack(">I4sQ", 1, kind, size + 8)) + b"".join(parts)


def _full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *parts)


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % SAMPLE or (0 if data else SAMPLE))


def pack(payload: bytes) -> bytes:
    """A container of a payload whose length is a positive multiple of SAMPLE."""
    if not payload or len(payload) % SAMPLE:
        raise ValueError(f"a payload has a positive multiple of {SAMPLE} bytes")
    n = len(payload) // SAMPLE
    chunks, rest = divmod(n, CHUNK)
    runs = ([(1, CHUNK)] if chunks else []) + ([(chunks + 1, rest)] if rest else [])
    n_chunks = chunks + bool(rest)
    keys = range(1, n + 1, KEYFRAME)
    ticks = len(payload)  # a tick a byte
    long = ticks >= 1 << 32
    times = struct.pack(">QQIQ", 0, 0, TIMESCALE, ticks) if long else struct.pack(">IIII", 0, 0, TIMESCALE, ticks)
    version = b"\1\0\0\0" if long else b"\0\0\0\0"
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, TIMESCALE << 16))
    wide = len(payload) >= 1 << 31

    def moov(start: int) -> bytes:
        at = [start + i * CHUNK * SAMPLE for i in range(n_chunks)]
        offsets = _full(b"co64", struct.pack(f">I{n_chunks}Q", n_chunks, *at)) if wide else _full(b"stco", struct.pack(f">I{n_chunks}I", n_chunks, *at))
        stbl = _box(
            b"stbl", _full(b"stsd", struct.pack(">I", 1), entry), _full(b"stts", struct.pack(">III", 1, n, SAMPLE)), _full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", first, per, 1) for first, per in runs)), _full(b"stsz", struct.pack(">II", SAMPLE, n)), offsets,
        )
        minf = _box(b"minf", _full(b"smhd", bytes(4)), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl)
        mdia = _box(b"mdia", _box(b"mdhd", version, times, struct.pack(">HH", 0x55C4, 0)), _full(b"hdlr", bytes(4), b"soun", bytes(12), b"\0"), minf)
        track = struct.pack(">QQIIQ", 0, 0, 1, 0, ticks) if long else struct.pack(">IIIII", 0, 0, 1, 0, ticks)
        tkhd = _box(b"tkhd", version[:3] + b"\7", track, bytes(8), struct.pack(">hhhH", 0, 0, 0x100, 0), UNITY, bytes(8))
        mvhd = _box(b"mvhd", version, times, struct.pack(">iH", 0x10000, 0x100), bytes(10), UNITY, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    head = 16 if len(payload) + 8 >= 1 << 32 else 8
    start = len(ftyp) + len(moov(0)) + head
    return ftyp + moov(start) + _box(b"mdat", payload)


def boxes(data: memoryview, start: int = 0, stop: int | None = None, inside: bytes = b"") -> Iterator[tuple[bytes, int, int]]:
    """(path like moov/trak, start and stop of the body) of every box, parents first."""
    stop = len(data) if stop is None else stop
    if inside.count(b"/") >= DEEPEST:
        raise ValueError("boxes are nested too deep")
    while start < stop:
        if stop - start < 8:
            raise ValueError("a box is cut off")
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if stop - start < 16:
                raise ValueError("a box is cut off")
            (size,), head = struct.unpack_from(">Q", data, start + 8), 16
        size = size or stop - start
        if size < head or start + size > stop:
            raise ValueError(f"box {kind!r} has a wrong size")
        path = inside + b"/" + kind if inside else kind
        yield path, start + head, start + size
        if kind in CONTAINERS:
            yield from boxes(data, start + head, start + size, path)
        start += size


def _table(view: memoryview, at: dict[bytes, tuple[int, int]], kind: bytes, form: str, skip: int = 0) -> list[tuple]:
    """The rows of a table box: its number of rows, then the rows."""
    start, stop = at[kind]
    start += 4 + skip
    if stop - start < 4:
        raise ValueError(f"{kind!r} is cut off")
    (n,) = struct.unpack_from(">I", view, start)
    width = struct.calcsize(form)
    if n * width > stop - start - 4:
        raise ValueError(f"{kind!r} has fewer rows than it says")
    return list(struct.iter_unpack(form, view[start + 4 : start + 4 + n * width]))


def _sizes(view: memoryview, at: dict[bytes, tuple[int, int]]) -> list[int]:
    start, stop = at[b"stsz"]
    if stop - start < 12:
        raise ValueError("b'stsz' is cut off")
    size, n = struct.unpack_from(">II", view, start + 4)
    if not size:
        return [x for (x,) in _table(view, at, b"stsz", ">I", 4)]
    if n * size > len(view):
        raise ValueError("more samples than bytes")
    return [size] * n


def _track(view: memoryview, at: dict[bytes, tuple[int, int]]) -> dict:
    if missing := {b"stsd", b"stts", b"stsc", b"stsz", b"mdhd"} - at.keys() or {b"stco", b"co64"} - at.keys() == {b"stco", b"co64"}:
        raise ValueError(f"no {missing}")
    start, stop = at[b"stsd"]
    if stop - start < 16:
        raise ValueError("b'stsd' is cut off")
    codec = bytes(view[start + 12 : start + 16]).decode("latin-1")
    start, stop = at[b"mdhd"]
    if stop - start < 24:
        raise ValueError("b'mdhd' is cut off")
    (scale,) = struct.unpack_from(">I", view, start + (20 if view[start] else 12))
    if not scale:
        raise ValueError("no time scale")
    sizes = _sizes(view, at)
    n = len(sizes)
    offsets = [x for (x,) in (_table(view, at, b"co64", ">Q") if b"co64" in at else _table(view, at, b"stco", ">I"))]
    # Times: runs of samples that last equally long.
    times, clock = [], 0
    for count, ticks in _table(view, at, b"stts", ">II"):
        if len(times) + count > n:
            raise ValueError("the sample tables disagree")
        times += range(clock, clock + count * ticks, ticks) if ticks else [clock] * count
        clock += count * ticks
    runs = [x[:2] for x in _table(view, at, b"stsc", ">III")]
    firsts = [x for x, _ in runs]
    if firsts != sorted(set(firsts)) or (firsts and not 1 <= firsts[0] <= firsts[-1] <= len(offsets) + (not n)):
        raise ValueError("the sample tables disagree")
    places, chunks, k = [], [], 0
    for (first, per), after in zip(runs, [*firsts[1:], len(offsets) + 1], strict=True):
        for offset in offsets[first - 1 : after - 1]:
            begin = offset
            for s in sizes[k : k + per]:
                places.append(offset)
                offset += s
            k += per
            chunks.append((begin, offset - begin))
    if len(places) != n or k != n or len(times) != n or any(a + size > len(view) for a, size in chunks):
        raise ValueError("the sample tables disagree")
    keys = [x for (x,) in _table(view, at, b"stss", ">I")] if b"stss" in at else list(range(1, n + 1))
    if keys != sorted(set(keys)) or (keys and not 1 <= keys[0] <= keys[-1] <= n):
        raise ValueError("the sample tables disagree")
    ends = [x - 1 for x in keys[1:]] + [n]
    frames = [(places[a - 1], places[b - 1] + sizes[b - 1] - places[a - 1]) for a, b in zip(keys, ends, strict=True)] if keys else []
    return {"codec": codec, "duration": clock / scale, "samples": n, "chunks": chunks, "keyframes": frames, "times": [times[a - 1] / scale for a in keys]}


def tracks(data: bytes) -> list[dict]:
    """codec, duration (seconds), samples, chunks [(offset, bytes)], keyframes [(offset, bytes)] and times (seconds) of those, for each track."""
    view, found = memoryview(data), []
    for path, start, stop in boxes(view):
        parent, _, kind = path.rpartition(b"/")
        if path == b"moov/trak":
            found.append({})
        elif parent.startswith(b"moov/trak") and found:
            found[-1].setdefault(kind, (start, stop))
    return [_track(view, at) for at in found]


def inspect(data: bytes) -> dict:
    """The first track of a file."""
    found = tracks(data)
    if not found:
        raise ValueError("no track")
    return found[0]


def unpack(data: bytes, info: dict | None = None) -> bytes:
    return b"".join(data[at : at + size] for at, size in (info or inspect(data))["chunks"])


def pack_column(df: DataFrame, column: str = "text", into: str = "media") -> DataFrame:
    """df with a binary column of containers."""

    @F.pandas_udf("binary")
    def run(texts):
        return texts.fillna("").map(lambda t: pack(padded(t.encode())))

    return df.withColumn(into, run(F.col(f"`{column}`").cast("string")))


def inspect_column(df: DataFrame, column: str = "media", into: str = "info") -> DataFrame:
    """df with a struct of what inspect() finds; null for null or malformed files."""
    kind = "codec string, duration double, samples long, keyframes array<struct<offset: long, bytes: long>>, times array<double>"

    def one(data):
        try:
            x = inspect(bytes(data))
        except (ValueError, struct.error, IndexError, TypeError):
            return None, None, None, None, None
        return x["codec"], x["duration"], x["samples"], x["keyframes"], x["times"]

    @F.pandas_udf(kind)
    def run(files):
        import pandas as pd

        return pd.DataFrame([one(f) for f in files], columns=["codec", "duration", "samples", "keyframes", "times"])

    return df.withColumn(into, run(F.col(f"`{column}`")))


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: what is stored for its text and read back from that."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in slices(batches):
            out: list[list] = [[] for _ in names[1:]]
            for text in batch.column(1):
                raw = (text.as_py() or "").encode()
                media = pack(padded(raw))
                info = inspect(media)
                back = unpack(media, info)
                frames = info["keyframes"]
                ranges = ";".join(f"{a}+{n}" for a, n in frames)
                feature = f"codec={info['codec'].strip()},seconds={info['duration']:.6f},samples={info['samples']},keyframes={len(frames)},ranges={zlib.crc32(ranges.encode()):08x}"
                for column, x in zip(out, (len(raw), len(back), sha(back), zlib.crc32(back[-64:]), len(media), sha(media), feature), strict=True):
                    column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
