"""BAM files (block-compressed binary alignments) as a data source of Spark whose partitions are byte ranges of files.

A partition has the alignments that begin in the blocks that begin in its range. It looks for the first of these blocks by its header and that
of the block that follows it, and in its bytes for the first place from which a chain of plausible alignments starts; it reads on behind its
range until its last alignment is whole. So a file is read by as many tasks as it has ranges, and a task holds a few blocks and a batch of alignments.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

COLUMNS = "name string, flag int, chrom string, start long, end long, mapq int, tlen long, quality long, ms long, order long"
FLOOR = 15
#: Sizes of optional fields by type, and which alignment operations advance on the reference.
WIDTHS = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
FORMS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I"}
ADVANCING = (0, 2, 3, 7, 8)


#: Bytes that are read at once; bytes of a range at most and at least.
CHUNK, MOST, LEAST = 1 << 18, 32 << 20, 1 << 16
#: Alignments that must follow on each other for a place to be the start of one, and the longest optional part that such a one may have.
CHAIN, OPTIONAL = 8, 16 << 20


def located(path: str):
    """(file system, place) of a path in any store that pyarrow.fs knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")


def block_size(head: bytes, at: int = 0) -> int | None:
    """The length of the compressed block whose header is at a place, None if no header is there."""
    if head[at : at + 4] != b"\x1f\x8b\x08\x04" or len(head) < at + 18:
        return None
    p, end = at + 12, at + 12 + struct.unpack_from("<H", head, at + 10)[0]
    while p + 6 <= min(end, len(head)):
        n = struct.unpack_from("<H", head, p + 2)[0]
        if head[p : p + 2] == b"BC" and n == 2:
            return struct.unpack_from("<H", head, p + 4)[0] + 1
        p += 4 + n
    return None


def first_block(file, size: int, start: int, end: int) -> int | None:
    """The first place in [start, end) at which a block begins: a header, and where it ends another one or the file's end."""
    at, held = start, b""
    while at < end:
        held = file.read_at(min(CHUNK, size - at), at)
        here = held.find(b"\x1f\x8b\x08\x04")
        while here >= 0 and at + here < end:
            n = block_size(file.read_at(min(1 << 10, size - at - here), at + here))
            after = at + here + (n or 0)
            if n and (after == size or (after < size and block_size(file.read_at(min(1 << 10, size - after), after)))):
                return at + here
            here = held.find(b"\x1f\x8b\x08\x04", here + 1)
        at += max(1, len(held) - 3)
    return None


def pieces(file, size: int) -> Iterator[bytes]:
    """The bytes of a file of plain gzip members, which can't be read from a place inside."""
    d = zlib.decompressobj(31)
    for at in range(0, size, CHUNK):
        raw = file.read_at(min(CHUNK, size - at), at)
        while raw:
            yield d.decompress(raw)
            raw = d.unused_data
            if d.eof:
                d = zlib.decompressobj(31)


class Inflated:
    """The bytes of a file's blocks from one on, by their place in what is inflated; what has been used can be forgotten."""

    def __init__(self, file, size: int, at: int) -> None:
        self.file, self.size, self.at, self.raw = file, size, at, b""
        self.data, self.first = bytearray(), 0
        self.places: list[int] = []
        self.blocks: list[int] = []
        self.plain = None if at or block_size(file.read_at(min(1 << 10, size), 0)) else pieces(file, size)
        if self.plain:
            self.places, self.blocks, self.at = [0], [0], size

    def has(self, end: int) -> bool:
        """Whether there are bytes up to a place; blocks are read if need be."""
        while self.first + len(self.data) < end:
            if self.plain:
                piece = next(self.plain, None)
                if piece is None:
                    return False
                self.data += piece
                continue
            if self.at >= self.size:
                return False
            if len(self.raw) < min(1 << 17, self.size - self.at):  # a block is shorter
                self.raw += self.file.read_at(min(CHUNK, self.size - self.at - len(self.raw)), self.at + len(self.raw))
            n = block_size(self.raw)
            if not n or len(self.raw) < n:
                raise ValueError("the file is cut off or not compressed in blocks")
            self.places.append(self.first + len(self.data))
            self.blocks.append(self.at)
            self.data += zlib.decompress(self.raw[12 + struct.unpack_from("<H", self.raw, 10)[0] : n - 8], -15)
            self.raw, self.at = self.raw[n:], self.at + n
        return True

    def get(self, a: int, b: int) -> bytes:
        if not self.has(b):
            raise ValueError("the file is cut off")
        return bytes(memoryview(self.data)[a - self.first : b - self.first])

    def block(self, place: int) -> tuple[int, int]:
        """(where the block begins in the file, the place's distance from its start)."""
        i = bisect_right(self.places, place) - 1
        return self.blocks[i], place - self.places[i]

    def forget(self, place: int) -> None:
        if place - self.first > CHUNK:
            del self.data[: place - self.first]
            self.first = place
            i = max(0, bisect_right(self.places, place) - 1)
            del self.places[:i], self.blocks[:i]


def references(data: Inflated) -> tuple[list[str], int]:
    """The names of the reference sequences, and the place of the first alignment."""
    if not data.has(8) or data.get(0, 4) != b"BAM\1":
        raise ValueError("not a BAM file")
    number = lambda at: struct.unpack("<i", data.get(at, at + 4))[0]
    at = 8 + number(4)
    names, at, n = [], at + 4, number(at)
    for _ in range(n):
        long = number(at)
        names.append(data.get(at + 4, at + 3 + long).decode())
        at += 8 + long
    return names, at


def plausible(data: Inflated, at: int, n_references: int) -> int | None:
    """The place behind the alignment that may be at a place, None if none can be."""
    if not data.has(at + 36):
        return None
    size, ref, pos, l_name, _, _, n_ops, flag, l_seq, mate, mate_pos, _ = struct.unpack("<iiiBBHHHiiii", data.get(at, at + 36))
    least = 32 + l_name + 4 * n_ops + (l_seq + 1) // 2 + l_seq
    if not (-1 <= ref < n_references and -1 <= mate < n_references and pos >= -1 and mate_pos >= -1 and l_name and l_seq >= 0 and flag < 4096 and least <= size <= least + OPTIONAL):
        return None
    if not data.has(at + 36 + l_name):
        return None
    name = data.get(at + 36, at + 36 + l_name)
    return at + 4 + size if name[-1] == 0 and all(33 <= c <= 126 for c in name[:-1]) else None


def first_alignment(data: Inflated, end: int, n_references: int) -> int | None:
    """The first place, in a block that begins before `end` in the file, from which plausible alignments follow on each other, CHAIN of them or up to the file's end."""
    at = 0
    while data.has(at + 4) and data.block(at)[0] < end:
        to, n = at, 0
        while to is not None and n < CHAIN and data.has(to + 1):
            to, n = plausible(data, to, n_references), n + 1
        if n and to is not None:
            return at
        at += 1
    return None


def mate_score(aux: bytes) -> int | None:
    at = 0
    while at + 3 <= len(aux):
        tag, kind, at = aux[at : at + 2], chr(aux[at + 2]), at + 3
        if kind in "ZH":
            at = aux.index(0, at) + 1
        elif kind == "B":
            at += 5 + WIDTHS[chr(aux[at])] * struct.unpack_from("<i", aux, at + 1)[0]
        else:
            if tag == b"ms" and kind in FORMS:
                return struct.unpack_from(FORMS[kind], aux, at)[0]
            at += WIDTHS[kind]
    return None


def alignments(file, size: int, start: int = 0, end: int | None = None, batch: int = 20_000) -> Iterator[pd.DataFrame]:
    """The alignments that begin in the blocks that begin in [start, end) of a file. order: 65,536 times the place of their block, plus their place in it."""
    end = size if end is None else end
    data = Inflated(file, size, 0)
    if data.plain:
        if start > 0:
            return  # the first range has all
        end = size
    names, at = references(data)
    if start > 0:
        block = first_block(file, size, start, end)
        if block is None:
            return
        if block > data.block(at)[0] or not data.has(at + 1):  # else the header reaches into this range, and the first alignment is known
            at = first_alignment(data := Inflated(file, size, block), end, len(names))
    rows, columns = [], re.findall(r"(\w+) \w+", COLUMNS)
    while at is not None and data.has(at + 4):
        block, within = data.block(at)
        if block >= end:
            break
        raw = data.get(at + 4, at + 4 + struct.unpack("<i", data.get(at, at + 4))[0])
        ref, pos, l_name, mapq, _, n_ops, flag, l_seq, _, _, tlen = struct.unpack_from("<iiBBHHHiiii", raw)
        p = 32
        name, p = raw[p : p + l_name - 1].decode(), p + l_name
        ops, p = struct.unpack_from(f"<{n_ops}I", raw, p), p + 4 * n_ops + (l_seq + 1) // 2
        quality, p = sum(q for q in raw[p : p + l_seq] if q != 255 and q >= FLOOR), p + l_seq
        span = sum(x >> 4 for x in ops if x & 15 in ADVANCING)
        rows.append((name, flag, names[ref] if ref >= 0 else None, pos, pos + span, mapq, tlen, quality, mate_score(raw[p:]), (block << 16) + within))
        at += 4 + len(raw)
        data.forget(at)
        if len(rows) >= batch:
            yield pd.DataFrame(rows, columns=columns).astype({"ms": "Int64"})
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=columns).astype({"ms": "Int64"})


@dataclass
class Range(InputPartition):
    """Bytes [start, end) of a file."""

    path: str
    size: int
    start: int
    end: int


class BamReader(DataSourceReader):
    def __init__(self, paths: list[str], split: int | None, tasks: int) -> None:
        self.paths, self.split, self.tasks = paths, split, tasks

    def files(self) -> list[tuple[str, int]]:
        """(path, size) of all files at the paths and below them."""
        from pyarrow import fs

        out = []
        for path in self.paths:
            store, place = located(path)
            base, info = path[: len(path) - len(place)] if path.endswith(place) else "", store.get_file_info(place)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            below = [info] if info.is_file else store.get_file_info(fs.FileSelector(place, recursive=True))
            out += sorted((base + f.path, f.size) for f in below if f.is_file and not f.base_name.startswith(("_", ".")))
        return out

    def partitions(self) -> list[Range]:
        files = self.files()
        step = self.split or min(MOST, max(LEAST, -(-sum(n for _, n in files) // max(self.tasks, 1))))
        return [Range(path, size, at, min(at + step, size)) for path, size in files for at in range(0, size, step)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, place = located(partition.path)
        with store.open_input_file(place) as f:
            for rows in alignments(f, partition.size, partition.start, partition.end):
                yield pa.RecordBatch.from_pandas(rows.astype({"flag": "int32", "mapq": "int32"}), preserve_index=False)


class BamSource(DataSource):
    """Options: paths (a JSON list), split (bytes of a range; else by the number of tasks, from LEAST to MOST), tasks."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> BamReader:
        return BamReader(json.loads(self.options["paths"]), int(self.options["split"]) if "split" in self.options else None, int(self.options.get("tasks", 1)))


def write(path: str, names: list[str], batches: Iterable[pd.DataFrame], block: int = 60_000) -> int:
    """Writes alignments (name, flag, chrom, start, end, mapq, tlen, ms) as a BAM file; their number."""
    store, place = located(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    index, n = {x: i for i, x in enumerate(names)}, 0

    def packed(data: bytes) -> bytes:
        """A block: a gzip member that says how long it is."""
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(data) + c.flush()
        return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))

    head = b"BAM\1" + struct.pack("<ii", 0, len(names)) + b"".join(struct.pack("<i", len(x.encode()) + 1) + x.encode() + b"\0" + struct.pack("<i", (1 << 31) - 1) for x in names)
    with store.open_output_stream(place, compression=None) as out:
        held = bytearray(head)
        for batch in batches:
            for name, flag, chrom, start, end, mapq, tlen, ms in batch.itertuples(index=False, name=None):
                key = name.encode() + b"\0"
                aux = b"" if pd.isna(ms) else b"msi" + struct.pack("<i", int(ms))
                body = struct.pack("<iiBBHHHiiii", index.get(chrom, -1), int(start), len(key), int(mapq), 0, 1, int(flag), 0, -1, -1, int(tlen)) + key + struct.pack("<I", int(end - start) << 4) + aux
                held += struct.pack("<i", len(body)) + body
                n += 1
                while len(held) >= block:
                    out.write(packed(bytes(held[:block])))
                    del held[:block]
        if held:
            out.write(packed(bytes(held)))
        out.write(packed(b""))
    return n
