"""Sites cell by cell, as arrays: a task takes a cell's sites of a chunk of the genome, and sets each beside the cell's site before it.

A region is first reached by a cell's site if the cell's site before it lies outside, so pairs of cells and regions are found once, without lists of sites or of pairs.
Regions belong to the chunk where they start; a site goes to each chunk (two at most) where a region that holds it can start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sites that a task takes, and rows that it holds before equal ones are counted.
SITES, HELD = 1 << 19, 1 << 22
#: Different lengths of regions that are summed at once, the least width of a chunk, and the greatest, which no summed region may exceed.
LENGTHS, CHUNK = 16, (1 << 16, 1 << 20)
#: Sites, or pairs of a site and a region, that are handled at once.
AT_ONCE = 1 << 20


def _gathered(batches: Iterable[pa.RecordBatch], held: int = HELD) -> pa.Table | None:
    """A task's rows, with __n, their number; where they are very many, equal ones are one, so a hot cell holds no more than different bases."""
    parts: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            one = pa.Table.from_batches([batch])
            parts.append(one.append_column("__n", pa.array(np.ones(one.num_rows, np.int64))))
            rows += one.num_rows
        if rows > held:
            whole = pa.concat_tables(parts)
            names = [c for c in whole.column_names if c != "__n"]
            parts = [whole.group_by(names, use_threads=False).aggregate([("__n", "sum")]).select([*names, "__n_sum"]).rename_columns([*names, "__n"])]
            rows, held = parts[0].num_rows, max(held, 2 * parts[0].num_rows)
    return pa.concat_tables(parts).combine_chunks() if rows else None


def _column(table: pa.Table, name: str) -> pa.Array:
    c = table.column(name)
    return c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks)


def _codes(table: pa.Table, names: list[str]) -> np.ndarray:
    """A number for each row, equal where all these columns are; nulls are equal."""
    code, most = np.zeros(table.num_rows, np.int64), 1
    for name in names:
        d = _column(table, name).dictionary_encode()
        if most * (len(d.dictionary) + 1) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            most = table.num_rows
        code = code * (len(d.dictionary) + 1) + d.indices.fill_null(-1).to_numpy(zero_copy_only=False) + 1
        most *= len(d.dictionary) + 1
    return code


@dataclass(frozen=True)
class Sites:
    """Different sites in the order of cells and chunks, which `run` numbers, and bases: the table's row of each, how many are equal, how far the one before in the run is, at most."""

    row: np.ndarray
    run: np.ndarray
    at: np.ndarray
    n: np.ndarray
    gap: np.ndarray


def _sorted(table: pa.Table, keys: list[str], longest: int) -> Sites:
    cell, place, at = _codes(table, keys), _codes(table, ["chrom", "__in"]), _column(table, "start").to_numpy().astype(np.int64)
    order = _order(at, place, cell)
    cell, place, at = cell[order], place[order], at[order]
    first = _starts(at, place, cell)
    n = np.add.reduceat(_column(table, "__n").to_numpy()[order], first)
    cell, place, at = cell[first], place[first], at[first]
    begins = _starts(place, cell)
    gap = np.minimum(np.diff(at, prepend=at[:1]), longest)
    gap[begins] = longest
    run = np.zeros(len(at), np.int64)
    run[begins[1:]] = 1
    return Sites(order[first], np.cumsum(run), at, n, gap)


def _dealt(bases: DataFrame, keys: list[str], longest: int, width: int) -> tuple[DataFrame, int]:
    """(chrom, start, keys, __in) of sites by the chunks of a width that they go to, a cell's sites of a chunk in one task, and the number of tasks."""
    some = bases.select("chrom", "start", *keys).filter("chrom is not null and start is not null")
    tasks = max(bases.sparkSession.sparkContext.defaultParallelism, -(-some.count() // SITES))
    own, before = (F.floor(at / width) for at in (F.col("start"), F.col("start") - (longest - 1)))
    return some.withColumn("__in", F.explode(F.when(own == before, F.array(own)).otherwise(F.array(own, before)))).repartition(tasks, "chrom", "__in", *keys), tasks


def _order(*keys: np.ndarray) -> np.ndarray:
    """The order of rows by the last key, then the one before it: of one number for all of them where that fits."""
    room = [int(k.max() - k.min()) + 1 for k in keys]
    if np.prod(np.array(room, dtype=object)) >= 1 << 62:
        return np.lexsort(keys)
    whole = np.zeros(len(keys[0]), np.int64)
    for k, n in zip(reversed(keys), reversed(room), strict=True):
        whole = whole * n + (k - k.min())
    return np.argsort(whole, kind="stable")


def _starts(values: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """The places where any of some sorted keys changes, with 0."""
    change = np.zeros(len(values), bool)
    change[:1] = True
    for v in (values, *more):
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


# Sums over regions


def held(bases: DataFrame, spans: DataFrame, by: tuple[str, ...], cell: str, lengths: list[int]) -> DataFrame:
    """(chrom, start, end, by, total, cells) of different regions (spans) of a few lengths that hold sites: their sites, and the different cells of them.

    A site at p whose cell's site before is at q is in the regions of a length that start from p - length + 1 to p, and the cell's first in those that start after q. So sums over the regions of a
    length are running sums over starts, and work doesn't grow with the number of regions over a base. Sites shuffle to their cells, and as packed numbers to chunks.
    """
    longest = max(lengths)
    width = max(CHUNK[0], 1 << (longest - 1).bit_length())
    types = {f.name: f.dataType for f in bases.schema}
    named = "".join(f", `{c}` {types[c].simpleString()}" for c in by)
    keys = list(dict.fromkeys([cell, *by]))

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _gathered(batches)
        if t is None:
            return
        s = _sorted(t, keys, longest)
        of, place = _codes(t, list(by))[s.row], _codes(t, ["chrom", "__in"])[s.row]
        order = _order(place, of)
        first = _starts(place[order], of[order])
        chunk = _column(t, "__in").to_numpy()[s.row]
        packed = np.stack([s.at - chunk * width, s.gap, s.n], axis=1).astype(np.int32)[order]
        rows = pa.array(s.row[order[first]])
        columns = {"chrom": _column(t, "chrom").take(rows), "chunk": _column(t, "__in").take(rows), "length": pa.nulls(len(first), pa.int64()), "start": pa.nulls(len(first), pa.int64())}
        columns["sites"] = pa.array([packed[a:b].tobytes() for a, b in zip(first, [*first[1:], len(packed)], strict=True)], pa.binary())
        yield pa.RecordBatch.from_pydict(columns | {c: _column(t, c).take(rows) for c in by})

    dealt, tasks = _dealt(bases, keys, longest, width)
    sites = dealt.mapInArrow(spread, f"chrom string, chunk long, length long, start long, sites binary{named}")
    start = F.col("start").cast("long")
    asked = spans.select("chrom", F.floor(start / width).alias("chunk"), (F.col("end") - F.col("start")).cast("long").alias("length"), start.alias("start"), F.lit(None).cast("binary").alias("sites"), *(F.lit(None).cast(types[c]).alias(c) for c in by))
    # A chunk's regions come before its sites.
    met = sites.unionByName(asked).repartition(tasks, "chrom", "chunk").sortWithinPartitions("chrom", "chunk", F.col("sites").isNotNull(), *by)
    return met.mapInArrow(_summer(width, by), f"chrom string, start long, end long{named}, total long, cells long")


def _summer(width: int, by: tuple[str, ...]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of a chunk's regions from its packed sites, which come in the order of `by`: a task holds a chunk's sums, whatever the number of sites."""

    def added(sums: dict[int, np.ndarray], packed: list[bytes]) -> None:
        off, gap, n = np.frombuffer(b"".join(packed), np.int32).reshape(-1, 3).T.astype(np.int64)
        for length, total in sums.items():
            for i, (back, weight) in enumerate(((np.full(len(off), length), n), (np.minimum(gap, length), np.ones(len(off), np.int64)))):
                some = off - back + 1 < width
                low, high, w = np.maximum(off - back + 1, 0)[some], np.minimum(off, width - 1)[some] + 1, weight[some]
                total[i] += np.bincount(low, w, width + 1) - np.bincount(high, w, width + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: tuple = ()
        own: tuple = ()
        spans: dict[int, list[int]] = {}
        sums: dict[int, np.ndarray] = {}
        packed: list[bytes] = []
        size = 0
        schema = None

        def summed() -> Iterator[pa.RecordBatch]:
            if packed:
                added(sums, packed)
            for length, diff in sums.items():
                total, cells = (np.rint(np.cumsum(x[:-1])).astype(np.int64) for x in diff)
                at = np.array(spans[length]) - place[1] * width
                at = at[total[at] > 0]
                columns = {"chrom": pa.array([place[0]] * len(at), pa.string()), "start": pa.array(at + place[1] * width), "end": pa.array(at + place[1] * width + length)}
                columns |= {c: pa.array([x] * len(at), schema.field(c).type) for c, x in zip(by, own, strict=True)}
                yield pa.RecordBatch.from_pydict(columns | {"total": pa.array(total[at]), "cells": pa.array(cells[at])})

        for batch in batches:
            schema = batch.schema
            column = {c: batch.column(c).to_pylist() for c in ("chrom", "chunk", "length", "start", *by)}
            for i, length in enumerate(column["length"]):
                here, keys = (column["chrom"][i], column["chunk"][i]), tuple(column[c][i] for c in by)
                if here != place or keys != own:
                    yield from summed()
                    packed, size, sums = [], 0, {}
                    spans = spans if here == place else {}
                    place, own = here, keys
                if length is not None:
                    spans.setdefault(length, []).append(column["start"][i])
                elif spans:
                    sums = sums or {x: np.zeros((2, width + 1)) for x in spans}
                    packed.append(batch.column("sites")[i].as_py())
                    size += len(packed[-1]) // 12
                    if size > AT_ONCE:
                        added(sums, packed)
                        packed, size = [], 0
        yield from summed()

    return run


# Pairs of cells and regions


def pairs(bases: DataFrame, regions: DataFrame, keys: list[str], least: int, packed: bool = False) -> DataFrame:
    """(keys, __rid, count): a row for each combination of keys and each region (chrom, start, end, __rid; few) with sites in it. Sites shuffle once, to their cells; regions are broadcast.

    Pairs are listed from the first of a cell's sites in a region, so no pair is made twice or has to be grouped. least: the least width of a chunk whose sites of a cell are in one task.
    packed: (keys, on) instead, with arrays of __rid, which are several of the same keys.
    """
    table = regions.select("chrom", "start", "end", "__rid").toPandas()
    longest = int((table["end"] - table["start"]).max()) if len(table) else 1
    width = max(least, 1 << (longest - 1).bit_length())
    kinds: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray, int, bool]]] = {}  # regions of about the same length in order of starts, the longest, and whether all are
    for (chrom, _), g in table.groupby(["chrom", np.ceil(np.log2(table["end"] - table["start"])).astype(int)]):
        low, high, rid = (g.sort_values("start")[c].to_numpy() for c in ("start", "end", "__rid"))
        kinds.setdefault(chrom, []).append((low, high, rid, int((high - low).max()), len(np.unique(high - low)) == 1))
    shipped = bases.sparkSession.sparkContext.broadcast(kinds)
    types = {f.name: f.dataType.simpleString() for f in bases.schema}

    def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _gathered(batches)
        if t is None:
            return
        s = _sorted(t, keys, longest)
        # A site's place in the order of all, and that of any base in the run of a site.
        room = int(s.at.max() - s.at.min()) + 2
        line = s.run * room + s.at - s.at.min()
        upto = np.concatenate([[0], np.cumsum(s.n)])
        names = _column(t, "chrom").take(pa.array(s.row)).dictionary_encode()
        chunk = _column(t, "__in").to_numpy()[s.row]
        columns = {c: _column(t, c) for c in keys}
        for i, name in enumerate(names.dictionary.to_pylist()):
            own = np.flatnonzero(names.indices.to_numpy() == i)
            for low, high, rid, length, same in shipped.value.get(name, ()):
                a = np.searchsorted(low, np.maximum(s.at[own] - np.minimum(s.gap[own], length) + 1, chunk[own] * width))
                number = np.maximum(np.searchsorted(low, np.minimum(s.at[own] + 1, (chunk[own] + 1) * width)) - a, 0)
                ends, first = np.cumsum(number), 0
                while first < len(own):
                    last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + AT_ONCE, "right")))
                    some = number[first:last]
                    site = np.repeat(own[first:last], some)
                    region = np.arange(len(site)) + np.repeat(a[first:last] - np.cumsum(some) + some, some)
                    first = last
                    if not same:
                        inside = s.at[site] < high[region]
                        site, region = site[inside], region[inside]
                    if not len(site):
                        continue
                    beyond = np.searchsorted(line, s.run[site] * room + np.minimum(high[region] - s.at.min(), room - 1))
                    count, begins = upto[beyond] - upto[site], _starts(s.run[site]) if packed else slice(None)
                    rows = pa.array(s.row[site[begins]])
                    out = {"__rid": pa.array(rid[region]), "count": pa.array(count)}
                    if packed:
                        ends = pa.array([*begins, len(site)], pa.int32())
                        out = {"on": pa.ListArray.from_arrays(ends, out["__rid"]), "n": pa.ListArray.from_arrays(ends, out["count"])}
                    yield pa.RecordBatch.from_pydict({c: x.take(rows) for c, x in columns.items()} | out)

    dealt, _ = _dealt(bases, keys, longest, width)
    kind = regions.schema["__rid"].dataType.simpleString()
    return dealt.mapInArrow(met, ", ".join([*(f"`{c}` {types[c]}" for c in keys), *([f"on array<{kind}>", "n array<long>"] if packed else [f"__rid {kind}", "count long"])]))
