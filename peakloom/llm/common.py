"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..storage import BROADCAST_ROWS, ROW_GROUP, discard, made, materialise, new_path, running, small

__all__ = ["BROADCAST_ROWS", "attach", "claim", "discard", "made", "map_arrow", "materialise", "one_by_one", "release", "running", "slices", "small"]

#: Bytes of an Arrow batch on its way to a Python worker, about (a row at least).
ARROW_BYTES = 4 << 20
#: A key with more than 1/HEAVY_PARTS of all rows is heavy; there are fewer than HEAVY_PARTS of them.
HEAVY_PARTS = 4096


def attach(df: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int) -> DataFrame:
    """Left join of df with groups (one row per non-null key, size = rows of df with that key).

    The rows of heavy keys meet a broadcast table of fewer than HEAVY_PARTS rows; the rest
    shuffle by keys of which none has more than max(100, total / HEAVY_PARTS) rows.
    """
    most = max(100, total // HEAVY_PARTS)
    heavy = groups.filter(F.col(size) > most)
    if not heavy.limit(1).count():
        return df.join(groups, key, "left")
    hot = F.broadcast(heavy)
    return df.join(hot, key).unionByName(df.join(hot, key, "left_anti").join(groups.filter(F.col(size) <= most), key, "left"))


def one_by_one(frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of frames, each written in a job of its own, so that what one of them broadcasts is let go before the next one is made. At least one frame is needed."""
    paths: list[str] = []
    for df in frames:
        spark, form = df.sparkSession, df.schema
        paths.append(new_path(spark))
        df.write.options(**{"parquet.block.size": str(ROW_GROUP)}).parquet(paths[-1])
        if len(paths) > 1:
            del df
            gc.collect()
            spark._jvm.System.gc()  # broadcasts go when the driver's JVM finds that no plan refers to them
    return spark.read.schema(form).parquet(*paths)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], form: str | StructType) -> DataFrame:
    """df.mapInArrow(run, form) with batches of about ARROW_BYTES, where the session doesn't name a size: 10,000 whole texts can take most of a worker's memory."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) is None:
        conf.set(name, str(ARROW_BYTES))
    return df.mapInArrow(run, form)


def slices(batches: Iterable[pa.RecordBatch], column: int = 1, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of batches in slices of about `most` bytes of the text in one column, at least a row each."""
    for batch in batches:
        start = size = 0
        for i, n in enumerate(_lengths(batch.column(column))):
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


def release() -> None:
    """Gives memory that this worker has freed back to the system, so that it isn't held while the worker waits for its next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: What operators keep in this Python worker from task to task, with what drops it.
_kept: dict[str, Callable[[], None]] = {}


def claim(operator: str, drop: Callable[[], None] | None = None) -> None:
    """To be called as a task of an operator starts: drops what other operators have kept in this worker."""
    others = [x for x in _kept if x != operator]
    for other in others:
        _kept.pop(other)()
    if others:
        release()
    if drop:
        _kept[operator] = drop


def _lengths(texts: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()

