"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from touchline.plans import workers
from touchline.session import scratch_path

#: Text bytes handled at once inside a task (one longer text is handled alone).
GROUP_BYTES = 1 << 20
#: Rows of one Arrow batch, unless the session asks for another number than Spark's default.
BATCH_ROWS = 4_000

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends there, so a lost executor re-reads files instead of redoing
    the work before them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps that are over; it
    acts when the driver collects its garbage, by itself only every half hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """``workers.ship_package``, with Arrow batches for whole texts."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":  # whole texts: that many fill a worker
        spark.conf.set(rows, str(BATCH_ROWS))
    workers.ship_package(spark)


_kept: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """What the tasks of ``owner`` (a module) keep in this worker process from
    one to the next; what another owner's tasks have kept is let go, so a worker
    that serves several operators holds the tables of one."""
    others = [k for k in _kept if k != owner]
    for k in others:
        _kept.pop(k).clear()
    if others:
        gc.collect()
    return _kept.setdefault(owner, {})


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | StructType, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``mapInArrow`` with ``fn`` called once for each group of whole rows whose
    texts hold about ``group_bytes`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(fn.__module__)
        for batch in batches:
            for part in split_batch(batch, group_bytes):
                yield from fn(part)

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def split_batch(batch: pa.RecordBatch, group_bytes: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows so that each piece has about ``group_bytes``."""
    if batch.num_rows == 0:
        return
    size = np.full(batch.num_rows, 16, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + batch.num_rows + 1])
    piece = (np.cumsum(size) - size) // group_bytes
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (public splitmix64 constants)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class PrefixHash:
    """Hashes of any slices of a byte buffer from one pass over it.

    With S the running sum of byte * P**i (mod 2**64, P odd), the hash of
    [s, e) is (S[e] - S[s]) * P**-s, mixed: equal bytes give equal hashes
    wherever they stand.
    """

    P = 0x9E3779B97F4A7C15
    INV = pow(P, -1, 1 << 64)
    _pow = np.ones(1, U64)
    _inv = np.ones(1, U64)

    def __init__(self, buf: np.ndarray) -> None:
        self._grow(len(buf) + 1)
        self.sums = np.empty(len(buf) + 1, U64)
        self.sums[0] = 0
        np.cumsum((buf.astype(U64) + U64(1)) * PrefixHash._pow[: len(buf)], out=self.sums[1:])

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._pow) < n:
            for name, base in (("_pow", cls.P), ("_inv", cls.INV)):
                a = np.full(max(n, GROUP_BYTES), base, U64)
                a[0] = 1
                setattr(cls, name, np.multiply.accumulate(a))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * PrefixHash._inv[start])


def words_between(is_separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are no separators."""
    edge = np.diff(np.concatenate(([1], is_separator.astype(np.int8), [1])))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
