"""Helpers shared by the operators: tables in the shared folder, Arrow rows, unique row names."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight.session import scratch_dir


def stored(frame: DataFrame, label: str, *by: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, so that a lost executor costs no recomputation.

    Later reads see the same rows however often tasks are repeated, which also makes values that depend on the
    order of a scan (row names, partition numbers) safe to use after this point.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    writer = frame.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


class RowNames:
    """Names for rows that are unique over all tasks of a job: partition number and a counter."""

    def __init__(self) -> None:
        context = TaskContext.get()
        self.next = (context.partitionId() if context else 0) << 36

    def take(self, n: int = 1) -> int:
        first = self.next
        self.next += n
        return first


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def raw_texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as the bytes that Arrow has, without decoding them."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


class Emitter:
    """Collects rows and hands them on in Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 20_000, size: int = 16 << 20) -> None:
        self.schema, self.max_rows, self.max_size = schema, rows, size
        self._clear()

    def _clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.size = 0

    def add(self, row: tuple, size: int = 0) -> None:
        for column, value in zip(self.columns, row):
            column.append(value)
        self.size += size

    def ready(self) -> Iterator[pa.RecordBatch]:
        if len(self.columns[0]) >= self.max_rows or self.size >= self.max_size:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self._clear()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, which need not see the driver's folders; hand them small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = pathlib.Path(__file__).parents[1]
    target = pathlib.Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


class KeyFilter:
    """A Bloom filter over 64-bit keys: a bit set of fixed size, whatever the number of keys.

    It passes every key that was put in and a few others, so it may only be used to thin out rows before an exact
    join. With very many keys it passes more, never less.
    """

    HASHES = 4
    BLOCK = 1 << 16

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @staticmethod
    def places(keys: np.ndarray, n_bits: int) -> np.ndarray:
        mixed = mix(keys.astype(np.int64).view(np.uint64))
        step = mix(mixed) | np.uint64(1)
        turns = np.arange(KeyFilter.HASHES, dtype=np.uint64)[:, None]
        with np.errstate(over="ignore"):
            return (mixed + turns * step) & np.uint64(n_bits - 1)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = self.places(keys, 8 * len(self.bits))
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(0)

    @classmethod
    def of(cls, keys: DataFrame, megabytes: int = 8) -> KeyFilter:
        """From the first column of ``keys`` (long). Tasks send their set blocks, which are united per block."""
        n_bytes = megabytes << 20

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(n_bytes, np.uint8)
            for batch in batches:
                found = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
                at = cls.places(found, 8 * n_bytes).ravel()
                np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            for i in range(0, n_bytes, cls.BLOCK):
                if bits[i:i + cls.BLOCK].any():
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([i], pa.int32()),
                        "bits": pa.array([zlib.compress(bits[i:i + cls.BLOCK].tobytes(), 1)], pa.binary())})

        def unite(frame: pd.DataFrame) -> pd.DataFrame:
            bits = np.zeros(cls.BLOCK, np.uint8)
            for packed in frame["bits"]:
                bits |= np.frombuffer(zlib.decompress(packed), np.uint8)
            return pd.DataFrame({"block": frame["block"][:1], "bits": [bits.tobytes()]})

        shape = "block int, bits binary"
        rows = keys.mapInArrow(fill, shape).groupBy("block").applyInPandas(unite, shape).collect()
        bits = np.zeros(n_bytes, np.uint8)
        for row in rows:  # together one bit set
            bits[row["block"]:row["block"] + cls.BLOCK] = np.frombuffer(row["bits"], np.uint8)
        return cls(bits)

    def column(self, spark: SparkSession):
        """A function of a long column: whether the key may be in the set."""
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("boolean")
        def may_hold(keys: pd.Series) -> pd.Series:
            return pd.Series(shared.value.holds(keys.to_numpy(np.int64)))

        return may_hold


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finishing steps of a common generator)."""
    with np.errstate(over="ignore"):
        z = values + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return z ^ z >> np.uint64(31)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers, compressed byte by byte of their width."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()
    return len(numbers).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], n * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order that puts entries of a bucket together, and each bucket with its begin and end."""
    order = np.argsort(bucket, kind="stable")
    dealt = bucket[order]
    begin = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1])) if len(dealt) else np.zeros(0, np.int64)
    end = np.append(begin[1:], len(dealt))
    return order, list(zip(dealt[begin].tolist(), begin.tolist(), end.tolist()))


def splits(frame: DataFrame, column: str, rows: int) -> list[int]:
    """Values of a long column that cut it into ranges of about ``rows`` rows: one number per range."""
    n = frame.where(F.col(column).isNotNull()).count()
    ranges = max(1, n // rows)
    if ranges == 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = frame.agg(F.percentile_approx(column, shares, min(max(10_000, 10 * ranges), 1_000_000))).first()[0]
    return sorted(set(found))


def range_of(column: str, cuts: list[int]) -> Column:
    """The number of the range that a value falls in: how many cuts are below it. Nulls are in the first one."""
    if not cuts:
        return F.lit(0)
    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda x: x < F.col(column)))

    def longs(values: list[int]) -> Column:
        return F.lit(values).cast("array<bigint>")

    width = max(8, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    if len(groups) == 1:
        return below(longs(cuts))
    # Two steps, each over about the square root of the number of cuts: the group by its last cut, then within it.
    group = below(longs([g[-1] for g in groups]))
    inside = F.lit([*groups, []]).cast("array<array<bigint>>")
    return F.least(group * width + below(F.element_at(inside, group + 1)), F.lit(len(cuts)))
