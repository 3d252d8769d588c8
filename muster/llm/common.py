"""What the operators share: reading tables, staged tables, words and shingles of whole texts."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.sinks.place import run_folder

#: Characters that part words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stage:
    """Tables written to the cluster's shared folder, so that a lost executor costs no earlier step."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = run_folder(spark)
        self._count = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self._count += 1
        path = f"{self.folder}/{self._count}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


#: Rows whose texts a task holds as Python objects at once.
SLICE = 1000


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Arrow batches, cut small: a text takes several times its room once it is worked on."""
    for batch in batches:
        for low in range(0, batch.num_rows, size):
            yield batch.slice(low, size)


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``function`` on the rows, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield function(batch)

    return df.mapInArrow(run, schema)


def ascii_lower(column):
    """A-Z to a-z, nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[bytes]:
    """Words of a whole text, A-Z lower-cased. Splitting bytes parts at exactly the six characters of ``WORD``."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


@functools.cache
def _factors(size: int) -> list[np.uint64]:
    rng = np.random.default_rng(20240229)
    return [np.uint64(int(f) | 1) for f in rng.integers(1, 1 << 63, size, dtype=np.uint64)]


def shingle_hashes(text_words: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit hashes of the successive shingles; fewer words than ``size`` make one shingle, no word none."""
    n = len(text_words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(text_words), seed=n)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, text_words), np.uint64, n)
    total = np.zeros(n - size + 1, np.uint64)
    for i, factor in enumerate(_factors(size)):
        total += hashes[i : n - size + 1 + i] * factor
    return _mix(total)


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingle_hashes(words(text), size))


def binary(rows: np.ndarray) -> pa.Array:
    """A matrix as an Arrow array with the bytes of each row."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    fixed = pa.Array.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows.tobytes())])
    return fixed.cast(pa.binary())


def matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """The inverse of ``binary``."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)
