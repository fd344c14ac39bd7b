"""Helpers shared by the operators: batches of bytes, hashes of runs, stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordops.session import scratch_dir

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
OTHER_BASE = 0xD1342543DE82EF95


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Bounds of the batches that go to Python, in rows and in bytes. They are settings of the session, read when
#: a plan runs and not when it is built, so they stay set; a session that sets them itself keeps smaller ones.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def bounded(df: DataFrame) -> DataFrame:
    """Asks Spark for small batches to Python, since rows may hold long texts; a longer text is a batch of its own."""
    conf = df.sparkSession.conf
    for name, most in BATCH.items():
        value = conf.get(name, None)
        if value is None or not 0 < int(str(value).rstrip("b")) <= most:
            conf.set(name, str(most))
    return df


def settle(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again, so that lost executors cost no recomputation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_column: str, text_column: str) -> Column:
    """16 bytes for a row: rows of equal id and text share it, a missing id is a value of its own."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    name = F.coalesce(F.col(id_column).cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(name, F.lit("\n"), text)))


def slices(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes add up to about `most`; a longer row stands alone."""
    sizes = byte_lengths(column)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array and the offsets of its rows; null is empty."""
    sizes = byte_lengths(column)
    ends = np.cumsum(sizes)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    values = column.fill_null("" if pa.types.is_string(column.type) else b"")
    values = values.cast(pa.large_binary())
    buffers = values.buffers()
    first = np.frombuffer(buffers[1], np.int64)[values.offset]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[first : first + offsets[-1]], offsets


_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64; kept for the longest batch so far."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1 << 20), base, np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


class RunHash:
    """Hashes of any runs of a sequence: equal runs have equal values wherever they stand."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        self.back = powers(n + 1, pow(base, -1, 1 << 64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values + np.uint64(1)) * powers(n, base), out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def byte_classes(separators: list[tuple[int, int]]) -> np.ndarray:
    """True for the bytes of words, given the ranges of bytes that separate them."""
    word = np.ones(256, bool)
    for first, last in separators:
        word[first : last + 1] = False
    return word


#: Words of letters, digits and every byte beyond ASCII / words between blanks.
ALNUM = byte_classes([(0x00, 0x2F), (0x3A, 0x40), (0x41, 0x5A), (0x5B, 0x60), (0x7B, 0x7F)])
NOT_BLANK = byte_classes([(0x20, 0x20), (0x09, 0x0D)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray):
    """Starts and ends of the words of lower-cased bytes, and how many words precede each row."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = word[data]
    steps = np.diff(inside)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    joined = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]  # a word that a row's end cuts in two
    starts = np.flatnonzero(steps == 1)
    ends = np.flatnonzero(steps == -1)
    if len(joined):
        joined = np.unique(joined)
        starts = np.sort(np.concatenate([starts, joined]))
        ends = np.sort(np.concatenate([ends, joined]))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return RunHash(data.astype(np.uint64))(starts, ends)
