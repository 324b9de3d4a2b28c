"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from premia import workspace
from premia.workspace import discard  # noqa: F401

#: Rows handed to Python at once; long rows are cut into smaller slices by ``slices``.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Shuffle files of a finished job are deleted at once instead of whenever the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxBytesPerOutputBatch")


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    conf = spark.conf
    before = {k: conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def small_batches(spark: SparkSession, most: int = 4 << 20) -> AbstractContextManager[None]:
    """Within it, jobs exchange batches of at most ``most`` bytes, or one row, with Python."""
    return _settings(spark, dict.fromkeys(_BATCH_BYTES, str(most)))


def stored(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write once to the shared folder and read back; the job's shuffle files, which nothing reads again, go at once.

    ``batch_rows`` is the most rows that Python gets at once, for rows that hold whole blocks.
    """
    wanted = {_CLEANUP: "true"} | ({_BATCH: str(batch_rows)} if batch_rows else {})
    with _settings(df.sparkSession, wanted):
        return workspace.stored(df, label)


def text_of(column: str) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``most`` bytes of ``column``, and always at least one row."""
    array = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size) + 64
    if start < batch.num_rows:
        yield batch.slice(start)


def byte_rows(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string column without nulls, and the offsets of its rows (one more than rows)."""
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    data = array.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


#: An odd factor and its inverse modulo 2**64, for polynomial hashes of byte runs.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
#: Powers that a worker keeps; those that only a longer text needs are made anew for it.
_MOST_POWERS = 1 << 22


def powers(factor: int, n: int) -> np.ndarray:
    """``factor ** i`` modulo 2**64 for i below ``n``; up to ``_MOST_POWERS`` are kept for the next call."""
    have = _powers.get(factor)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), factor, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        _powers[factor] = have[:_MOST_POWERS].copy() if n > _MOST_POWERS else have
    return have[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def run_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, factor: int = _FACTOR) -> np.ndarray:
    """A 64-bit hash of each byte run ``data[start:stop]`` that depends on its bytes alone."""
    n = len(data)
    inverse = _INVERSE if factor == _FACTOR else pow(factor, -1, 1 << 64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(factor, n), out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * powers(inverse, n + 1)[starts])


def word_runs(texts: pa.Array, fold: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts: the folded bytes, where each word starts and stops, and the row it belongs to.

    ``fold`` maps bytes to bytes; words are the runs without a space (byte 32) in what it gives.
    """
    data, offsets = byte_rows(texts)
    folded = np.frombuffer(data.tobytes().translate(fold), np.uint8)
    inner = folded != 32
    # A row border ends a word: where a row starts inside of a run, a new word starts.
    edge = np.zeros(len(folded) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(folded), bool)
    before[1:] = inner[:-1]
    after = np.zeros(len(folded), bool)
    after[:-1] = inner[1:]
    starts = np.flatnonzero(inner & (~before | edge[:-1]))
    stops = np.flatnonzero(inner & (~after | edge[1:])) + 1
    return folded, starts, stops, np.searchsorted(offsets, starts, side="right") - 1
