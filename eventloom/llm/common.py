"""Pieces shared by the training-data operators: table access, lineage cuts, Arrow plumbing and word hashing."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Where checkpoints go in a local session that names no folder, as in tests.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"
ROWS_AT_ONCE = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the shared checkpoint folder and drops its lineage.

    The folder is the session's ``spark.checkpoint.dir``; where that is unset a local session takes a local one, and a
    cluster, whose executors couldn't see it, is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or LOCAL_CHECKPOINTS)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Has the driver look for what is no longer in use: the shuffle files of finished steps go only then."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def give_back() -> None:
    """Hands memory that is free back to the system: a worker lives on after a task, and would keep the most it ever took."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


#: Functions that drop what an operator remembers in a worker from task to task. They are called when other work comes to the worker.
leftovers: list[Callable[[], None]] = []


def forget_leftovers() -> None:
    for forget in leftovers:
        forget()


def by_batch(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Applies kernel to each partition, ROWS_AT_ONCE rows at a time: a worker holds what the kernel makes of so many rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_leftovers()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                out = kernel(batch.slice(at, ROWS_AT_ONCE))
                if out is not None:
                    yield out
        batch = out = None
        give_back()

    return df.mapInArrow(run, schema)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


#: Odd multiplier of the rolling polynomials (2**64 divided by the golden ratio) and its inverse modulo 2**64.
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
_powers = {MULTIPLIER: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls (grown by doubling)."""
    known = _powers[base]
    while len(known) < n:
        step = np.uint64(pow(base, len(known), 1 << 64))
        known = np.concatenate([known, known * step])
    _powers[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Prefix polynomial of 64-bit symbols: entry i covers symbols[:i]."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(MULTIPLIER, len(symbols)), out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent hash of symbols[start:end], from prefix_sums."""
    return mixed((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start])


def rolling(symbols: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of width symbols; empty if there are fewer."""
    n = len(symbols) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(symbols)
    return mixed((sums[width:] - sums[:n]) * powers(INVERSE, n))
