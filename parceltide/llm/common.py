"""Helpers the operators share: tables, materialised intermediates, Arrow passes and byte-level words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parceltide.session import release, removed, shared_dir  # noqa: F401

# Rows of one Arrow batch: long texts times this many rows have to fit beside the JVM.
ARROW_ROWS = 512

# Bytes of a word once A-Z are lower-cased: digits, a-z and everything outside ASCII.
_KEEP = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
LOWER_WORDS = _KEEP.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back: the lineage ends there, so a
    lost executor costs no more than the step under way."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_position(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with its columns named ``_own_0``, ``_own_1`` and so on, and the ``needed`` ones next to them, so that no
    name of the input can meet one of an operator's own, whatever its case."""
    names = [c.lower() for c in docs.columns]
    wide = docs.toDF(*(f"_own_{i}" for i in range(len(names))))
    return wide.select("*", *[F.col(f"_own_{docs.columns.index(c) if c in docs.columns else names.index(c)}").alias(c)
                              for c in needed])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def per_batch(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              schema: str) -> DataFrame:
    """``mapInArrow`` with one output batch per input batch and batches of bounded rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = make(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 16


def _powers(base: int, n: int = _CHUNK) -> np.ndarray:
    out = np.empty(n + 1, dtype=np.uint64)
    out[0], out[1:] = 1, base
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_POWERS, _INVERSES = _powers(_BASE), _powers(_INVERSE)


def word_hashes(data: bytes, is_word: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word of ``data``, in order. ``is_word`` says which byte values belong
    to words. The text is taken in pieces cut between words, so memory does not follow its length."""
    parts, start, n = [], 0, len(data)
    raw = np.frombuffer(data, dtype=np.uint8)
    while start < n:
        end = min(n, start + _CHUNK)
        if end < n:
            gaps = np.flatnonzero(~is_word[raw[start:end]])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
            else:  # one word longer than a piece: take it whole
                rest = np.flatnonzero(~is_word[raw[end:]])
                end = end + int(rest[0]) if len(rest) else n
        parts.append(_piece(raw[start:end], is_word))
        start = end
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def _piece(raw: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = is_word[raw]
    edges = np.diff(inside)
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(first):
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        up, down = _POWERS, _INVERSES
        if len(raw) > _CHUNK:
            up, down = _powers(_BASE, len(raw)), _powers(_INVERSE, len(raw))
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[raw] * up[:len(raw)], out=sums[1:], dtype=np.uint64)
        value = (sums[last] - sums[first]) * down[first]
        return mix64(value ^ (last - first).astype(np.uint64))


def byte_mask(separators: bytes) -> np.ndarray:
    mask = np.ones(256, dtype=bool)
    mask[list(separators)] = False
    return mask
