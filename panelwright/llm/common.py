"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import math
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word as every contract of this package defines it: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this checkout import the package when it is not installed."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{ROOT}".strip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions_for(spark: SparkSession, total: int, each: int) -> int:
    """Partitions that hold about ``each`` of ``total``; never fewer than the cores at hand."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(total / each))


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (splitmix64's finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word; each distinct word is hashed once."""
    import xxhash

    known: dict[bytes, int] = {}
    digest = xxhash.xxh3_64_intdigest
    out = []
    for word in words:
        value = known.get(word)
        if value is None:
            value = known[word] = digest(word)
        out.append(value)
    return np.array(out, dtype=np.uint64)


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring values; empty when there are fewer."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix64(out + values[k : k + n] + np.uint64(0x9E3779B97F4A7C15))
    return out


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)
