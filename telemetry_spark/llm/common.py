"""What several operators share: written intermediate tables, hashed words and stable fractions of keys."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.plans.session import fresh_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run of characters outside this class is a word: ASCII digits and lower-case letters, and all beyond ASCII.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder under the shared one and read back: later steps re-read it instead of doing it again,
    also when the executor that did it is gone."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, broadcast_rows: int) -> DataFrame:
    """Mark a table for broadcasting if it has at most so many rows."""
    return F.broadcast(df) if df.limit(broadcast_rows + 1).count() <= broadcast_rows else df


def ascii_words(text: Column) -> Column:
    """Words of a text in order, A-Z lower-cased, nothing else folded. A null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NO_WORD), "")


def crc_mod(key: Column, m: int) -> Column:
    """crc32 of a key's decimal text, modulo m."""
    return F.crc32(key.cast("string").cast("binary")) % m


def share(key: Column, fraction: float, seed: int) -> Column:
    """Whether a key falls into a stable pseudo-random share of all keys."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < F.lit(int(min(1.0, fraction) * (1 << 30)))


class WordHashes(dict):
    """64-bit hashes of byte words. It forgets all words once it holds ``limit`` of them, which bounds a worker's memory."""

    def __init__(self, seed: int = 0, limit: int = 300_000):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def text_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column's values; of a null, none."""
    return [b"" if x is None else x for x in column.cast("binary").to_pylist()]
