"""Words, shingles and hashes of a text, vectorised over one document at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame

# Words are cut at space, tab and the characters up to carriage return: what ``bytes.split()`` does.
WORD = r"[^\x20\x09-\x0D]+"
WORD_SQL = r"[^\\x20\\x09-\\x0D]+"

_BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

_SEED = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends rows to Python in batches of 4 MB at most.

    Batches go by row count otherwise, and texts can be long: a worker's memory then grows with them.
    """
    now = df.sparkSession.conf.get(_BATCH_KEY, None)
    if not now or not str(now).isdigit() or int(now) > BATCH_BYTES:
        df.sparkSession.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return df


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of ``text`` in UTF-8; ``lower`` maps A-Z only. Null has none."""
    if not text:
        return []
    raw = text.encode("utf-8", "replace")
    return (raw.lower() if lower else raw).split()


class WordHashes(dict):
    """64-bit hashes by word. The table is emptied when full, so its memory stays bounded."""

    def __init__(self, limit: int = 150_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value

    def of(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, parts), np.uint64, len(parts))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words; empty when there are fewer."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, (_SEED * size) % (1 << 64), np.uint64)
    for j in range(size):
        acc = (acc ^ h[j : j + n]) * _STEP
        acc ^= acc >> np.uint64(29)
    return mix(acc)


def shingle_set(h: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes. Fewer words than ``size`` make one shingle, no words none."""
    if not len(h):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(h, min(size, len(h))))


def blank_pieces(raw: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """``raw`` in pieces of about ``size`` bytes, cut at spaces; a longer run without one stays whole."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + size) if at + size < len(raw) else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end
