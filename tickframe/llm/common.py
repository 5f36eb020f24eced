"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.session import file_system, fresh_dir, ship_package

# Code points that separate words: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Once a table is written, the shuffle files that made it are of no more use.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts lineage, survives lost executors.

    ``path``: the new folder to use, for a caller that gives it back with ``discard``."""
    spark = df.sparkSession
    path = path or fresh_dir(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored pass that nothing reads any more: all that was made of it must be stored itself."""
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def ready(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers."""
    ship_package(spark)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that clash with none of the input's columns (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null ids count as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def slices(sizes: np.ndarray, most: int):
    """Consecutive (start, end) row ranges of at most ``most`` bytes; a larger row stands alone."""
    i, n = 0, len(sizes)
    ends = np.cumsum(sizes, dtype=np.int64)
    while i < n:
        base = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + most, "right")))
        yield i, j
        i = j


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array laid end to end, and the n + 1 offsets; nulls count as empty."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = a.fill_null("").cast(pa.large_string())
    off = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1, a.offset * 8) if len(a) else np.zeros(1, np.int64)
    data = a.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[off[0]:off[-1]], off - off[0]


def text_slices(batch, column: str = "text", most: int = 2_000_000):
    """Parts of an Arrow batch with at most ``most`` text bytes each: (rows, bytes, offsets)."""
    flat, off = text_bytes(batch.column(column))
    for i, j in slices(np.diff(off), most):
        yield batch.slice(i, j - i), flat[off[i]:off[j]], off[i:j + 1] - off[i]


# --- hashing -------------------------------------------------------------------
def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


# Arithmetic modulo the prime 2^61 - 1. A polynomial in a field has at most as many zeros as its degree; modulo 2^64 whole families
# of different texts (Thue-Morse words and their complements) would share one value whatever the base.
PRIME = np.uint64((1 << 61) - 1)
_BASE = 0x1B873593CC9E2D51 % ((1 << 61) - 1)
_INVERSE = pow(_BASE, -1, (1 << 61) - 1)
_LOW32, _LOW29 = np.uint64(0xFFFFFFFF), np.uint64((1 << 29) - 1)
_POWERS: dict = {}
# Values worked off at a time, so that temporaries stay in the cache.
_CHUNK = 1 << 15


def _fold(x: np.ndarray) -> np.ndarray:
    """Values below 2^64 modulo the prime."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, of values below it."""
    ah, al, bh, bl = a >> np.uint64(32), a & _LOW32, b >> np.uint64(32), b & _LOW32
    low, mid = al * bl, ah * bl + al * bh
    return _fold((low & PRIME) + (low >> np.uint64(61)) + ((ah * bh) << np.uint64(3)) + (mid >> np.uint64(29)) + ((mid & _LOW29) << np.uint64(32)))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.ones(1, np.uint64)
        while len(have) < size:
            have = np.concatenate([have, times(have, np.uint64(pow(base, len(have), int(PRIME))))])
        if size <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


class SpanHash:
    """64-bit fingerprints of any spans of one array (bytes or 64-bit values), from prefix sums of a polynomial modulo the prime."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        powers = _powers(_BASE, n)
        upto = 0
        for at in range(0, n, _CHUNK):
            part, p = data[at:at + _CHUNK], powers[at:at + _CHUNK]
            if part.dtype == np.uint8:
                small = part.astype(np.uint64) + np.uint64(1)
                high = small * (p >> np.uint64(32))
                terms = small * (p & _LOW32) + (high >> np.uint64(29)) + ((high & _LOW29) << np.uint64(32))  # below 2^62
            else:
                terms = times(_fold(part), p)
            high = np.cumsum(terms >> np.uint64(32))
            upto_here = _fold(np.cumsum(terms & _LOW32) + (high >> np.uint64(29)) + ((high & _LOW29) << np.uint64(32)))
            upto_here = _fold(upto_here + np.uint64(upto))
            self.sums[at + 1:at + 1 + len(part)] = upto_here
            upto = int(upto_here[-1])
        self.back = _powers(_INVERSE, n + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), np.uint64)
        for at in range(0, len(start), _CHUNK):
            s, e = start[at:at + _CHUNK], end[at:at + _CHUNK]
            h = times(_fold(self.sums[e] + (PRIME - self.sums[s])), self.back[s])
            out[at:at + _CHUNK] = mix(h + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        return out
