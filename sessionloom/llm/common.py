"""What several operators share: the folder for intermediate tables, and text as numpy arrays.

The vectorised text helpers look at the bytes of a whole Arrow column at once, so that no Python
code runs per word. They are called inside tasks, on slices of bounded size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Bytes of text that one numpy pass holds; a longer document is a slice of its own. A pass makes some ten arrays of eight bytes for each, which
#: the caches hold, and idle Python workers keep little of them.
SLICE_BYTES = 1 << 17
#: Bytes of rows that travel between Spark and Python at a time, unless the session says otherwise.
BATCH_BYTES = 1 << 22


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables, else one in the warehouse, which all executors share too."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def settle(df: DataFrame, label: str = "part") -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it again: lineage ends, columns still prune."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on whole texts go to Python and back in batches of `BATCH_BYTES`, if the session has set no size of its own. By default a batch is 64 MB,
    of which a task holds several in the JVM and in each of its Python workers."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def ascii_lower(col):
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- text as arrays


class Texts:
    """Some consecutive texts: `data` holds their bytes, text i is data[at[i]:at[i + 1]]; null is empty."""

    def __init__(self, data: np.ndarray, at: np.ndarray, first: int):
        self.data, self.at, self.first = data, at, first

    def __len__(self):
        return len(self.at) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.at[i] : self.at[i + 1]].tobytes()


def texts(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Slices of a string or binary column, each of at most `limit` bytes or one text; covers every row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + n + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield Texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lo)
        lo = hi


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64; kept for the next slice."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 16)
        for key, x in (("up", _BASE), ("down", _INVERSE)):
            full = np.full(size, x, np.uint64)
            full[0] = 1
            _powers[key] = np.multiply.accumulate(full)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of `symbols` follows in constant time."""
    n = len(symbols)
    _, down = _power(n)
    out = np.empty(n + 1, np.uint64)
    out[0] = 0
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * down[:n], out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of symbols[start:stop]; equal stretches have equal hashes wherever they stand."""
    up, _ = _power(len(sums))
    return mix((sums[stop] - sums[start]) * up[start] + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: Words as runs of bytes that are not separators: blanks of [\x20\x09-\x0D], or all ASCII but digits and letters.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 9, 10, 11, 12, 13]] = False
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(t: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, first): word j is data[start[j]:stop[j]]; text i has words first[i]..first[i + 1]."""
    m = inside[t.data]
    n = len(m)
    if n == 0:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(t) + 1, np.int64)
    begin, end = m.copy(), m.copy()
    begin[1:] &= ~m[:-1]
    end[:-1] &= ~m[1:]
    cut = t.at[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begin[cut] = m[cut]
    end[cut - 1] = m[cut - 1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return start, stop, np.searchsorted(start, t.at)


def owner(first: np.ndarray) -> np.ndarray:
    """For each item the text it belongs to, from the texts' first items."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def list_array(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: row i has values[first[i]:first[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32), pa.int32()), pa.array(values, kind))
