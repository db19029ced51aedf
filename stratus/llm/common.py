"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: What separates words: space, tab, \n, \v, \f, \r (the bytes at which bytes.split() splits).
SPACE = r"[\x20\x09-\x0D]"
SLICE_BYTES = 1 << 20  # long texts are cut into words slice by slice

_space = re.compile(rb"[\x20\x09-\x0D]")
_word_hash = xxhash.xxh3_64_intdigest
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_R = np.uint64(32)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the session's shared checkpoint folder: lineage cut, true size known."""
    path = scratch_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as make it differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(value: Column) -> Column:
    """``value`` itself, as an expression that the optimizer does not copy.

    A filter on a column that is built up over several projections would be
    pushed below them with all the nested array expressions written out, once
    per reference. A projection that numbers its rows is left in its place.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def to_bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def text_slices(text: str, lower: bool = True) -> Iterator[bytes]:
    """``text`` (A-Z lower-cased, or as it stands) in pieces of a bounded number of bytes, cut between words."""
    data = to_bytes(text).lower() if lower else to_bytes(text)
    start, size = 0, len(data)
    while start < size:
        end = start + SLICE_BYTES
        gap = _space.search(data, end) if end < size else None
        end = gap.start() if gap else size
        yield data[start:end]
        start = end


def word_slices(text: str, lower: bool = True) -> Iterator[list[bytes]]:
    """Words of ``text``, a bounded number of bytes at a time."""
    return (piece.split() for piece in text_slices(text, lower))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of the whole text, in order."""
    if not text:
        return np.empty(0, np.uint64)
    parts = [np.array([_word_hash(w) for w in words], np.uint64) for words in word_slices(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over a 64-bit hash."""
    h = (h ^ (h >> _R)) * _M1
    h = (h ^ (h >> _R)) * _M2
    return h ^ (h >> _R)


def record_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
