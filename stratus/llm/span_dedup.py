"""Substring deduplication by sliding sentence spans.

A sentence ends at a full stop or another mark of a pause (also a comma, colon or
semicolon) before white space, or at a line's end, so that a passage that begins
and ends inside a sentence still holds whole ones. From every sentence on, the
shortest run of ``run`` or more consecutive sentences with ``min_words`` words
(or of fewer, with ``long_words``) is hashed, and up to every sentence the
shortest such run that ends there; so each whole sentence of a repeated passage
of that size lies in a hashed run of it. A span that occurs in several documents
stays in the one with the smallest doc_id; a span that occurs again in a document
stays at its first place there. Sentences that any other occurrence covers are
cut out; the rest of the text is left as it is.

A document sends each of its distinct spans once. First owners are found by a
pre-aggregated minimum per hash and joined back, so a passage that a third of
all documents share meets in no single task; the list of spans to cut is as
long as the document at most.

Defined results: a null text stays null, texts without repeated spans are
returned unchanged, a text may become empty. Rows that share a doc_id count as
one document; a row without doc_id comes after all others, in the order of its
text's hash. Other columns are returned unchanged; the added column is
``n_removed``, with underscores after it where that name is taken.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, to_bytes


@dataclass(frozen=True)
class Settings:
    run: int = 3
    min_words: int = 15
    long_words: int = 15


# Begins with one set of characters, so that the search skips all others quickly.
_END = re.compile(r"""[.!?,;:。！？，；：、\n](?:(?<=[.!?,;:])[.!?,;:]*["'”’)\]]*(?=\s)|(?<=[。！？，；：、])[。！？，；：、]*|(?<=\n))\s*""")


def sentences(text: str) -> list[tuple[int, int]]:
    """Ranges of code points, one per sentence with a word, that together cover the text."""
    out, start = [], 0
    for m in _END.finditer(text):
        end = m.end()
        if text[start:end].strip():
            out.append((start, end))
        elif out:
            out[-1] = (out[-1][0], end)
        else:
            continue
        start = end
    if text[start:].strip():
        out.append((start, len(text)))
    elif out:
        out[-1] = (out[-1][0], len(text))
    return out


def runs(words: list[int], s: Settings) -> list[tuple[int, int]]:
    """The runs of sentences (from, to) that are hashed; ``words``: words per sentence."""
    total = [0, *accumulate(words)]
    n, run, least, long = len(words), s.run, s.min_words, s.long_words
    found, j = set(), 0
    for i in range(n):
        j, before = max(j, i + 1), total[i]
        while j <= n and (size := total[j] - before) < long and (j - i < run or size < least):
            j += 1
        if j > n:
            break
        found.add((i, j))
    i = n - 1
    for j in range(n, 0, -1):
        i, upto = min(i, j - 1), total[j]
        while i >= 0 and (size := upto - total[i]) < long and (j - i < run or size < least):
            i -= 1
        if i < 0:
            break
        found.add((i, j))
    return sorted(found)


def spans(text: str | None, s: Settings) -> tuple[list[tuple[int, int]], list[tuple[int, int]], list[bytes]]:
    """Sentence ranges, hashed runs and the runs' 16-byte hashes."""
    if not text:
        return [], [], []
    ranges = sentences(text)
    split = [text[a:b].split() for a, b in ranges]
    found = runs([len(x) for x in split], s)
    if not found:
        return ranges, [], []
    digest = xxhash.xxh3_128_digest
    own = [digest(to_bytes(" ".join(x))) for x in split]
    return ranges, found, [digest(b"".join(own[i:j])) for i, j in found]


_SPANS = pa.schema([("key", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("again", pa.bool_())])


def _document_key(docs: DataFrame) -> Column:
    """doc_id, or for a row without one a number above 2**62 from its text."""
    high = F.xxhash64(docs["text"]).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    return F.coalesce(docs["doc_id"].cast("long"), high)


def document_spans(keyed: DataFrame, s: Settings) -> DataFrame:
    """``key, h1, h2, again`` per distinct span of a row; again: it occurs there more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hashes, again, held = [], [], [], 0

        def flush():
            both = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.array([k for k, _ in keys], np.int64), [n for _, n in keys])),
                pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(again, pa.bool_())], schema=_SPANS)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen = Counter(spans(text.as_py(), s)[2])
                if not seen:
                    continue
                keys.append((key, len(seen)))
                hashes.extend(seen)
                again.extend(n > 1 for n in seen.values())
                held += len(seen)
                if held >= 50_000:
                    yield flush()
                    keys, hashes, again, held = [], [], [], 0
        if held:
            yield flush()

    return keyed.select("key", "text").mapInArrow(run, "key long, h1 long, h2 long, again boolean")


def cut_spans(text: str, foreign: set[int], repeated: set[int], s: Settings) -> tuple[str, int]:
    """``text`` without the sentences that the given spans cover (repeated ones: from their second place on)."""
    ranges, found, hashes = spans(text, s)
    heads = np.frombuffer(b"".join(hashes), np.int64)[::2].tolist() if hashes else []
    gone, seen = set(), set()
    for (i, j), h in zip(found, heads, strict=True):
        if h in foreign or (h in repeated and h in seen):
            gone.update(range(i, j))
        seen.add(h)
    return "".join(text[a:b] for k, (a, b) in enumerate(ranges) if k not in gone) if gone else text, len(gone)


def drop_repeated_spans(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with cut texts, and ``n_removed``: the number of sentences cut out of each row."""
    s, counted = settings, free_name(docs, "n_removed")
    keyed = docs.select(_document_key(docs).alias("key"), docs["text"].cast("string").alias("text"))
    found = document_spans(keyed, s)
    owners = found.groupBy("h1", "h2").agg(F.min("key").alias("owner"))
    cuts = found.join(owners, ["h1", "h2"]).select("key", "h1", (F.col("key") != F.col("owner")).alias("foreign"), "again")
    lists = cuts.where("foreign or again").groupBy("key").agg(
        F.collect_set(F.when(F.col("foreign"), F.col("h1"))).alias("foreign"),
        F.collect_set(F.when(~F.col("foreign"), F.col("h1"))).alias("repeated"))

    @F.pandas_udf("text string, n int")
    def clean(texts: pd.Series, foreign: pd.Series, repeated: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([
            (None, 0) if t is None else cut_spans(t, set(f.tolist()), set(r.tolist()), s)
            for t, f, r in zip(texts, foreign, repeated, strict=True)], columns=["text", "n"])

    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row_"), _document_key(docs).alias("key_"))
    joined = packed.join(lists, F.col("key_") == F.col("key"), "left")
    touched = F.col("key").isNotNull()
    cleaned = joined.withColumn("new_", clean(
        F.when(touched, F.col("row_.text").cast("string")), F.coalesce("foreign", F.array().cast("array<bigint>")),
        F.coalesce("repeated", F.array().cast("array<bigint>"))))
    text = F.when(touched, F.col("new_.text")).otherwise(F.col("row_.text"))
    return cleaned.select(*(text.alias(c) if c == "text" else F.col("row_").getField(c).alias(c) for c in docs.columns),
                          F.coalesce("new_.n", F.lit(0)).alias(counted))
