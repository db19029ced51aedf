"""BPE encoding and decoding; long texts by tree concatenation.

Texts of up to ``leaf`` code points are encoded whole, in batches. A longer
text is cut into leaves, wherever the cuts fall, and the leaves are encoded by
themselves. Neighbours are then joined in a binary tree: a window around the cut
is encoded again, and grows until its tokens agree with both sides' (same ids
over the same code points). From the left side's tokens up to the agreement, the
window's between the two agreements and the right side's after them, every two
neighbouring tokens stand side by side in some encoding of the same stretch of
text, so the whole is the encoding of the joined text. A window that reaches both
ends is that encoding by itself.

Stretches of up to ``spread`` code points are joined in the task that reads them.
Longer texts are cut into such stretches, which are encoded in parallel as rows of
their own, one per distinct text, and then joined; rows with the same text take
its result by a join.

The tokenizer file comes with ``public_tokenizers`` (``path`` of its name is
looked up on the worker) or is an absolute path; nothing is trained or copied.

Defined results: a null text counts as an empty one (no ids, empty decoded
text). Every row gives a row, also where texts or whole rows repeat. Other
columns are carried along if asked for.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import record_batches, to_bytes


@dataclass(frozen=True)
class Settings:
    tokenizer: str = "word_bpe_49k.json"
    leaf: int = 1 << 15     # code points encoded in one go
    spread: int = 1 << 16   # code points joined in one task; longer texts are dealt out
    words: bool = True      # white space separates and is dropped, so that words are encoded each by itself
    memo: int = 1_000_000   # encoded words (some 200 bytes each) a worker process remembers; forgotten together when full
    window: int = 64        # first window on each side of a cut
    agree: int = 4          # tokens in a row that must agree
    batch: int = 128        # texts given to the library at a time


_loaded: dict = {}


def tokenizer(name: str):
    """The tokenizer of this worker process, loaded once."""
    if name not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        if os.path.isabs(name):
            path = name
        else:
            import public_tokenizers
            path = public_tokenizers.path(name)
        found = Tokenizer.from_file(str(path))
        found.no_truncation()
        found.no_padding()
        _loaded[name] = found
    return _loaded[name]


class WordCoder:
    """Texts to ids, little-endian 32-bit, by the library; words seen before are taken from memory."""

    def __init__(self, s: Settings):
        self.tok, self.s = tokenizer(s.tokenizer), s
        self.seen = _seen.setdefault(s.tokenizer, {})  # of this worker process
        self.mark = np.array(self.tok.encode(_MARK, add_special_tokens=False).ids, "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.s.words:
            return [_packed(x.ids) for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        split = [_space.split(t) for t in texts]
        if len(self.seen) > self.s.memo:
            self.seen.clear()
        new = list(set().union(*split).difference(self.seen))
        for i in range(0, len(new), 1000):
            part = new[i:i + 1000]
            self.seen.update(zip(part, self._encode_words(part), strict=True))
        find = self.seen.__getitem__
        return [b"".join(map(find, words)) for words in split]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """All words in one call, a mark between them; one by one if the marks cannot be told apart."""
        n = len(self.mark)
        if n and not any(_MARK in w for w in words):
            line = f" {_MARK} ".join(words)
            ids = np.array(self.tok.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            hit = np.ones(max(0, len(ids) - n + 1), bool)
            for j, x in enumerate(self.mark):
                hit &= ids[j:len(hit) + j] == x
            at = np.flatnonzero(hit)
            if len(at) == len(words) - 1:
                raw = ids.tobytes()
                starts, ends = [0, *(4 * (at + n)).tolist()], [*(4 * at).tolist(), len(raw)]
                return [raw[a:b] for a, b in zip(starts, ends, strict=True)]
        return [_packed(x.ids) for x in self.tok.encode_batch_fast(words, add_special_tokens=False)]


_MARK = "\u00b6"
_seen: dict[str, dict[str, bytes]] = {}
_space = re.compile("[ \\t\\n\\r]+")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@dataclass
class Piece:
    """An encoded stretch of a text: token ids and the code points they cover."""
    low: int
    high: int
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def encode_piece(tok, text: str, low: int, high: int) -> Piece:
    got = tok.encode(text[low:high], add_special_tokens=False)
    spans = np.array(got.offsets, np.int64).reshape(-1, 2) + low
    return Piece(low, high, np.array(got.ids, np.int64), spans[:, 0], spans[:, 1])


def _alone(p: Piece) -> np.ndarray:
    """Tokens that share no code point with a neighbour (their range says which token they are)."""
    out = np.ones(len(p.ids), bool)
    out[1:] &= p.starts[1:] >= p.ends[:-1]
    out[:-1] &= p.ends[:-1] <= p.starts[1:]
    return out


def _agreement(window: Piece, side: Piece, allowed: np.ndarray, agree: int, last: bool) -> tuple[int, int] | None:
    """Positions (in window, in side) where ``agree`` tokens in a row are equal; the first or the last such run."""
    if len(window.ids) < agree or len(side.ids) < agree:
        return None
    at = np.searchsorted(side.starts, window.starts)
    at = np.minimum(at, len(side.ids) - 1)
    same = (allowed & _alone(window) & _alone(side)[at] & (side.starts[at] == window.starts)
            & (side.ends[at] == window.ends) & (side.ids[at] == window.ids))
    follows = np.ones(len(same), bool)
    follows[1:] = at[1:] == at[:-1] + 1
    found = None
    length = 0
    for i in range(len(same)):
        length = length + 1 if same[i] and (length == 0 or follows[i]) else int(same[i])
        if length >= agree:
            found = (i - agree + 1, int(at[i - agree + 1]))
            if not last:
                return found
    return found


def join_pieces(tok, text: str, left: Piece, right: Piece, s: Settings) -> Piece:
    """The encoding of the two neighbouring stretches as one."""
    cut, size = left.high, s.window
    while True:
        low, high = max(left.low, cut - size), min(right.high, cut + size)
        window = encode_piece(tok, text, low, high)
        whole_left, whole_right = low == left.low, high == right.high
        a = (0, 0) if whole_left else _agreement(window, left, window.ends <= cut, s.agree, last=True)
        b = (len(window.ids), len(right.ids)) if whole_right else _agreement(
            window, right, window.starts >= cut, s.agree, last=False)
        if a is not None and b is not None and a[0] <= b[0]:
            head, tail = (0 if whole_left else a[1]), (len(right.ids) if whole_right else b[1])
            parts = [(left, 0, head), (window, a[0], b[0]), (right, tail, len(right.ids))]
            return Piece(left.low, right.high, *(
                np.concatenate([getattr(p, name)[i:j] for p, i, j in parts]) for name in ("ids", "starts", "ends")))
        size *= 2


def join_tree(tok, text: str, pieces: list[Piece], s: Settings) -> Piece:
    while len(pieces) > 1:
        pieces = [join_pieces(tok, text, *pieces[i:i + 2], s) if i + 1 < len(pieces) else pieces[i]
                  for i in range(0, len(pieces), 2)]
    return pieces[0]


def encode_stretch(tok, text: str, s: Settings) -> Piece:
    """A text of more than no code points, leaf by leaf."""
    cuts = [*range(0, len(text), s.leaf), len(text)]
    return join_tree(tok, text, [encode_piece(tok, text, a, b) for a, b in zip(cuts, cuts[1:], strict=False)], s)


def encode_texts(coder: WordCoder, texts: list[str], s: Settings) -> list[bytes]:
    """Ids of texts: the short ones together, the others by the tree."""
    short = iter(coder.encode([t for t in texts if len(t) <= s.leaf]))
    return [next(short) if len(t) <= s.leaf else encode_stretch(coder.tok, t, s).ids.astype("<u4").tobytes() for t in texts]


def _digests(tok, packed: list[bytes]) -> Iterator[tuple[np.ndarray, str, str]]:
    ids = [np.frombuffer(x, "<u4") for x in packed]
    texts = tok.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
    for own, raw, text in zip(ids, packed, texts, strict=True):
        yield own.astype(np.int32), hashlib.sha256(raw).hexdigest(), hashlib.sha256(to_bytes(text)).hexdigest()


def _result_schema(keep: pa.DataType) -> pa.Schema:
    return pa.schema([("keep", keep), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
                      ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode(docs: DataFrame, keep: list[str], settings: Settings = Settings(), with_ids: bool = True) -> DataFrame:
    """The columns ``keep`` of every row plus ``n_tokens, ids, ids_sha256, decoded_sha256``.

    Without ``with_ids`` the column ids is left out.
    """
    s = settings
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*(docs[c] for c in keep)).alias("keep"), text.alias("text"))
    size = F.length("text")
    kind = rows.schema["keep"].dataType.simpleString()
    out = f"keep {kind}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(s)
        for batch in batches:
            schema = _result_schema(batch.schema.field("keep").type)
            for start in range(0, batch.num_rows, s.batch):
                part = batch.slice(start, s.batch)
                done = list(_digests(coder.tok, encode_texts(coder, part.column(1).to_pylist(), s)))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x[0]) for x in done], pa.int64()),
                    pa.array([x[0] if with_ids else None for x in done], pa.list_(pa.int32())),
                    pa.array([x[1] for x in done]), pa.array([x[2] for x in done])], schema=schema)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("at", pa.int64()), ("text", pa.string())])
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                value = text.as_py()
                for at in range(0, len(value), s.spread):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([at], pa.int64()), pa.array([value[at:at + s.spread]])], schema=schema)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(s.tokenizer)
        for batch in batches:
            for i, text in enumerate(batch.column(2)):
                p = encode_stretch(tok, text.as_py(), s)
                lists = [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (p.ids, p.starts, p.ends)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in range(3)), *lists],
                                                 names=["key", "at", "text", "ids", "starts", "ends"])

    def joined(group: pa.Table) -> pa.Table:
        tok = tokenizer(s.tokenizer)
        group = group.sort_by("at")
        text = "".join(group.column("text").to_pylist())
        pieces = []
        for i, at in enumerate(group.column("at").to_pylist()):
            ids, starts, ends = (group.column(c)[i].values.to_numpy().astype(np.int64) for c in ("ids", "starts", "ends"))
            pieces.append(Piece(at, min(at + s.spread, len(text)), ids, starts + at, ends + at))
        own, *digests = next(_digests(tok, [join_tree(tok, text, pieces, s).ids.astype("<u4").tobytes()]))
        return pa.table([pa.array(group.column("key")[:1]), pa.array([len(own)], pa.int64()),
                         pa.array([own if with_ids else None], pa.list_(pa.int32())), *(pa.array([x]) for x in digests)],
                        names=["key", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    short = rows.where(size <= s.spread).mapInArrow(whole, out)
    long = rows.where(size > s.spread).withColumn("key", F.sha2("text", 256))
    dealt = long.select("key", "text").mapInArrow(stretches, "key string, at long, text string")
    once = dealt.groupBy("key", "at").agg(F.first("text").alias("text"))  # copies of a text are encoded once
    done = once.mapInArrow(encoded, "key string, at long, text string, ids array<int>, starts array<int>, ends array<int>")
    results = done.groupBy("key").applyInArrow(
        joined, "key string, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")
    both = short.union(long.select("keep", "key").join(results, "key").select(
        "keep", "n_tokens", "ids", "ids_sha256", "decoded_sha256"))
    fields = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    return both.select(*(F.col("keep").getField(c).alias(c) for c in keep), *(f for f in fields if with_ids or f != "ids"))


def decode(encoded: DataFrame, ids: Column, settings: Settings = Settings()) -> DataFrame:
    """``encoded`` plus ``decoded``: the text of its ids (null ids: empty)."""
    s = settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(s.tokenizer)
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("decoded", pa.string())])
            for start in range(0, batch.num_rows, s.batch):
                part = batch.slice(start, s.batch)
                texts = tok.decode_batch([x or [] for x in part.column(1).to_pylist()], skip_special_tokens=False)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], schema=schema)

    rows = encoded.select(F.struct(*(encoded[c] for c in encoded.columns)).alias("row"), ids.alias("ids"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, decoded string").select("row.*", "decoded")
