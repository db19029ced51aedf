"""Text scores of a log-bilinear language model trained by noise-contrastive estimation.

Tokens are words with A-Z lower-cased plus one end token per text. The model
predicts a token from the ``context`` tokens before it: the sum of their vectors,
each weighted per position and dimension, is multiplied with the vectors of
what may follow and normalised, on two levels:

    P(token) = P(class | context) * P(unit | class, context) * share of the token in its unit

A class holds the tokens of like endings (punctuation at the end left aside). Its
units are frequent tokens, one unit each, and cells of the other tokens by how
they begin; in a cell a token has its share of the training count, less a
Good-Turing share for unseen tokens, so that probabilities add up to one. The
frequent tokens are as many as the number of training tokens to the power ``words``,
so units, classes and cells all grow with the corpus, and the model (two vectors
per unit) stays small beside it.

Jobs: (1) every text is split and hashed once, and its tokens' codes are written;
(2) all training tokens are counted; (3) every task trains a copy of the model on
its own documents in numpy, every place of every text being a target once per
round, and each vector becomes the mean of the copies that met it, weighted by how
often they did; (4) every text is scored in batched matrix products. Counts of the
most frequent tokens (at most ``known``) go along with the model; all other tokens
look their counts up in a join.

The noise of a task is seeded by its partition, so a task that runs again gives the
same copy; how rows fall into partitions changes the mean of the copies.

Defined results: a null text counts as empty and is the end token alone; a row
without doc_id is a training row; rows are scored each for itself; with no
training rows all scores come from the smoothing terms. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_slices

# A token's code: 42 bits of its hash, 12 of its ending's and 10 of its beginning's.
_END_BITS, _BEGIN_BITS = 12, 10
_HASH = np.uint64(((1 << 42) - 1) << (_END_BITS + _BEGIN_BITS))
_MARKS = b".,;:!?\"')]}"
_hash = xxhash.xxh3_64_intdigest


@dataclass(frozen=True)
class Settings:
    words: float = 0.45    # the frequent tokens are the number of training tokens to this power
    context: int = 4
    size: int = 12         # dimensions
    rounds: int = 1        # passes over all places of the training documents
    batch: int = 2048      # targets in a training step
    strip: int = 16        # places in a row that a step takes together
    noise: int = 32        # noise classes in a step
    inner: int = 1         # noise units of its class for each target
    copies: float = 600.0  # the model's copies are the root of the training tokens over this
    rate: float = 0.1      # of Adagrad
    known: int = 1 << 18   # tokens whose counts every task holds (16 bytes each)
    block: int = 1024      # tokens scored in one matrix product


def _codes(data: bytes) -> np.ndarray:
    """The codes of the words of a piece of text (A-Z lower-cased): hashes, and the word's first and last three bytes
    mixed to the bits of beginning and ending; up to eight marks at the end are left aside."""
    words = data.split()
    if not words:
        return np.empty(0, np.uint64)
    line = b"\n".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    at = np.frombuffer(b"\n\n" + line, np.uint8).astype(np.uint32)  # place k of the line is place k + 2
    for _ in range(8):
        marked = _MARK_TABLE[at[ends + 1]] & (ends - starts > 1)
        if not marked.any():
            break
        ends = ends - marked
    size = ends - starts
    last, first = at[ends + 1], at[starts + 2]
    for k in (1, 2):
        inside = size > k
        last = last * np.uint32(251) + np.where(inside, at[ends + 1 - k], 0).astype(np.uint32)
        first = first * np.uint32(251) + np.where(inside, at[np.minimum(starts + 2 + k, len(at) - 1)], 0).astype(np.uint32)
    low = (_spread(last, _END_BITS) << np.uint64(_BEGIN_BITS)) | _spread(first, _BEGIN_BITS)
    return (np.fromiter(map(_hash, words), np.uint64, len(words)) & _HASH) | low


def _spread(x: np.ndarray, bits: int) -> np.ndarray:
    return (x * np.uint32(2654435761) >> np.uint32(32 - bits)).astype(np.uint64)


_MARK_TABLE = np.isin(np.arange(256), np.frombuffer(_MARKS, np.uint8))
END = np.array([_hash(b"\n")], np.uint64) & _HASH  # no word contains white space


def token_codes(text: str | None) -> np.ndarray:
    return np.concatenate([*(_codes(piece) for piece in text_slices(text or "")), END])


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 5 == 1, F.lit(False))


def coded(docs: DataFrame) -> DataFrame:
    """``uid, doc_id, held, codes`` per row: the tokens of the whole text as 8-byte codes."""
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("held", pa.int32()), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                codes = [token_codes(x.as_py()).tobytes() for x in part.column(3)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(codes, pa.binary())], schema=schema)

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), docs["doc_id"].cast("long").alias("doc_id"),
                       held_out(docs).cast("int").alias("held"), docs["text"].cast("string").alias("text"))
    return cut(rows.mapInArrow(run, "uid long, doc_id long, held int, codes binary"))


# -- counting -------------------------------------------------------------

def token_counts(texts: DataFrame) -> DataFrame:
    """``h, c``: every distinct token code of ``codes`` and its count."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            found, counts = np.unique(np.frombuffer(b"".join(held), np.int64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], schema=schema)

        for batch in batches:
            for codes in batch.column(0):
                held.append(codes.as_py())
                size += len(held[-1])
                if size >= 8_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return texts.select("codes").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task needs of the counts; its size grows with a power below one half of the training tokens."""
    total: int
    distinct: int
    bits: int               # classes are the top bits of the ending, 2 ** bits of them
    own: np.ndarray         # sorted codes of the frequent tokens
    own_units: np.ndarray   # their units
    cells: np.ndarray       # unit of each cell (class, beginning)
    starts: np.ndarray      # first unit of each class, and the number of units
    prior: np.ndarray       # smoothed probability of each unit
    known: np.ndarray       # sorted codes with known counts
    known_log: np.ndarray   # log10 of their counts
    known_base: np.ndarray  # log10 of their smoothed shares
    unit_base: np.ndarray   # log10 of the smoothed share of each unit that is a token
    share_log: np.ndarray   # log10 of (1 - unseen share) / count, per unit that is a cell; 0 for tokens
    unseen_log: np.ndarray  # log10 of the unseen share, per unit that is a cell

    @property
    def classes(self) -> int:
        return 1 << self.bits

    @property
    def units(self) -> int:
        return len(self.prior)

    @property
    def spread(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def unit_ids(self, codes: np.ndarray) -> np.ndarray:
        out = self.cells[_cell(codes, self.bits)]
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, codes), len(self.own) - 1)
            out = np.where(self.own[at] == codes, self.own_units[at], out)
        return out

    def class_of(self, units: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, units, side="right") - 1

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens' counts are held here, and where."""
        if not len(self.known):
            return np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
        return self.known[at] == codes, at


def _beginnings(bits: int) -> int:
    """Bits of the beginning that tell the cells of a class apart."""
    return max(0, min(_BEGIN_BITS, bits - 2))


def _cell(codes: np.ndarray, bits: int) -> np.ndarray:
    """Class and beginning of each code, as one number."""
    ending = (codes >> np.uint64(_BEGIN_BITS + _END_BITS - bits)) & np.uint64((1 << bits) - 1)
    more = _beginnings(bits)
    begin = (codes >> np.uint64(_BEGIN_BITS - more)) & np.uint64((1 << more) - 1)
    return ((ending << np.uint64(more)) | begin).astype(np.int64)


def _columns(df: DataFrame) -> list[np.ndarray]:
    got = df.toArrow()
    return [got.column(i).to_numpy() for i in range(got.num_columns)]


def vocabulary(counts: DataFrame, s: Settings) -> Vocabulary:
    row = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = row["n"] or 0, row["v"]
    words = math.ceil(total ** s.words)
    bits = min(_END_BITS, max(1, round(math.log2(max(2, 2 * words)) / 2)))
    more = _beginnings(bits)
    top, top_counts = _columns(counts.orderBy(F.desc("c"), "h").limit(words))
    # tokens by the power of two of their count: at most 63 rows; as many powers as fit are held
    powers = sorted(counts.groupBy(F.floor(F.log2("c")).cast("int").alias("p")).count().collect(), reverse=True)
    least, held = None, 0
    for power, n in powers:
        if held + n > s.known:
            break
        least, held = power, held + n
    known, known_counts = _columns(counts.where(F.floor(F.log2("c")) >= least)) if least is not None else (top, top_counts)
    sums = np.zeros((2, 1 << (bits + more)))
    ending = F.shiftright("h", _BEGIN_BITS + _END_BITS - bits).bitwiseAND(F.lit((1 << bits) - 1))
    begin = F.shiftright("h", _BEGIN_BITS - more).bitwiseAND(F.lit((1 << more) - 1))
    rest = counts.groupBy((ending * (1 << more) + begin).cast("int").alias("g")).agg(
        F.sum("c").alias("c"), F.sum((F.col("c") == 1).cast("int")).alias("ones"))  # one row per cell
    for g, c, ones in rest.collect():
        sums[:, g] = c, ones
    own = top.view(np.uint64)
    own_cells = _cell(own, bits)
    np.subtract.at(sums[0], own_cells, top_counts)
    np.subtract.at(sums[1], own_cells, top_counts == 1)
    unseen = (sums[1] + 1) / (sums[0] + 2)
    masses = np.concatenate([sums[0], top_counts]) + 0.5
    every = np.concatenate([np.arange(sums.shape[1]), own_cells]) >> more
    order = np.argsort(every, kind="stable")  # units class by class: its cells, then its tokens
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    share, new = np.zeros(len(order)), np.zeros(len(order))
    share[place[:sums.shape[1]]] = np.log10((1 - unseen) / np.maximum(sums[0], 1))
    new[place[:sums.shape[1]]] = np.log10(unseen)
    unit_base = np.zeros(len(order))
    unit_base[place[sums.shape[1]:]] = np.log10((top_counts + 0.5) / (total + 0.5 * (distinct + 1)))
    order_own, order_known = np.argsort(own), np.argsort(known.view(np.uint64))
    return Vocabulary(
        total, distinct, bits, own[order_own], place[sums.shape[1]:][order_own], place[:sums.shape[1]],
        np.searchsorted(every[order], np.arange((1 << bits) + 1)), masses[order] / masses.sum(),
        known.view(np.uint64)[order_known], np.log10(np.maximum(known_counts[order_known], 1)),
        np.log10((known_counts[order_known] + 0.5) / (total + 0.5 * (distinct + 1))), unit_base, share, new)


# -- model ----------------------------------------------------------------

@dataclass
class Model:
    """Context vectors of the units (the last row: places before the text), position weights, vectors with their biases
    (last column) of the classes and of the units."""
    context: np.ndarray
    places: np.ndarray
    outer: np.ndarray
    inner: np.ndarray

    def tables(self) -> tuple[np.ndarray, ...]:
        return self.context, self.places, self.outer, self.inner

    def copy(self) -> Model:
        return Model(*(x.copy() for x in self.tables()))


def class_prior(v: Vocabulary) -> np.ndarray:
    return np.add.reduceat(v.prior, v.starts[:-1])


def fresh(v: Vocabulary, s: Settings) -> Model:
    rng = np.random.default_rng(17)

    def small(rows: int, bias: np.ndarray | None = None) -> np.ndarray:
        out = rng.normal(0, 0.1, (rows, s.size)).astype(np.float32)
        return out if bias is None else np.concatenate([out, bias[:, None].astype(np.float32)], axis=1)

    outer = class_prior(v)
    own_class = v.class_of(np.arange(v.units))
    return Model(small(v.units + 1), np.full((s.context, s.size), 1 / s.context, np.float32),
                 small(v.classes, np.log(outer)), small(v.units, np.log(v.prior / outer[own_class])))


def padded(ids: np.ndarray, sizes: np.ndarray, n: int, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts that follow one another in ``ids``, n times ``before`` in front of each; and the tokens' places there.

    The n tokens before a place are then its context, also at the start of a text.
    """
    places = np.arange(len(ids)) + n * (1 + np.repeat(np.arange(len(sizes)), sizes))
    out = np.full(len(ids) + n * len(sizes), before, np.int64)
    out[places] = ids
    return out, places


def _summed(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, how often each occurs and the sum of its rows."""
    order = np.argsort(ids, kind="stable")
    ordered = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.diff(np.append(first, len(ids))), np.add.reduceat(rows.take(order, axis=0), first, axis=0)


class Trainer:
    def __init__(self, model: Model, v: Vocabulary, s: Settings, seed: tuple[int, ...]):
        self.m, self.v, self.s = model.copy(), v, s
        self.rng = np.random.default_rng(seed)
        prior = class_prior(v)
        self.outer_sums = np.cumsum(prior)
        self.outer_noise = np.log(s.noise * prior).astype(np.float32)
        self.own = v.class_of(np.arange(v.units))
        self.first, self.room, self.drawn = draws(v)
        times = np.bincount(self.drawn, minlength=v.units)
        self.inner_noise = np.log(s.inner * times / self.room[self.own]).astype(np.float32)
        self.squares = [np.full(len(x), 0.1, np.float32) for x in self.m.tables()]  # one rate per vector
        self.met = [np.zeros(len(x), np.int64) for x in self.m.tables()]

    def step(self, strips: np.ndarray) -> None:
        """One ascent step of both levels' contrastive objectives; strips (rows) of a padded sequence, each with the
        context of its first target in front. Neighbouring targets share the vectors of their contexts."""
        m, s, rng = self.m, self.s, self.rng
        n, size = s.context, strips.shape[1] - s.context
        targets = strips[:, n:].ravel()
        kept = np.flatnonzero(targets < self.v.units)
        if not len(kept):
            return
        unit = targets[kept]
        own = self.own[unit]
        # A strip's vectors lie in one row, so that each operation runs over whole strips.
        vectors = m.context.take(strips, axis=0).reshape(len(strips), -1)
        weights = np.tile(m.places, size)

        def before(i: int) -> slice:
            return slice((n - 1 - i) * s.size, (n - 1 - i + size) * s.size)

        mixed = vectors[:, before(0)] * weights[0]
        for i in range(1, n):
            mixed += vectors[:, before(i)] * weights[i]
        q = np.empty((len(unit), s.size + 1), np.float32)             # with a 1 for the bias
        q[:, :-1] = mixed.reshape(-1, s.size).take(kept, axis=0)
        q[:, -1] = 1
        # classes against noise classes that the batch shares
        noise = np.minimum(np.searchsorted(self.outer_sums, rng.random(s.noise) * self.outer_sums[-1]), len(m.outer) - 1)
        true, false = m.outer.take(own, axis=0), m.outer[noise]
        good = _pull(_dot(q, true) - self.outer_noise[own])[:, None]
        bad = _pull(self.outer_noise[noise] - q @ false.T)
        np.negative(bad, out=bad)
        dq = good * true
        dq += bad @ false
        self._add(2, np.concatenate([own, noise]), np.concatenate([good * q, bad.T @ q]))
        # units against noise units of the same class
        true = m.inner.take(unit, axis=0)
        good = _pull(_dot(q, true) - self.inner_noise[unit])[:, None]
        dq += good * true
        ids, rows = [unit], [good * q]
        for _ in range(s.inner):
            other = self.drawn[self.first[own] + (rng.random(len(own), np.float32) * self.room[own]).astype(np.int64)]
            false = m.inner.take(other, axis=0)
            bad = -_pull(self.inner_noise[other] - _dot(q, false))[:, None]
            dq += bad * false
            ids.append(other)
            rows.append(bad * q)
        self._add(3, np.concatenate(ids), np.concatenate(rows))
        mixed[:] = 0
        mixed.reshape(-1, s.size)[kept] = dq[:, :-1]
        d_context, d_places = np.zeros_like(vectors), np.empty_like(m.places)
        for i in range(n):
            d_places[i] = np.einsum("sk,sk->k", mixed, vectors[:, before(i)]).reshape(size, s.size).sum(axis=0)
            d_context[:, before(i)] += mixed * weights[i]
        self._add(0, strips.ravel(), d_context.reshape(-1, s.size))
        self._add(1, np.arange(n), d_places)

    def _add(self, table: int, ids: np.ndarray, rows: np.ndarray) -> None:
        x, squares, met = self.m.tables()[table], self.squares[table], self.met[table]
        ids, n, d = _summed(ids if len(x) > 1 << 16 else ids.astype(np.uint16), rows)
        total = squares[ids] + _dot(d, d) / d.shape[1]
        squares[ids] = total
        d *= (self.s.rate / np.sqrt(total))[:, None]
        x[ids] += d
        met[ids] += n


def draws(v: Vocabulary, per: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units to draw noise from, each as often as its share of its class asks for (at least once): places of a class and
    how many, and the units at these places; ``per``: places per unit of a class, on average."""
    own = v.class_of(np.arange(v.units))
    size = np.diff(v.starts)
    share = v.prior / class_prior(v)[own]
    times = np.maximum(1, np.round(share * size[own] * per)).astype(np.int64)
    room = np.add.reduceat(times, v.starts[:-1])
    return np.cumsum(room) - room, room, np.repeat(np.arange(v.units), times)


def _pull(x: np.ndarray) -> np.ndarray:
    """1 - the logistic function, written over ``x``."""
    np.minimum(x, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows."""
    return np.einsum("bd,bd->b", a, b)


def _texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts put together up to ``most`` codes or so: their codes, and how many each text has."""
    held, size = [], 0
    for batch in batches:
        for codes in batch.column(0):
            held.append(codes.as_py())
            size += len(held[-1]) // 8
            if size >= most:
                yield np.frombuffer(b"".join(held), np.uint64), np.array([len(x) // 8 for x in held])
                held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint64), np.array([len(x) // 8 for x in held])


def _train(batches: Iterator[pa.RecordBatch], model: Model, v: Vocabulary, s: Settings, seed: tuple[int, ...]) -> Trainer:
    """A copy of the model, trained at every place of the texts."""
    trainer = Trainer(model, v, s, seed)
    n = s.context
    for codes, sizes in _texts(batches, 64 * s.batch):
        sequence, _ = padded(v.unit_ids(codes), sizes, n, v.units)
        starts = np.arange(n, len(sequence), s.strip)
        strips = np.full((len(starts), n + s.strip), v.units)
        for k in range(n + s.strip):
            inside = starts + k - n < len(sequence)
            strips[inside, k] = sequence[starts[inside] + k - n]
        order = trainer.rng.permutation(len(strips))
        per = max(1, s.batch // s.strip)
        for i in range(0, len(order), per):
            trainer.step(strips[order[i:i + per]])
    return trainer


def train_round(texts: DataFrame, model: Model, v: Vocabulary, s: Settings, turn: int) -> Model:
    """Every vector as the mean of the tasks' copies of it, weighted by how often each copy met it."""
    shared = texts.sparkSession.sparkContext.broadcast((model, v))
    schema = pa.schema([("row", pa.int32()), ("weight", pa.float64()), ("vector", pa.binary())])
    sizes = [len(x) for x in model.tables()]
    starts = np.cumsum([0, *sizes])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, voc = shared.value
        trainer = _train(batches, start, voc, s, (turn, TaskContext.get().partitionId()))
        for table, (x, met) in enumerate(zip(trainer.m.tables(), trainer.met, strict=True)):
            hit = np.flatnonzero(met)
            for i in range(0, len(hit), 4096):
                some = hit[i:i + 4096]
                vectors = [(x[k].astype(np.float64) * met[k]).astype(np.float32).tobytes() for k in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array(some + starts[table], pa.int32()), pa.array(met[some].astype(np.float64)), pa.array(vectors, pa.binary())], schema=schema)

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, weight, total = None, 0.0, None
        done = []
        for batch in batches:
            for k, w, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vector = np.frombuffer(data, np.float32).astype(np.float64)
                if k != row:
                    if row is not None:
                        done.append((row, weight, (total / weight).astype(np.float32).tobytes()))
                    row, weight, total = k, w, vector
                else:
                    weight, total = weight + w, total + vector
            if len(done) >= 4096:
                yield _rows(done, schema)
                done = []
        if row is not None:
            done.append((row, weight, (total / weight).astype(np.float32).tobytes()))
        if done:
            yield _rows(done, schema)

    ddl = "row int, weight double, vector binary"
    trainers = max(1, math.ceil(math.sqrt(v.total) / s.copies))  # so that all copies together grow with the corpus
    copies = cut(texts.select("codes").coalesce(trainers).mapInArrow(run, ddl))
    means = copies.repartition("row").sortWithinPartitions("row", "weight", "vector").mapInArrow(mean, ddl)
    out = model.copy()
    got = means.select("row", "vector").toArrow()  # at most one row per vector of the model
    for k, data in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
        table = int(np.searchsorted(starts, k, side="right")) - 1
        out.tables()[table][k - starts[table]] = np.frombuffer(data, np.float32)
    shared.destroy()
    return out


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def unit_logs(model: Model, v: Vocabulary, units: np.ndarray, sizes: np.ndarray, block: int) -> np.ndarray:
    """log10 P(class | context) + log10 P(unit | class, context) of each token of texts that follow one another,
    normalised over all classes and all units of the class."""
    n = len(model.places)
    sequence, at = padded(units, sizes, n, v.units)
    vectors = model.context.take(sequence, axis=0).T.copy()  # dimensions, places
    mixed = np.zeros_like(vectors)
    for i in range(n):
        mixed[:, i + 1:] += vectors[:, :-1 - i] * model.places[i][:, None]
    q = np.empty((len(units), len(mixed) + 1), np.float32)
    q[:, :-1] = mixed.T.copy().take(at, axis=0)
    q[:, -1] = 1
    own = v.class_of(np.arange(v.units))[units]
    widest = np.sqrt(_dot(q, q).max(initial=0))
    safe = all(widest * np.sqrt(_dot(x, x).max()) < 80 for x in (model.outer, model.inner))
    out, outer = np.empty(len(units)), np.ascontiguousarray(model.outer.T)
    for i in range(0, len(units), block):
        out[i:i + block] = _log_softmax(q[i:i + block] @ outer, own[i:i + block], safe)
    order = np.argsort(own.astype(np.uint16), kind="stable")
    edges = np.searchsorted(own[order], np.arange(v.classes + 1))
    for k in np.flatnonzero(np.diff(edges)):
        inside = np.ascontiguousarray(model.inner[v.starts[k]:v.starts[k + 1]].T)
        for i in range(edges[k], edges[k + 1], block):
            some = order[i:min(i + block, edges[k + 1])]
            out[some] += _log_softmax(q.take(some, axis=0) @ inside, units[some] - v.starts[k], safe)
    return out / math.log(10)


def _log_softmax(scores: np.ndarray, chosen: np.ndarray, safe: bool) -> np.ndarray:
    """ln of the chosen entries' shares; ``safe``: no power can overflow."""
    if not safe:
        scores -= scores.max(axis=1, keepdims=True)
    picked = scores[np.arange(len(chosen)), chosen]
    np.exp(scores, out=scores)
    return picked - np.log(scores @ np.ones(scores.shape[1], np.float32))


# -- scoring --------------------------------------------------------------

_SCORED = pa.schema([("uid", pa.int64()), ("h", pa.int64()), ("tf", pa.int64()), ("more", pa.float64()), ("sum", pa.struct([
    ("doc_id", pa.int64()), ("held", pa.int32()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base", pa.float64()), ("lm", pa.float64())]))])
_SCORED_DDL = ("uid long, h long, tf long, more double, "
               "sum struct<doc_id: long, held: int, n_tokens: long, n_known: long, base: double, lm: double>")


def partial_scores(rows: DataFrame, model: Model, v: Vocabulary, s: Settings) -> DataFrame:
    """Per row a summary, in which the rarer tokens count as unseen; and per distinct rarer token one row ``uid, h, tf, more``.

    ``more`` is what its score gains, besides the log of its count, where the token has been seen.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model, v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, voc = shared.value

        def score(heads, texts):
            tokens = np.frombuffer(b"".join(texts), np.uint64)
            sizes = np.array([len(x) // 8 for x in texts])
            starts = np.cumsum(sizes) - sizes
            units = voc.unit_ids(tokens)
            lm = unit_logs(m, voc, units, sizes, s.block)
            base = voc.unit_base[units]
            rarer = np.flatnonzero(voc.share_log[units])  # tokens in cells
            held, at = voc.find(tokens[rarer])
            rest, rarer = rarer[~held], rarer[held]
            base[rarer] = voc.known_base[at[held]]
            lm[rarer] += voc.known_log[at[held]] + voc.share_log[units[rarer]]
            lm[rest] += voc.unseen_log[units[rest]]
            has = np.ones(len(tokens), np.int64)
            has[rest] = 0
            sums = [np.add.reduceat(x, starts) for x in (has, base, lm)]
            owner, rest_codes = np.repeat(np.arange(len(sizes)), sizes)[rest], tokens[rest]
            gain = voc.share_log[units[rest]] - voc.unseen_log[units[rest]]
            order = np.lexsort((rest_codes, owner))
            owner, rest_codes, gain = owner[order], rest_codes[order], gain[order]
            first = np.ones(len(owner), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (rest_codes[1:] != rest_codes[:-1])
            at = np.flatnonzero(first)
            tf = np.diff(np.append(at, len(owner)))
            uid, doc_id, own = zip(*heads, strict=True)
            uids = np.array(uid, np.int64)
            summary = pa.StructArray.from_arrays([
                pa.array(doc_id, pa.int64()), pa.array(own, pa.int32()), pa.array(sizes, pa.int64()),
                *(pa.array(x) for x in sums)], fields=list(_SCORED.field("sum").type))
            blank = np.zeros(len(uids), np.int64)
            spread = (uids * -7046029254386353131)  # where a summary goes does not matter
            yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(spread), pa.array(blank), pa.array(blank * 0.0), summary],
                                             schema=_SCORED)
            if len(at):
                yield pa.RecordBatch.from_arrays([
                    pa.array(uids[owner[at]]), pa.array(rest_codes[at].view(np.int64)), pa.array(tf, pa.int64()),
                    pa.array(gain[at]), pa.nulls(len(at), _SCORED.field("sum").type)], schema=_SCORED)

        heads, texts, held = [], [], 0
        for batch in batches:
            named = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for head, codes in zip(named, batch.column(3), strict=True):
                heads.append(head)
                texts.append(codes.as_py())
                held += len(texts[-1]) // 8
                if held >= 1 << 16:
                    yield from score(heads, texts)
                    heads, texts, held = [], [], 0
        if heads:
            yield from score(heads, texts)

    return rows.mapInArrow(run, _SCORED_DDL)


def score_texts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``."""
    s = settings
    rows = coded(docs)
    training = rows.where("held = 0").select("codes")
    counts = cut(token_counts(training))
    v = vocabulary(counts, s)
    model = fresh(v, s)
    for turn in range(s.rounds):
        model = train_round(training, model, v, s, turn)
    scored = partial_scores(rows, model, v, s).join(counts, "h", "left")
    rare, tf, c = F.col("sum").isNull(), F.col("tf"), F.col("c")
    seen = F.when(c.isNotNull(), tf * (F.log10(c) + F.col("more"))).otherwise(F.lit(0.0))
    out = scored.select(
        "uid", *(F.col(f"sum.{x}").alias(x) for x in ("doc_id", "held", "n_tokens")),
        F.when(rare, F.when(c.isNotNull(), tf).otherwise(F.lit(0))).otherwise(F.col("sum.n_known")).alias("n_known"),
        F.when(rare, tf * F.log10((F.coalesce(c, F.lit(0)) + 0.5) / F.lit(float(v.spread)))).otherwise(
            F.col("sum.base")).alias("base"),
        F.when(rare, seen).otherwise(F.col("sum.lm")).alias("lm"))
    return out.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), (F.max("held") == 1).alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(int(v.total)).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"), F.sum("lm").alias("score")).drop("uid")
