"""Hard-negative mining, with segment summaries as a filter before exact scores.

Every vector is cut into segments of its components; the mean and the standard
deviation of each segment are stored beside it. For two segments of width w

    w * (m1 * m2 - d1 * d2)  <=  inner product  <=  w * (m1 * m2 + d1 * d2)

so sums over segments bound the score. The bounds are taken over few wide
segments first; pairs that they cannot rule out are bounded again over the
parts of these segments, level by level, and only what is left is scored
exactly.

The anchors are a stated query set and go against all rows in blocks: tiles of
anchors meet chunks of row blocks, each pair of them in one bounded group that
keeps the best rows so far, so that later blocks are filtered against them.
The bests of all chunks meet in a ranking per anchor.

An anchor's positives are the best ``positives`` rows of its label; for each of
them the best ``negatives`` rows of other labels that score between ``low`` and
``high`` percent of it are returned. Higher scores come first, ties go to the
smaller id.

Defined results: rows without id, label or vector, with an empty vector or with
a null or non-finite component take no part. Vectors of different length are
never compared. Rows that share an id are rows of their own, but never
positives of an anchor with that id; each of several anchors with one id gives
its own rows. A score of zero or less leaves room for negatives at zero only.
Scores outside of 64 bits are cut to +-(2**63 - 1). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .vectors import sound_rows

_MOST = (1 << 63) - 1
_EXACT = float(1 << 53)  # integer sums below it are exact in doubles


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 10
    low: int = 30         # percent of the positive's score
    high: int = 90
    segments: tuple[int, ...] = (1, 4, 16)  # per level of the summaries, each a multiple of the one before
    block_bytes: int = 1 << 21  # of the vectors of one row block
    blocks: int = 4       # per chunk, on average
    tile: int = 4096      # anchors per tile, on average
    part: int = 256       # anchors that are scored together


# -- summaries --------------------------------------------------------------------------------------

def _widths(dim: int, parts: int) -> np.ndarray:
    edges = np.linspace(0, dim, min(parts, dim) + 1).astype(np.int64)
    return np.diff(edges)


def summaries(matrix: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and standard deviations of each row's segments."""
    widths = _widths(matrix.shape[1], parts)
    starts = np.cumsum(widths) - widths
    mean = np.add.reduceat(matrix, starts, axis=1) / widths
    rest = matrix - np.repeat(mean, widths, axis=1)
    return mean, np.sqrt(np.add.reduceat(rest * rest, starts, axis=1) / widths)


def coarser(mean: np.ndarray, dev: np.ndarray, widths: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The summaries of ``parts`` wider segments, put together from those of their parts."""
    edges = np.linspace(0, len(widths), min(parts, len(widths)) + 1).astype(np.int64)[:-1]
    wide = np.add.reduceat(widths, edges)
    first = np.add.reduceat(mean * widths, edges, axis=1) / wide
    second = np.add.reduceat((dev * dev + mean * mean) * widths, edges, axis=1) / wide
    return first, np.sqrt(np.maximum(second - first * first, 0)), wide


class Sketch:
    """The segment summaries of some vectors at every level, weighted so that products give the bounds."""

    def __init__(self, mean: np.ndarray, dev: np.ndarray, dim: int, s: Settings) -> None:
        widths, self.levels = _widths(dim, s.segments[-1]), []
        for parts in s.segments:
            m, d, w = coarser(mean, dev, widths, parts)
            self.levels.append((m * np.sqrt(w), d * np.sqrt(w)))
        m, d = self.levels[-1]
        with np.errstate(over="ignore"):
            self.norm = np.sqrt((m * m + d * d).sum(axis=1))

    def bounds(self, other: Sketch, level: int, mine: slice, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of each pair, rounding errors allowed for."""
        (m1, d1), (m2, d2) = self.levels[level], other.levels[level]
        with np.errstate(over="ignore", invalid="ignore"):
            middle, spread = m1[mine] @ m2[theirs].T, d1[mine] @ d2[theirs].T
            spread += 1e-9 * np.outer(self.norm[mine], other.norm[theirs]) + 1e-9
            return middle - spread, middle + spread


# -- scoring ------------------------------------------------------------------------------------------

def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all pairs of rows: as doubles where these are exact, or else worked out in whole numbers."""
    with np.errstate(over="ignore"):
        top = np.sqrt((a * a).sum(axis=1).max(initial=0)) * np.sqrt((b * b).sum(axis=1).max(initial=0))
    if top < _EXACT:
        return a @ b.T
    whole = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    return np.array([[max(-_MOST, min(_MOST, v)) for v in row] for row in whole], np.int64).reshape(len(a), len(b))


class Best:
    """The best ``k`` rows so far for each slot, within the slot's bounds of the score."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        self.floor = low.copy()  # what a row must reach to be among the best
        self.slot = self.score = self.ident = np.empty(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        slot, score, ident = (np.concatenate(x) for x in (
            (self.slot, slot), (self.score, score.astype(np.int64)), (self.ident, ident)))
        order = np.lexsort((ident, -score, slot))
        slot, score, ident = slot[order], score[order], ident[order]
        first = np.searchsorted(slot, slot)
        keep = np.arange(len(slot)) - first < self.k
        self.slot, self.score, self.ident = slot[keep], score[keep], ident[keep]
        last = np.flatnonzero(np.arange(len(slot)) - first == self.k - 1)
        self.floor[slot[last]] = score[last]


@dataclass
class Rows:
    """A block of rows, or a tile of anchors."""
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    sketch: Sketch


def scan(tile: Rows, block: Rows, best: Best, slots: int, same_label: bool, s: Settings) -> None:
    """Take the rows of ``block`` into the bests of all anchors; ``slots``: bounds per anchor."""
    for at in range(0, len(tile.ids), s.part):
        mine = slice(at, at + s.part)
        held = slice(at * slots, (at + s.part) * slots)
        low = best.floor[held].reshape(-1, slots)
        high = best.high[held].reshape(-1, slots)
        wanted = (low <= high).any(axis=1)
        if not wanted.any():
            continue
        least = np.where(low <= high, low, _MOST).min(axis=1)[:, None]
        most = np.where(low <= high, high, -_MOST).max(axis=1)[:, None]
        columns = np.arange(len(block.ids))
        open_ = tile.labels[mine][:, None] == block.labels
        if same_label:
            open_ &= tile.ids[mine][:, None] != block.ids
        else:
            open_ = ~open_
        open_ &= wanted[:, None]
        for level in range(len(s.segments)):
            some = open_.any(axis=0)
            if not some.all():
                columns, open_ = columns[some], open_[:, some]
            if not len(columns):
                break
            lower, upper = tile.sketch.bounds(block.sketch, level, mine, columns)
            open_ &= ~((upper < least) | (lower > most))  # a bound that is no number rules nothing out
        some = open_.any(axis=0)
        columns, open_ = columns[some], open_[:, some]
        if not len(columns):
            continue
        scores = exact_scores(tile.values[mine], block.values[columns])
        for k in range(slots):
            a, b = np.nonzero(open_ & (scores >= low[:, k:k + 1].astype(scores.dtype))
                              & (scores <= high[:, k:k + 1].astype(scores.dtype)))
            if len(a):
                best.add((a + at) * slots + k, scores[a, b], block.ids[columns[b]])


# -- blocks and tiles ------------------------------------------------------------------------------

_PACK = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
                   ("vectors", pa.binary()), ("summary", pa.binary())])
_PACK_DDL = "dim int, ids binary, labels binary, vectors binary, summary binary"


def _packed(dim: int, ids: np.ndarray, labels: np.ndarray, values: np.ndarray, s: Settings) -> pa.RecordBatch:
    mean, dev = summaries(values, s.segments[-1])
    columns = [[dim], [ids.astype(np.int64).tobytes()], [labels.astype(np.int64).tobytes()], [values.tobytes()],
               [np.concatenate([mean, dev], axis=1).tobytes()]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PACK, strict=True)], schema=_PACK)


def _unpacked(row: dict, s: Settings) -> Rows:
    dim = row["dim"]
    both = np.frombuffer(row["summary"]).reshape(-1, 2 * len(_widths(dim, s.segments[-1])))
    mean, dev = np.split(both, 2, axis=1)
    return Rows(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64),
                np.frombuffer(row["vectors"]).reshape(-1, dim), Sketch(mean, dev, dim, s))


def _pack(s: Settings) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        sizes: dict[int, int] = {}

        def flush(dim: int) -> pa.RecordBatch:
            ids, labels, values = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            sizes.pop(dim)
            return _packed(dim, ids, labels, values, s)

        for batch in batches:
            ids, labels = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for dim, rows, matrix in sound_rows(batch.column(2)):
                step = max(1, s.block_bytes // (8 * dim))
                at = 0
                while at < len(rows):
                    end = at + step - sizes.get(dim, 0)
                    held.setdefault(dim, []).append((ids[rows[at:end]], labels[rows[at:end]], matrix[at:end]))
                    sizes[dim] = sizes.get(dim, 0) + len(rows[at:end])
                    at = end
                    if sizes[dim] >= step:
                        yield flush(dim)
        for dim in list(held):
            yield flush(dim)
    return run


def _pairs(tiles: DataFrame, blocks: DataFrame, dims: dict[int, tuple[int, int]]) -> DataFrame:
    """Each tile beside each chunk of the blocks of its dimension, as groups (dim, tile, chunk)."""
    def number(which: int) -> Column:
        cases = [x for dim, n in dims.items() for x in (F.lit(dim), F.lit(n[which]))]
        return F.element_at(F.create_map(*cases), F.col("dim"))

    dealt = blocks.withColumn("chunk", F.pmod(F.xxhash64("block"), number(1)).cast("int"))
    dealt = dealt.withColumn("tile", F.explode(F.sequence(F.lit(0), number(0) - 1)))
    first = tiles.withColumn("chunk", F.explode(F.sequence(F.lit(0), number(1) - 1)))
    columns = ["dim", "tile", "chunk", "block", "ids", "labels", "vectors", "summary", "extra"]
    return first.withColumn("block", F.lit(-1).cast("long")).select(columns).union(
        dealt.withColumn("extra", F.lit(None).cast("binary")).select(columns))


_FOUND = pa.schema([("dim", pa.int32()), ("tile", pa.int32()), ("at", pa.int32()), ("slot", pa.int32()),
                    ("anchor_id", pa.int64()), ("score", pa.int64()), ("found_id", pa.int64())])
_FOUND_DDL = "dim int, tile int, at int, slot int, anchor_id long, score long, found_id long"


def _search(same_label: bool, s: Settings) -> Callable[[pa.Table], pa.Table]:
    """One group: the anchors of a tile against the blocks of a chunk."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.sort_by("block").to_pylist()
        if rows[0]["block"] != -1 or len(rows) == 1:
            return _FOUND.empty_table()
        tile = _unpacked(rows[0], s)
        if same_label:
            slots, k = 1, s.positives
            low, high = np.full(len(tile.ids), -_MOST), np.full(len(tile.ids), _MOST)
        else:
            slots, k = s.positives, s.negatives
            low, high = np.frombuffer(rows[0]["extra"], np.int64).reshape(2, -1)
        best = Best(low.copy(), high, k)
        for row in rows[1:]:
            scan(tile, _unpacked(row, s), best, slots, same_label, s)
        at, slot = np.divmod(best.slot, slots)
        n = len(at)
        return pa.table([pa.array(x, f.type) for x, f in zip((
            np.full(n, rows[0]["dim"]), np.full(n, rows[0]["tile"]), at, slot, tile.ids[at], best.score, best.ident),
            _FOUND, strict=True)], schema=_FOUND)
    return run


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _limits(s: Settings) -> Callable[[pa.Table], pa.Table]:
    """One tile with the bounds of the negatives of each anchor and positive; low above high where there is no positive."""
    def run(group: pa.Table) -> pa.Table:
        row = next(r for r in group.to_pylist() if r["ids"] is not None)
        n = len(row["ids"]) // 8
        bounds = np.zeros((2, n * s.positives), np.int64)
        bounds[0] = 1
        found = [r for r in group.to_pylist() if r["ids"] is None]
        for r in found:
            k, score = r["at"] * s.positives + r["rank"] - 1, int(r["score"])
            bounds[0, k], bounds[1, k] = -(-s.low * score // 100), s.high * score // 100
        row["extra"] = bounds.tobytes()
        return pa.Table.from_pylist([{f.name: row[f.name] for f in _TILE}], schema=_TILE)
    return run


_TILE = pa.schema([*_PACK, ("tile", pa.int32()), ("extra", pa.binary())])
_TILE_DDL = f"{_PACK_DDL}, tile int, extra binary"


def mine(rows: DataFrame, anchors: Column, settings: Settings = Settings()) -> DataFrame:
    """``rows`` (vec_id, label long, vector of whole numbers as array<double>); ``anchors``: which of them are anchors.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    s = settings
    part = rows.select("vec_id", "label", "vector").where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    blocks = cut(part.mapInArrow(_pack(s), _PACK_DDL).withColumn("block", F.monotonically_increasing_id()))
    asked = part.where(anchors).withColumn("dim", F.size("vector"))
    counts = {r.dim: r.n for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect() if r.dim}
    sizes = {r.dim: r.n for r in blocks.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    dims = {d: (-(-n // s.tile), -(-sizes[d] // s.blocks)) for d, n in counts.items() if d in sizes}
    spark = rows.sparkSession
    if not dims:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    number = F.element_at(F.create_map(*(x for d, n in dims.items() for x in (F.lit(d), F.lit(n[0])))), F.col("dim"))
    dealt = asked.where(F.col("dim").isin(*dims)).withColumn(
        "tile", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), number).cast("int"))

    def packed(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        got = list(sound_rows(group.column("vector").combine_chunks()))
        if not got or not len(got[0][1]):
            return _TILE.empty_table()
        dim, at, matrix = got[0]
        ids, labels = (group.column(c).to_numpy()[at] for c in ("vec_id", "label"))
        order = np.lexsort((ids, labels))
        batch = _packed(dim, ids[order], labels[order], matrix[order], s).to_pylist()[0]
        return pa.Table.from_pylist([batch | {"tile": group.column("tile")[0].as_py(), "extra": None}], schema=_TILE)

    tiles = cut(dealt.groupBy("dim", "tile").applyInArrow(packed, _TILE_DDL))
    blocks = blocks.where(F.col("dim").isin(*dims))
    groups = _pairs(tiles, blocks, dims).groupBy("dim", "tile", "chunk")
    positives = cut(_ranked(groups.applyInArrow(_search(True, s), _FOUND_DDL), ["dim", "tile", "at"], s.positives)
                    .select("dim", "tile", "at", "anchor_id", "rank", "score", "found_id"))

    empty = {f.name: F.lit(None).cast("binary") for f in _TILE if f.name in ("ids", "labels", "vectors", "summary")}
    bare = positives.select("dim", "tile", "at", "rank", "score").withColumns(empty)
    whole = tiles.drop("extra").withColumns({c: F.lit(None).cast(t) for c, t in (("at", "int"), ("rank", "int"), ("score", "long"))})
    bounded = whole.unionByName(bare).groupBy("dim", "tile").applyInArrow(_limits(s), _TILE_DDL)
    groups = _pairs(bounded, blocks, dims).groupBy("dim", "tile", "chunk")
    negatives = _ranked(groups.applyInArrow(_search(False, s), _FOUND_DDL), ["dim", "tile", "at", "slot"], s.negatives)
    chosen = positives.select("dim", "tile", "at", (F.col("rank") - 1).alias("slot"),
                              F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(chosen, ["dim", "tile", "at", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def mine_embeddings(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The query's rows: labels shifted where vec_id is divisible by 7, components floor(256 * x), anchors every 100th id."""
    label = F.col("label").cast("long")
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL")
    # floor() gives a long, which cannot hold every double: whole parts are taken from the double itself
    scaled = rows.select("vec_id", "label", F.transform("embedding", lambda x: x * 256.0).alias("vector"))
    whole = F.transform("vector", lambda x: F.when(F.abs(x) < float(1 << 62), F.floor(x).cast("double")).otherwise(x))
    return mine(scaled.withColumn("vector", whole), F.col("vec_id") % 100 == 0, settings)


ORACLE = """
WITH sound AS (
  SELECT row_number() OVER () AS row_no, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row_no AS a_no, a.vec_id AS anchor_id, b.row_no AS b_no, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM sound a JOIN sound b ON a.vec_id % 100 = 0 AND len(a.v) = len(b.v) AND (a.label <> b.label OR a.vec_id <> b.vec_id)),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a_no ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       (row_number() OVER w)::INTEGER AS rank, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.a_no = p.a_no AND NOT n.same
WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.a_no, p.b_no ORDER BY n.score DESC, n.other_id)
QUALIFY row_number() OVER w <= 10
"""
