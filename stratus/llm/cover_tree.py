"""Near-duplicate vectors by cover trees that are traversed in pairs.

Vectors are scaled to length one, where a cosine of at least ``c`` is a distance
of at most ``sqrt(2 - 2c)``. Equal vectors are one class with a count.

A sample of at most ``seeds`` classes (by hash) gives an upper tree of nested
levels with halving radii, which only serves to put all classes into an order
in which neighbours are close. Consecutive classes of that order are a block of
bounded size. Each block holds a cover tree of its own: a node's children are
centres more than half the node's radius apart that cover all its vectors; each
node knows the greatest distance of a vector below it.

Pairs of nodes are traversed together. A pair goes where the centres lie
further apart than the threshold and both covering radii; all its links are
counted at once where they lie nearer than the threshold less both radii; else
the children meet. The same bound prunes pairs of blocks first, level by level
over groups of blocks, so that no list of all blocks is needed anywhere.

A block is first traversed with itself. Its linked classes get a common label,
so that a pair of blocks reports a link between two labels once however many
vectors they hold. Link counts are summed per class, labels joined into
components by repeated contraction.

Scores are taken in double precision; pairs within 1e-9 of the threshold are
scored again by one fixed formula, so that a link does not depend on blocks.

Defined results: null, empty and zero vectors and those with a null or
non-finite component link with nothing, and neither do vectors of different
length. Each row counts as a vector of its own, also where ids or whole rows
repeat; the component is the smallest id that is linked. A row without id has
its links counted, but gives its component no id: such a component's id is null
only if no row of it has one. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, record_batches
from .graph import components
from .vectors import sound_rows

_SLACK = 1e-6  # on bounds of distances: rounding errors must not prune


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.95
    seeds: int = 4096         # classes that the upper tree is made of, fewer where
    seed_bytes: int = 1 << 23  # they would take more than this
    block_bytes: int = 1 << 21  # of the vectors of a block, in single precision
    leaf: int = 8             # nodes of at most so many vectors have them as children
    held: int = 1 << 20       # links that are held before they are merged
    fan: int = 64             # blocks per group, groups per group of groups
    partners: int = 8         # blocks that one task group gets beside a block

    @property
    def reach(self) -> float:
        return float(np.sqrt(2 - 2 * self.cosine))


# -- one tree -----------------------------------------------------------------------------------------

def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between rows of length one."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def net(points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres further than ``radius`` apart that cover all points, and the centre of each point."""
    owner = np.full(len(points), -1)
    left, centres = np.arange(len(points)), []
    while len(left):
        some = left[:256]
        near = distances(points[some], points[some]) <= radius
        chosen: list[int] = []
        for k in range(len(some)):
            if not near[k, chosen].any():
                chosen.append(k)
        base = len(centres)
        centres += some[chosen].tolist()
        away = distances(points[left], points[some[chosen]])
        best = away.argmin(axis=1)
        best[:len(some)][chosen] = np.arange(len(chosen))
        covered = away[np.arange(len(left)), best] <= radius
        covered[:len(some)] = True
        owner[left[covered]] = base + best[covered]
        left = left[~covered]
    return np.array(centres, np.int64), owner


@dataclass
class Tree:
    """A cover tree over ``points`` (rows of length one), in an order where each node's vectors are a range.

    Node ``k`` holds ``points[start[k]:stop[k]]``, the first of them its centre; its
    children are the nodes ``child[k]:child[k] + n_child[k]``.
    """
    points: np.ndarray
    order: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    n_child: np.ndarray


def build(points: np.ndarray, leaf: int) -> Tree:
    """Levels of halving radii from the root down; nodes are numbered level by level."""
    order = np.arange(len(points))
    start, stop, radius, child, n_child = [0], [len(points)], [0.0], [0], [0]
    queue, at = [2.0], 0
    while at < len(start):
        a, b = start[at], stop[at]
        if b - a > 1:
            held = order[a:b]
            radius[at] = float(distances(points[held[:1]], points[held]).max())
            level, parts = queue[at], None
            if b - a > leaf:
                level = min(level, radius[at])
                while level > 1e-9:
                    level /= 2
                    centres, owner = net(points[held], level)
                    if len(centres) > 1:
                        parts = owner
                        break
            if parts is None:  # few vectors, or copies up to rounding: each is a node
                parts, centres = np.arange(b - a), np.arange(b - a)
            first = np.ones(b - a, bool)
            first[centres] = False
            inner = np.lexsort((np.arange(b - a), first, parts))
            order[a:b] = held[inner]
            sizes = np.bincount(parts, minlength=len(centres))
            edges = a + np.concatenate([[0], np.cumsum(sizes)])
            child[at], n_child[at] = len(start), len(sizes)
            start += edges[:-1].tolist()
            stop += edges[1:].tolist()
            more = len(sizes)
            radius += [0.0] * more
            child += [0] * more
            n_child += [0] * more
            queue += [level] * more
        at += 1
    ints = [np.array(x, np.int64) for x in (start, stop, child, n_child)]
    return Tree(points[order], order, ints[0], ints[1], np.array(radius), ints[2], ints[3])


# -- two trees together -------------------------------------------------------------------------------

def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    """The cosine of two vectors of length one, by one fixed order of additions."""
    total = 0.0
    for p, q in zip(x.tolist(), y.tolist(), strict=True):
        total += p * q
    return total


class Forest:
    """Least label of each set of joined places."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links between places: labels sink to the least one of their neighbours until nothing changes."""
        while True:
            x, y = self.up[a], self.up[b]
            low = np.minimum(x, y)
            if (x == y).all():
                return
            np.minimum.at(self.up, x, low)
            np.minimum.at(self.up, y, low)
            while (self.up != self.up[self.up]).any():
                self.up = self.up[self.up]


class Links:
    """What a traversal finds: link counts of both sides' places; ``merge`` gets the linked places, batch by batch.

    Of ranges that are linked as a whole it gets links enough to hold them together.
    """

    def __init__(self, weight_a: np.ndarray, weight_b: np.ndarray, merge: Callable[[np.ndarray, np.ndarray], None], held: int) -> None:
        self.weights, self.merge, self.held = (weight_a, weight_b), merge, held
        self.sums = [np.concatenate([[0], np.cumsum(w)]) for w in self.weights]
        self.steps = np.zeros(len(weight_a) + 1, np.int64), np.zeros(len(weight_b) + 1, np.int64)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def points(self, i: np.ndarray, j: np.ndarray) -> None:
        for step, place, other in ((self.steps[0], i, self.weights[1][j]), (self.steps[1], j, self.weights[0][i])):
            np.add.at(step, place, other)
            np.add.at(step, place + 1, -other)
        self._hold(i, j)

    def span(self, i: int, j: int, k: int, n: int) -> None:
        """All of [i, j) with all of [k, n)."""
        for step, a, b, other in ((self.steps[0], i, j, self.sums[1][n] - self.sums[1][k]),
                                  (self.steps[1], k, n, self.sums[0][j] - self.sums[0][i])):
            step[a] += other
            step[b] -= other
        self._hold(np.concatenate([np.arange(i, j), np.full(n - k, i)]), np.concatenate([np.full(j - i, k), np.arange(k, n)]))

    def _hold(self, i: np.ndarray, j: np.ndarray) -> None:
        self.pairs.append((i, j))
        self.size += len(i)
        if self.size >= self.held:
            self.flush()

    def flush(self) -> None:
        if self.pairs:
            self.merge(*(np.concatenate(x) for x in zip(*self.pairs, strict=True)))
        self.pairs, self.size = [], 0

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.cumsum(s)[:-1] for s in self.steps)


def _children(t: Tree, k: int) -> np.ndarray:
    return np.arange(t.child[k], t.child[k] + t.n_child[k]) if t.n_child[k] else np.array([k])


def traverse(a: Tree, b: Tree, links: Links, s: Settings, same: bool = False) -> None:
    """All links between two trees; with ``same`` (one tree twice) each pair of places is met in both orders."""
    stack = [(0, 0)]
    size_a, size_b = a.stop - a.start, b.stop - b.start
    while stack:
        p, q = stack.pop()
        ca, cb = _children(a, p), _children(b, q)
        for at in range(0, len(ca), 256):
            mine = ca[at:at + 256]
            dots = a.points[a.start[mine]] @ b.points[b.start[cb]].T
            away = np.sqrt(np.maximum(2 - 2 * dots, 0))
            spread = a.radius[mine][:, None] + b.radius[cb]
            x, y = np.nonzero(away <= s.reach + spread + _SLACK)
            if not len(x):
                continue
            dots, away, spread = dots[x, y], away[x, y], spread[x, y]
            x, y = mine[x], cb[y]
            single = (size_a[x] == 1) & (size_b[y] == 1)
            if single.any():
                i, j, score = a.start[x[single]], b.start[y[single]], dots[single]
                linked = score >= s.cosine
                for k in np.flatnonzero(np.abs(score - s.cosine) < 1e-9):
                    linked[k] = exact_cosine(a.points[i[k]], b.points[j[k]]) >= s.cosine
                if same:
                    linked &= i != j
                if linked.any():
                    links.points(i[linked], j[linked])
            more = ~single
            inside = more & (away + spread <= s.reach - _SLACK)
            if same:
                inside &= x != y
            for m, n in zip(x[inside].tolist(), y[inside].tolist(), strict=True):
                links.span(a.start[m], a.stop[m], b.start[n], b.stop[n])
            more &= ~inside
            stack.extend(zip(x[more].tolist(), y[more].tolist(), strict=True))
    links.flush()


def self_links(tree: Tree, weights: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Links of each place within the tree, and the least place of its component."""
    forest = Forest(len(tree.points))
    links = Links(weights, weights, forest.join, s.held)
    traverse(tree, tree, links, s, same=True)
    return links.counts()[0], forest.up


# -- classes -------------------------------------------------------------------------------------------

_ROWS = pa.schema([("vec_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("dim", pa.int32()), ("data", pa.binary())])


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; scaled to 1 at most first, against overflow."""
    matrix = matrix.astype(np.float64)
    near = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return near / np.sqrt((near * near).sum(axis=1, keepdims=True))


def _classed(kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row with the hash and the bytes of its vector (``kind``: numbers of 4 or 8 bytes); none where it links with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = [(k, None, None, None, None) for k in ids]
            for dim, rows, matrix in sound_rows(batch.column(1)):
                some = matrix.any(axis=1)
                for at, row in zip(rows[some].tolist(), (matrix[some] + 0.0).astype(kind), strict=True):  # -0.0 is 0.0
                    data = row.tobytes()
                    out[at] = ids[at], *np.frombuffer(xxhash.xxh3_128_digest(data), np.int64).tolist(), dim, data
            yield from record_batches(iter(out), _ROWS)
    return run


# -- blocks -------------------------------------------------------------------------------------------

_BLOCK = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("centre", pa.binary()), ("radius", pa.float64()),
                    ("classes", pa.binary()), ("weights", pa.binary()), ("points", pa.binary()), ("labels", pa.binary()),
                    ("counts", pa.binary()), ("nodes", pa.binary())])
_BLOCK_DDL = ("dim int, part int, n int, centre binary, radius double, classes binary, weights binary, points binary, "
              "labels binary, counts binary, nodes binary")


def _block(dim: int, part: int, classes: list[int], weights: list[int], data: list[bytes], kind: str, s: Settings) -> tuple:
    raw = np.frombuffer(b"".join(data), kind).reshape(-1, dim)
    tree = build(unit_rows(raw), s.leaf)
    numbers, weight = np.array(classes, np.int64)[tree.order], np.array(weights, np.int64)[tree.order]
    counts, labels = self_links(tree, weight, s)
    nodes = np.stack([tree.start, tree.stop, tree.radius.view(np.int64), tree.child, tree.n_child])
    return (dim, part, len(numbers), tree.points[0].tobytes(), float(tree.radius[0]), numbers.tobytes(), weight.tobytes(),
            raw[tree.order].tobytes(), numbers[labels].tobytes(), (counts + weight - 1).tobytes(), nodes.tobytes())


def _blocks(kind: str, s: Settings) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of one part in the upper tree's order -> blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            held: tuple[list, list, list] = [], [], []
            now = None
            for batch in batches:
                for dim, part, number, weight, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if held[0] and (now != (dim, part) or len(held[0]) >= _per_block(dim, s)):
                        yield _block(*now, *held, kind, s)
                        held = [], [], []
                    now = dim, part
                    for column, value in zip(held, (number, weight, data), strict=True):
                        column.append(value)
            if held[0]:
                yield _block(*now, *held, kind, s)
        return record_batches(made(), _BLOCK, size=1)
    return run


@dataclass
class Block:
    tree: Tree
    classes: np.ndarray
    weights: np.ndarray
    labels: np.ndarray


def _per_block(dim: int, s: Settings) -> int:
    return max(1, s.block_bytes // (4 * dim))


def _read(row: dict, kind: str) -> Block:
    points = unit_rows(np.frombuffer(row["points"], kind).reshape(-1, row["dim"]))
    start, stop, radius, child, n_child = np.frombuffer(row["nodes"], np.int64).reshape(5, -1)
    tree = Tree(points, np.arange(len(points)), start, stop, radius.view(np.float64), child, n_child)
    return Block(tree, *(np.frombuffer(row[c], np.int64) for c in ("classes", "weights", "labels")))


# -- pairs of blocks ----------------------------------------------------------------------------------

_GROUP = pa.schema([("dim", pa.int32()), ("seq", pa.int64()), ("node", pa.int64()), ("centre", pa.binary()), ("radius", pa.float64()),
                    ("inner", pa.list_(pa.int64())), ("centres", pa.binary()), ("radii", pa.binary())])
_GROUP_DDL = "dim int, seq long, node long, centre binary, radius double, inner array<bigint>, centres binary, radii binary"


def _grouped(nodes: DataFrame, s: Settings) -> DataFrame:
    """Groups of ``fan`` nodes that follow each other, with their centres and radii inside; a group's number is its first node's."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
        centres = np.stack([np.frombuffer(r["centre"]) for r in rows])
        radii = np.array([r["radius"] for r in rows])
        return pa.Table.from_pylist([{
            "dim": rows[0]["dim"], "seq": rows[0]["up"], "node": rows[0]["node"], "centre": rows[0]["centre"],
            "radius": float((distances(centres[:1], centres)[0] + radii).max()), "inner": [r["node"] for r in rows],
            "centres": centres.tobytes(), "radii": radii.tobytes()}], schema=_GROUP)
    up = nodes.select("dim", "seq", "node", "centre", "radius", F.floor(F.col("seq") / s.fan).alias("up"))
    return up.groupBy("dim", "up").applyInArrow(run, _GROUP_DDL)


def _met(pairs: DataFrame, groups: DataFrame, s: Settings) -> DataFrame:
    """Pairs of groups -> pairs of the nodes inside that the bound leaves, each once."""
    left, right = (groups.select(F.col("node").alias(x), F.col("inner").alias(f"in_{x}"), F.col("centres").alias(f"c_{x}"),
                                 F.col("radii").alias(f"r_{x}")) for x in ("a", "b"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                ra, rb = np.frombuffer(r["r_a"]), np.frombuffer(r["r_b"])
                away = distances(np.frombuffer(r["c_a"]).reshape(len(ra), -1), np.frombuffer(r["c_b"]).reshape(len(rb), -1))
                i, j = np.nonzero(away <= s.reach + ra[:, None] + rb + _SLACK)
                x, y = np.array(r["in_a"])[i], np.array(r["in_b"])[j]
                keep = x <= y if r["a"] == r["b"] else np.ones(len(x), bool)
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep])], schema=schema)
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def block_pairs(nodes: DataFrame, s: Settings) -> DataFrame:
    """``(a, b)``: numbers of different blocks whose covering radii may hold a link; ``nodes``: dim, seq, node, centre, radius."""
    levels = []
    while True:
        nodes = cut(_grouped(nodes, s))
        levels.append(nodes)
        if nodes.agg(F.max("seq")).first()[0] == 0:
            break
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for groups in reversed(levels):
        pairs = cut(_met(pairs, groups, s))
    return pairs.where("a <> b")


_OUT = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("n", pa.int64())])
_OUT_DDL = "x long, y long, n long"


def _compare(kind: str, s: Settings) -> Callable[[pa.Table], pa.Table]:
    """One group: a block against some others. Rows: (class, null, links) and (label, label, null)."""
    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("partner").to_numpy())
        rows = (group.slice(int(k), 1).to_pylist()[0] for k in order)  # one block at a time beside the first
        first = next(rows)
        if first["partner"] != -1:
            return _OUT.empty_table()
        mine, total, found = _read(first, kind), np.zeros(first["n"], np.int64), []
        for row in rows:
            other, labels = _read(row, kind), set()

            def merge(i: np.ndarray, j: np.ndarray, other=other, labels=labels) -> None:
                labels.update(zip(*np.unique(np.stack([mine.labels[i], other.labels[j]]), axis=1).tolist(), strict=True))

            links = Links(mine.weights, other.weights, merge, s.held)
            traverse(mine.tree, other.tree, links, s)
            counts, theirs = links.counts()
            total += counts
            hit = np.flatnonzero(theirs)
            found.append((other.classes[hit], np.full(len(hit), -1), theirs[hit]))
            if labels:
                both = np.array(sorted(labels)).T
                found.append((both[0], both[1], np.full(len(labels), -1)))
        hit = np.flatnonzero(total)
        found.append((mine.classes[hit], np.full(len(hit), -1), total[hit]))
        x, y, n = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table([pa.array(x), pa.array(y, mask=y < 0), pa.array(n, mask=n < 0)], schema=_OUT)
    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's own counts and labels."""
    schema = pa.schema([("class", pa.int64()), ("label", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        for columns in zip(*(batch.column(k) for k in range(3)), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(c.as_py(), np.int64)) for c in columns], schema=schema)


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vectors`` (vec_id, embedding) -> vec_id, n_links, component_id, kept."""
    s = settings
    single = vectors.schema["embedding"].dataType.elementType == T.FloatType()
    kind = "<f4" if single else "<f8"
    rows = cut(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        _classed(kind), "vec_id long, h1 long, h2 long, dim int, data binary"))
    classes = cut(rows.where("data IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("data").alias("data"))
        .withColumn("class", F.monotonically_increasing_id()))
    sizes = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row per length of vector
    if not sizes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    placed = reduce(DataFrame.union, (_in_order(classes, dim, sizes[dim], kind, s) for dim in sorted(sizes)))
    blocks = cut(placed.withColumn("block", F.monotonically_increasing_id()))

    pairs = cut(block_pairs(_numbered(blocks), s))
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / s.partners).alias("parts"))
    pairs = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("chunk"))
    data = ["dim", "n", "classes", "weights", "labels", "points", "nodes"]
    held = blocks.select("block", *data)
    mine = pairs.select("a", "chunk").distinct().join(held, F.col("a") == F.col("block")).select(
        "a", "chunk", F.lit(-1).cast("long").alias("partner"), *data)
    theirs = pairs.join(held, F.col("b") == F.col("block")).select("a", "chunk", F.col("b").alias("partner"), *data)
    met = cut(mine.union(theirs).groupBy("a", "chunk").applyInArrow(_compare(kind, s), _OUT_DDL))

    own = cut(blocks.select("classes", "labels", "counts").mapInArrow(_own, "class long, label long, n long"))
    counts = own.select("class", "n").union(met.where("y IS NULL").select("x", "n")).groupBy("class").agg(F.sum("n").alias("n"))
    joined = components(met.where("y IS NOT NULL").select(F.col("x").alias("a"), F.col("y").alias("b")))
    labels = own.select("class", "label").join(joined, F.col("label") == F.col("node"), "left").select(
        "class", F.coalesce("component", "label").alias("group"))
    named = cut(labels.join(classes.select("class", "h1", "h2", "least"), "class").join(counts, "class"))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    known = named.join(least, "group").select("h1", "h2", "n", "component_id")
    out = rows.drop("data", "dim").join(known, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))


def _in_order(classes: DataFrame, dim: int, n: int, kind: str, s: Settings) -> DataFrame:
    """Blocks of the classes of one length, in the order of a tree over a bounded sample of them."""
    classes = classes.where(F.col("dim") == dim)
    size = max(1, min(s.seeds, s.seed_bytes // (8 * dim)))
    sample = [bytes(r["data"]) for r in classes.select("h1", "h2", "data").orderBy("h1", "h2").limit(size).collect()]
    seeds = build(unit_rows(np.frombuffer(b"".join(sample), kind).reshape(-1, dim)), s.leaf).points
    shared = classes.sparkSession.sparkContext.broadcast(seeds)  # at most seed_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("dim", pa.int32()), ("class", pa.int64()), ("weight", pa.int64()), ("data", pa.binary()),
                            ("place", pa.int32())])
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                units = unit_rows(np.frombuffer(b"".join(some.column(3).to_pylist()), kind).reshape(-1, dim))
                place = (units @ shared.value.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(place, pa.int32())], schema=schema)

    parts = -(-n // (_per_block(dim, s) * 4))
    spread = classes.select("dim", "class", F.col("copies").alias("weight"), "data").mapInArrow(
        run, "dim int, class long, weight long, data binary, place int")
    ordered = spread.repartitionByRange(parts, "place", "class").sortWithinPartitions("place", "class")
    return ordered.select("dim", F.spark_partition_id().alias("part"), "class", "weight", "data").mapInArrow(_blocks(kind, s), _BLOCK_DDL)


def _numbered(blocks: DataFrame) -> DataFrame:
    """The blocks as nodes, with their places in the order (from counts per part)."""
    local = F.row_number().over(Window.partitionBy("dim", "part").orderBy("block")) - 1
    bare = blocks.select("dim", "part", F.col("block").alias("node"), "centre", "radius", local.alias("local"))
    sizes = blocks.groupBy("dim", "part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("dim").orderBy("part")) - F.col("size")
    return bare.join(sizes.withColumn("before", before), ["dim", "part"]).select(
        "dim", (F.col("before") + F.col("local")).alias("seq"), "node", "centre", "radius")


ORACLE = """
WITH RECURSIVE every AS (SELECT row_number() OVER () AS row_no, vec_id, embedding FROM embeddings),
sound AS (
  SELECT row_no, vec_id, embedding::DOUBLE[] AS v FROM every
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.row_no AS x, b.row_no AS y, b.vec_id
  FROM sound a JOIN sound b ON a.row_no <> b.row_no AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(x, y) AS (
  SELECT row_no, row_no FROM sound UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT r.x, min(s.vec_id) AS component_id FROM reach r JOIN sound s ON s.row_no = r.y GROUP BY r.x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, CASE WHEN l.x IS NULL THEN e.vec_id ELSE l.component_id END AS component_id,
       coalesce(CASE WHEN l.x IS NULL THEN e.vec_id ELSE l.component_id END = e.vec_id, FALSE) AS kept
FROM every e LEFT JOIN least l ON l.x = e.row_no LEFT JOIN counted c ON c.x = e.row_no
"""
