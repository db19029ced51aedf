"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact check.

1. Every text becomes a set of word shingles, a MinHash signature and band
   keys. Texts with equal sets form one class, represented by its smallest
   doc_id; only representatives go on, so groups of copies cost one row each.
2. Classes that share a band key are candidates. They are not paired with each
   other: each bucket's pivot is compared with its members (a star). In buckets
   that still hold several components, the members outside the largest one are
   compared with the rest, block against block: first only the most similar
   ones are followed up, which joins most of them, at last all that agree, so
   that no pair of different components that share a bucket is left out.
3. A candidate's signatures are compared batch by batch; it is dropped as soon
   as the posterior probability of a similarity at or above the threshold,
   given the matches so far and a uniform prior, falls below ``miss``.
4. Survivors are confirmed on the full shingle sets.

Defined results: a text without words has an empty set and is linked with
nothing; a row without doc_id is linked with nothing, its component_id is null
and it is kept; rows that share a doc_id count as one document. Other columns
are ignored. A link at the threshold itself shares no band with probability
``(1 - s**rows) ** bands``: 6e-7 for 36 bands of 5 at 0.8, 7e-7 for 30 of 6 at 0.85.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, record_batches, word_hashes
from .graph import components


@dataclass(frozen=True)
class Settings:
    shingle: int = 5          # words
    percent: int = 80         # linked if 100 * intersection >= percent * union
    bands: int = 36
    rows: int = 5             # hashes in a band
    batch: int = 30           # hashes compared at a time
    miss: float = 1e-6        # posterior probability below which a candidate goes
    nearest: int = 2          # most similar members of a block checked per unsettled member
    block: int = 512          # unsettled members in a block; twice as many on the other side
    block_shingles: int = 1 << 21  # and shingles of theirs, about
    partners: int = 256       # texts checked against one copy of a pivot's text

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles (the whole text if shorter)."""
    words = word_hashes(text)
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    h = words[: n - width + 1] + np.uint64(width)
    for j in range(1, width):
        h = mix(h) + words[j: n - width + 1 + j]
    return np.unique(mix(h))


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_011)
    return (rng.integers(0, 1 << 32, (count, 1), dtype=np.uint32),
            rng.integers(0, 1 << 31, (count, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1))


def signature(shingles: np.ndarray, seeds: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """MinHash values of a set; bounded work space for sets of any size."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(seeds), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, ((x[i:i + 512] ^ seeds) * odds).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    keys = mix(np.arange(1, bands + 1, dtype=np.uint64))
    for column in least.reshape(bands, -1).T:
        keys = mix(keys ^ column)
    return keys.view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()),
                     ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, n_shingles, set1, set2, sig, bands`` per row; the last four are null for empty sets."""
    seeds, odds = _permutations(s.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    found = shingle_set(text.as_py(), s.shingle)
                    if not len(found):
                        yield doc_id, 0, None, None, None, None
                        continue
                    least = signature(found, seeds, odds)
                    one, two = np.frombuffer(hashlib.blake2b(found, digest_size=16).digest(), np.int64)
                    short = (least ^ (least >> np.uint32(16))).astype(np.uint16)
                    yield doc_id, len(found), int(one), int(two), short.tobytes(), band_keys(least, s.bands)
        return record_batches(rows(), _SIGNED)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, set1 long, set2 long, sig binary, bands array<long>")


def least_matches(hashes: int, batch: int, threshold: float, miss: float) -> list[int]:
    """After 1, 2, ... batches: the fewest matches at which P(similarity >= threshold) >= miss.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1),
    whose upper tail at t is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
        out.append(m)
    return out


def survivors(left: np.ndarray, right: np.ndarray, batch: int, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the signature pairs that no batch rules out, and their numbers of equal hashes."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for i, needed in enumerate(least):
        part = slice(i * batch, (i + 1) * batch)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        alive, matches = alive[matches >= needed], matches[matches >= needed]
        if not len(alive):
            break
    return alive, matches


def _matrix(column: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, hashes)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def prune(pairs: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """Candidate pairs ``(a, b)`` that sequential verification of the signatures leaves."""
    least = least_matches(s.hashes, s.batch, s.percent / 100, s.miss)
    sides = [reps.select(F.col("cid").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
             for c in "ab"]
    joined = pairs.join(sides[1], "b").join(sides[0], "a").where(
        100 * F.least("n_a", "n_b") >= s.percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept, _ = survivors(_matrix(batch.column(2), s.hashes), _matrix(batch.column(3), s.hashes), s.batch, least)
                yield batch.select(["a", "b"]).take(pa.array(kept))

    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold.

    A pivot ``a`` may have any number of partners: they are dealt into blocks,
    each with one copy of the pivot's text, and streamed through a task that
    holds one pivot's set at a time.
    """
    pairs = cut(pairs.distinct())
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / s.partners).cast("int").alias("n"))
    dealt = pairs.join(blocks, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("n")).cast("int"))
    partners = dealt.join(texts, dealt.b == texts.doc_id).select("a", "block", F.lit(1).alias("kind"), "b", "text")
    pivots = blocks.select("a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block")).join(
        texts, F.col("a") == texts.doc_id).select("a", "block", F.lit(0).alias("kind"), F.col("a").alias("b"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            at, sets = None, {}
            for batch in batches:
                heads = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
                for (a, block, kind, b), text in zip(heads, batch.column(4), strict=True):
                    if (a, block) != at:
                        at, sets = (a, block), {}
                    found = shingle_set(text.as_py(), s.shingle)
                    if kind == 0:
                        sets[found.tobytes()] = found
                        continue
                    for other in sets.values():
                        shared = len(np.intersect1d(found, other, assume_unique=True))
                        if 100 * shared >= s.percent * (len(found) + len(other) - shared):
                            yield a, b
                            break
        return record_batches(rows(), _PAIR)

    together = pivots.union(partners)
    return together.repartition("a", "block").sortWithinPartitions("a", "block", "kind").mapInArrow(run, "a long, b long")


def _with_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "label", F.coalesce("component", "cid")).drop("component")


def _unsettled(members: DataFrame) -> DataFrame:
    """Buckets with several components: ``key, main, settled, apart`` (sizes of the largest and the rest)."""
    sizes = members.groupBy("key", "label").agg(F.count("*").alias("n"))
    return sizes.groupBy("key").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("labels")
    ).where("labels > 1").select("key", F.col("top.label").alias("main"), F.col("top.n").alias("settled"),
                                 (F.col("all") - F.col("top.n")).alias("apart"))


def _in_blocks(rows: DataFrame, u_blocks: Column, m_blocks: Column, columns: list[str]) -> DataFrame:
    """Unsettled rows (kind 0) in blocks before all rows (kind 1) in blocks, for every two blocks of a bucket."""
    rows = rows.withColumn("us", F.ceil(u_blocks).cast("int")).withColumn("ms", F.ceil(m_blocks).cast("int"))

    def side(kind, own, others, n_own, n_others):
        return rows.withColumn(own, F.pmod(F.xxhash64("cid"), F.col(n_own)).cast("int")).withColumn(
            others, F.explode(F.sequence(F.lit(0), F.col(n_others) - 1))).withColumn("kind", F.lit(kind))

    cols = ["key", "u", "m", "kind", "cid", "label", "apart_", *columns]
    both = side(0, "u", "m", "us", "ms").where("apart_").select(cols).union(side(1, "m", "u", "ms", "us").select(cols))
    return both.repartition("key", "u", "m").sortWithinPartitions("key", "u", "m", "kind")


def _block_pairs(members: DataFrame, open_buckets: DataFrame, reps: DataFrame, s: Settings, flag: bool) -> DataFrame:
    """Members of one bucket in different components whose signatures agree: pairs, or flagged members.

    The members outside the bucket's largest component, in blocks, against all
    members, in blocks. For an unsettled member only its most similar partners
    of a block are written as pairs ``a, b``. With ``flag`` no pairs are
    written but ``key, cid`` of every member that has a partner.
    """
    least = least_matches(s.hashes, s.batch, s.percent / 100, s.miss)
    rows = members.join(open_buckets, "key").join(reps.select("cid", "sig"), "cid").withColumn(
        "apart_", F.col("label") != F.col("main"))
    both = _in_blocks(rows, F.col("apart") / s.block, (F.col("apart") + F.col("settled")) / (2 * s.block), ["sig"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            at, held, block, near = None, [], None, {}
            for batch in batches:
                for key, u, m, kind, cid, label, apart, sig in zip(
                        *(c.to_pylist() for c in batch.columns), strict=True):
                    if (key, u, m) != at:
                        yield from written(at, near)
                        at, held, block, near = (key, u, m), [], None, {}
                    if kind == 0:
                        held.append((cid, label, sig))
                        continue
                    if not held:
                        continue
                    if block is None:
                        block = (np.array([x[0] for x in held]), np.array([x[1] for x in held]),
                                 np.frombuffer(b"".join(x[2] for x in held), np.uint16).reshape(-1, s.hashes))
                    ids, labels, sigs = block
                    todo = np.flatnonzero((labels != label) & ((ids < cid) | (not apart)))
                    if not len(todo):
                        continue
                    own = np.broadcast_to(np.frombuffer(sig, np.uint16), (len(todo), s.hashes))
                    kept, equal = survivors(sigs[todo], own, s.batch, least)
                    if flag and len(kept):
                        near[cid] = ()
                    for other, n in zip(ids[todo[kept]].tolist(), equal.tolist(), strict=True):
                        best = near.setdefault(other, [])
                        if flag:
                            continue
                        if len(best) < s.nearest:
                            heapq.heappush(best, (n, cid))
                        else:
                            heapq.heappushpop(best, (n, cid))
            yield from written(at, near)

        def written(at, near):
            for cid, best in near.items():
                if flag:
                    yield at[0], cid
                for _, other in best:
                    yield min(cid, other), max(cid, other)

        return record_batches(rows(), _PAIR)

    return both.mapInArrow(run, "a long, b long")


def _block_links(members: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Exact links ``a, b`` among the members of one bucket that are in different components.

    Blocks as in _block_pairs, with the full shingle sets. A block's unsettled
    sets lie in one sorted array, in which a member's shingles are looked up
    once to get its intersections with all of them. One link of an unsettled
    member to a component is enough.
    """
    schema = pa.schema([("cid", pa.int64()), ("set", pa.binary()), ("size", pa.int64())])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for cid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    found = shingle_set(text.as_py(), s.shingle)
                    yield cid, found.tobytes(), len(found)
        return record_batches(rows(), schema, 256)

    sets = texts.join(members.select(F.col("cid").alias("doc_id")).distinct(), "doc_id", "left_semi").select(
        "doc_id", "text").mapInArrow(shingled, "cid long, set binary, size long")
    rows = members.join(cut(_unsettled(members)), "key").join(cut(sets), "cid").withColumn(
        "apart_", F.col("label") != F.col("main"))
    sizes = cut(rows.groupBy("key").agg(F.sum(F.when(F.col("apart_"), F.col("size"))).alias("shingles")))
    rows = rows.join(sizes, "key")
    both = _in_blocks(rows, F.greatest(F.col("apart") / s.block, F.col("shingles") / s.block_shingles),
                      (F.col("apart") + F.col("settled")) / (2 * s.block), ["set"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            at, held, block = None, [], None
            for batch in batches:
                heads = [batch.column(i).to_pylist() for i in range(7)]
                for key, u, m, kind, cid, label, apart, packed in zip(*heads, batch.column(7), strict=True):
                    own = np.frombuffer(packed.as_py(), np.uint64)
                    if (key, u, m) != at:
                        at, held, block = (key, u, m), [], None
                    if kind == 0:
                        held.append((cid, label, own))
                        continue
                    if not held:
                        continue
                    if block is None:
                        block, done = _SetBlock(held), set()
                    shared = block.shared(own)
                    near = 100 * shared >= s.percent * (block.sizes + len(own) - shared)
                    near &= (block.labels != label) & ((block.ids < cid) | (not apart))
                    for i in np.flatnonzero(near).tolist():
                        if (i, label) not in done:
                            done.add((i, label))
                            other = int(block.ids[i])
                            yield min(cid, other), max(cid, other)
        return record_batches(rows(), _PAIR)

    return both.mapInArrow(run, "a long, b long").distinct()


class _SetBlock:
    def __init__(self, held: list[tuple[int, int, np.ndarray]]):
        self.ids = np.array([x[0] for x in held])
        self.labels = np.array([x[1] for x in held])
        self.sizes = np.array([len(x[2]) for x in held])
        values = np.concatenate([x[2] for x in held])
        order = np.argsort(values)
        self.owners = np.repeat(np.arange(len(held)), self.sizes)[order]
        self.values, self.starts, self.counts = np.unique(values[order], return_index=True, return_counts=True)

    def shared(self, own: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of a set with every set of the block."""
        at = np.minimum(np.searchsorted(self.values, own), len(self.values) - 1)
        at = at[self.values[at] == own]
        n = self.counts[at]
        places = np.repeat(self.starts[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else n
        return np.bincount(self.owners[places], minlength=len(self.ids))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    component_id is the smallest doc_id reachable over links, kept marks it.
    """
    s = settings
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = cut(signatures(docs, s))
    reps = signed.where("doc_id is not null and set1 is not null").groupBy("set1", "set2").agg(
        F.min("doc_id").alias("cid"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"),
        F.first("bands").alias("bands"))
    reps = cut(reps)
    keyed = reps.select("cid", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("cid").alias("pivot"), F.max("cid").alias("last")).where("pivot < last")
    members = cut(keyed.join(buckets.select("key", "pivot"), "key").distinct())
    texts = cut(docs.join(members.select(F.col("cid").alias("doc_id")).distinct(), "doc_id", "left_semi"))

    stars = members.where("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
    links = cut(confirm(prune(stars, reps, s), texts, s))
    labels = cut(components(links))
    members = members.where("cid <> pivot").select("key", "cid")  # a pivot has met all of its bucket
    for last in (False, True):
        labelled = cut(_with_labels(members, labels))
        open_buckets = cut(_unsettled(labelled))
        if open_buckets.isEmpty():
            break
        found = cut(_block_pairs(labelled, open_buckets, reps, s, flag=last).distinct())
        if last:
            flagged = cut(labelled.join(found.toDF("key", "cid"), ["key", "cid"], "left_semi"))
            found = _block_links(flagged, texts, s)
        else:
            found = confirm(found, texts, s)
        links = cut(links.union(found))
        labels = cut(components(links))

    classes = reps.select("set1", "set2", "cid").join(labels, F.col("cid") == F.col("node"), "left").select(
        "set1", "set2", F.coalesce("component", "cid").alias("component"))
    out = signed.select("doc_id", "n_shingles", "set1", "set2").join(classes, ["set1", "set2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    return out.select("doc_id", "n_shingles", component).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the row of its smallest doc_id.

    Rows without doc_id stay. Of several rows with one doc_id the one with the
    smallest hash stays. All columns are returned unchanged.
    """
    decided = near_duplicates(docs, settings).where("doc_id is not null and kept").select(
        F.col("doc_id").alias("kept_id")).distinct()
    named = docs.where(docs["doc_id"].isNotNull())
    named = named.join(decided, named["doc_id"].cast("long") == decided["kept_id"], "left_semi")
    order = F.struct(F.xxhash64(named["text"]), F.xxhash64(*(named[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString())))
    one = named.groupBy(named["doc_id"].alias("key_")).agg(
        F.min_by(F.struct(*(named[c] for c in docs.columns)), order).alias("row_")).select("row_.*")
    return one.union(docs.where(docs["doc_id"].isNull()))
