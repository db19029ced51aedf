"""Repair of conversation structure at least cost, by a Viterbi search that runs in parallel chunks.

The roles of a repaired conversation, by their initials, read ``(s?(ua)+)?``. A
turn may be kept (free), given the role user or assistant (3) or deleted (4); an
empty user or assistant turn may be inserted anywhere (3). Blank turns and
repeats must go; a truncated turn that stays costs 3 more. Of the cheapest lists
of edits the one whose initials (D, I, K, R) sort first is taken.

The turns of all conversations are put into one global order and cut into
chunks, so that a conversation of any length is many rows. Each chunk holds one
letter per turn. The least cost to the end, per state of the role grammar, is a
vector of four numbers that is worked out backwards:

* chunks that are not the last of their conversation start from speculative
  vectors; a run from another vector stops where its vectors differ from the
  first run's by a constant only, as from there on all of them do;
* start vectors that no chunk has started from yet are the speculative vectors
  of the next fix-up pass, until a pass brings no new ones. As insertions tie the
  four costs together, there are few vectors up to a constant, so the number of
  passes does not depend on a conversation's length;
* the chunks of a conversation are stitched from the last to the first, and
  their states from the first to the last, over one small row per chunk; the
  edits are then traced in all chunks at the same time.

Turns are ordered by turn (nulls first); ties by role, then by the first 64
characters of the text, then by its MD5.

Defined results: a null conv_id is a conversation of its own; null roles and
texts are read as one space, so such a text is blank. A role counts by its first
character; an empty one or any other initial fits nowhere and is rewritten or
deleted. Equal rows are repeats of each other. Inserted turns have no turn
number. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, record_batches, to_bytes

BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
_NEVER = 1 << 40

# States of the grammar: 0 nothing yet, 1 after s, 2 after u, 3 after a (0 and 3 may end).
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_FREE = (2, 2, 3, 2)  # where a user or assistant turn leads, whichever of the two fits
_NAMES = {2: "u", 3: "a"}
_INITIALS = "sua-"
_FAULTS = ("sound", "blank", "duplicate", "truncated")
#: One letter per turn: A-D sound with initial s, u, a or other, E-H blank, I-L duplicate, M-P truncated.
_LETTERS = {chr(65 + 4 * f + i): (_INITIALS[i], _FAULTS[f]) for f in range(4) for i in range(4)}


@dataclass(frozen=True)
class Settings:
    chunk: int = 1024  # turns


Vector = tuple[int, ...]


def settled(costs: list[int]) -> list[int]:
    """Costs to the end where turns may be inserted first."""
    out = list(costs)
    for _ in range(3):
        out = [min(c, INSERT + out[_FREE[k]]) for k, c in enumerate(out)]
    return out


END: Vector = tuple(settled([0, _NEVER, _NEVER, 0]))


class Machine:
    """Cost vectors up to a constant, as the states of an automaton over turn letters that is built as it is needed."""

    def __init__(self, vectors: list[Vector] | None = None) -> None:
        self.vectors, self.numbers, self.moves = [], {}, {}
        for v in vectors or [END]:
            self.number(v)

    def number(self, vector: Vector) -> int:
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.numbers[vector]

    def back(self, at: int, letter: str) -> tuple[int, int]:
        """The vector before a turn, given the one after it: its number and the constant."""
        move = self.moves.get((at, letter))
        if move is None:
            after, (initial, fault) = self.vectors[at], _LETTERS[letter]
            costs = [DELETE + c for c in after]
            if fault in ("sound", "truncated"):
                more = CUT_SHORT if fault == "truncated" else 0
                for k in range(4):
                    costs[k] = min(costs[k], more + REROLE + after[_FREE[k]])
                    if initial in _NEXT[k]:
                        costs[k] = min(costs[k], more + after[_NEXT[k][initial]])
            costs = settled(costs)
            least = min(costs)
            move = self.moves[at, letter] = self.number(tuple(c - least for c in costs)), least
        return move

    def run(self, letters: str, at: int) -> list[int]:
        """The vector numbers at every place of a chunk, from its start to its end."""
        path = [at]
        for letter in reversed(letters):
            at = self.back(at, letter)[0]
            path.append(at)
        path.reverse()
        return path

    def starts(self, letters: str, ends: list[int]) -> list[int]:
        """The start vector for each of the end vectors; runs stop where they meet the first run."""
        first = self.run(letters, ends[0])
        out = [first[0]]
        for at in ends[1:]:
            for k in range(len(letters), 0, -1):
                if at == first[k]:
                    at = first[0]
                    break
                at = self.back(at, letters[k - 1])[0]
            out.append(at)
        return out

    def trace(self, letters: str, path: list[int], state: int, last: bool) -> tuple[int, list[str]]:
        """The state after a chunk and the edits of each of its turns.

        Edits: D deleted, K kept, U and A given that role; u and a inserted before the turn (or after the last one).
        """
        edits = []
        for k, letter in enumerate(letters):
            (initial, fault), here, after = _LETTERS[letter], self.vectors[path[k]], self.vectors[path[k + 1]]
            more, less = (CUT_SHORT if fault == "truncated" else 0), self.back(path[k + 1], letter)[1]
            made = ""
            while True:
                cost = here[state] + less
                if cost == DELETE + after[state]:
                    edits.append(made + "D")
                    break
                if cost == INSERT + less + here[_FREE[state]]:
                    state = _FREE[state]
                    made += _NAMES[state]
                    continue
                if initial in _NEXT[state] and fault in ("sound", "truncated") and cost == more + after[_NEXT[state][initial]]:
                    state = _NEXT[state][initial]
                    edits.append(made + "K")
                else:
                    state = _FREE[state]
                    edits.append(made + _NAMES[state].upper())
                break
        if last and letters:
            while END[state]:
                state = _FREE[state]
                edits[-1] += _NAMES[state]
        return state, edits


def measures(letters: str, edits: list[str], before: str) -> tuple[int, int, int, int, int]:
    """Blank, duplicate, truncated, illegal (with the turn before the chunk) and cost of a chunk."""
    faults = [_LETTERS[x][1] for x in letters]
    initials = before + "".join(_LETTERS[x][0] for x in letters)
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost = 0
    for fault, made in zip(faults, edits, strict=True):
        own = next(c for c in made if c in "DKUA")
        cost += INSERT * (len(made) - 1) + {"D": DELETE, "K": 0}.get(own, REROLE)
        cost += CUT_SHORT if fault == "truncated" and own != "D" else 0
    return faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost


# -- turns in global order, chunks of letters ------------------------------------------------------

def conversation_key(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def ordered_turns(rows: DataFrame) -> DataFrame:
    """``key, conv_id, turn, role, text, at``: the turns, written in order; ``at`` grows along it, without gaps in a file."""
    base = rows.select(
        conversation_key(F.col("conv_id")).alias("key"), "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("salt"))  # equal rows may part anywhere
    order = ["key", "turn", "role", F.substring("text", 1, 64), F.md5("text"), "salt"]
    return cut(base.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
               .withColumn("at", F.monotonically_increasing_id()))


def lettered(turns: DataFrame, s: Settings) -> DataFrame:
    """``key, chunk, at, letter`` for each turn."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = turns.select("key", "at", F.col("role"), F.md5("text").alias("h"), (trimmed == "").alias("blank"),
                        F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("whole"))
    first = rows.groupBy("key", "role", "h").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(first, ["key", "role", "h"], "left")
    fault = (F.when(F.col("blank"), 1).when(F.col("at") > F.col("first"), 2).when(~F.col("whole"), 3).otherwise(0))
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return rows.select("key", chunk_of(s).alias("chunk"), "at", F.char((F.lit(65) + fault * 4 + place).cast("long")).alias("letter"))


def chunk_of(s: Settings) -> Column:
    """The chunk of the turn at ``at``: the file's number and the place in the file divided by the size of a chunk."""
    local = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return F.col("at") - local + F.floor(local / s.chunk)


def chunks_of(turns: DataFrame, s: Settings) -> DataFrame:
    """``key, chunk, start, letters, first, last``: a row per chunk of a conversation."""
    packed = lettered(turns, s).groupBy("key", "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "letter"))).alias("all"))
    along = Window.partitionBy("key").orderBy("chunk")
    return cut(packed.select("key", "chunk", F.col("all")[0]["at"].alias("start"), F.array_join("all.letter", "").alias("letters"))
               .withColumn("first", F.lag("chunk").over(along).isNull()).withColumn("last", F.lead("chunk").over(along).isNull()))


# -- passes --------------------------------------------------------------------------------------------

_EDITS = pa.schema([("key", pa.string()), ("chunk", pa.int64()), ("start", pa.int64()), ("edits", pa.list_(pa.string())),
                    *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost"))])
_EDITS_DDL = "key string, chunk long, start long, edits array<string>, blank long, duplicate long, truncated long, illegal long, cost long"


def _mapped(df: DataFrame, row: Callable[[dict], tuple], schema: pa.Schema, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return record_batches((row(r) for b in batches for r in b.to_pylist()), schema)
    return df.mapInArrow(run, ddl)


def _whole(chunks: DataFrame) -> DataFrame:
    """The edits of conversations that are one chunk."""
    machine = Machine()

    def row(r: dict) -> tuple:
        _, edits = machine.trace(r["letters"], machine.run(r["letters"], 0), 0, True)
        return (r["key"], r["chunk"], r["start"], edits, *measures(r["letters"], edits, ""))
    return _mapped(chunks, row, _EDITS, _EDITS_DDL)


def speculate(chunks: DataFrame) -> list[Vector]:
    """Every vector that a chunk may have to start from: passes from new vectors until there are none."""
    known, fresh = [END], [END]
    schema = pa.schema([("vector", pa.list_(pa.int32()))])
    while fresh:
        def run(batches: Iterator[pa.RecordBatch], fresh=tuple(fresh)) -> Iterator[pa.RecordBatch]:
            machine, seen = Machine(list(fresh)), set()
            for batch in batches:
                for letters, last in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ends = list(range(len(fresh)))
                    if last:
                        ends = [machine.numbers[END]] if END in fresh else []
                    if ends:
                        seen.update(machine.starts(letters, ends))
            yield from record_batches(((list(machine.vectors[k]),) for k in sorted(seen)), schema)

        found = chunks.where("NOT first").select("letters", "last").mapInArrow(run, "vector array<int>").distinct()
        fresh = sorted({tuple(r.vector) for r in found.collect()} - set(known))  # few: the costs are at most 9 apart
        known += fresh
    return known


def _folded(rows: DataFrame, step: Callable[[dict, dict], tuple], schema: pa.Schema, ddl: str, backwards: bool) -> DataFrame:
    """Rows of a conversation one after the other; ``step`` gets the row and what it keeps of the rows before."""
    order = F.col("chunk").desc() if backwards else F.col("chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            key, held = None, {}
            for batch in batches:
                for r in batch.to_pylist():
                    if r["key"] != key:
                        key, held = r["key"], {}
                    yield step(r, held)
        return record_batches(made(), schema)
    return rows.repartition("key").sortWithinPartitions("key", order).mapInArrow(run, ddl)


def _stitched(chunks: DataFrame) -> DataFrame:
    """The edits of conversations of several chunks."""
    vectors = speculate(chunks)

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(vectors)

        def row(r: dict) -> tuple:
            starts = machine.starts(r["letters"], [0] if r["last"] else list(range(len(vectors))))
            return r["key"], r["chunk"], r["last"], starts
        return record_batches((row(r) for b in batches for r in b.to_pylist()), pa.schema(
            [("key", pa.string()), ("chunk", pa.int64()), ("last", pa.bool_()), ("starts", pa.list_(pa.int32()))]))

    def backward(r: dict, held: dict) -> tuple:
        end = 0 if r["last"] else held["start"]
        held["start"] = r["starts"][end]
        return r["key"], r["chunk"], end

    ends = _folded(chunks.mapInArrow(maps, "key string, chunk long, last boolean, starts array<int>"), backward,
                   pa.schema([("key", pa.string()), ("chunk", pa.int64()), ("end", pa.int32())]),
                   "key string, chunk long, end int", backwards=True)
    chunks = cut(chunks.join(ends, ["key", "chunk"]))

    def states(r: dict) -> tuple:
        machine = Machine(vectors)
        path = machine.run(r["letters"], r["end"])
        after = [machine.trace(r["letters"], path, k, False)[0] for k in ([0] if r["first"] else range(4))]
        return r["key"], r["chunk"], after, _LETTERS[r["letters"][-1]][0]

    def forward(r: dict, held: dict) -> tuple:
        state, before = held.get("state", 0), held.get("before", "")
        held["state"], held["before"] = r["after"][state], r["before"]
        return r["key"], r["chunk"], state, before

    passed = _mapped(chunks.select("key", "chunk", "first", "end", "letters"), states, pa.schema(
        [("key", pa.string()), ("chunk", pa.int64()), ("after", pa.list_(pa.int32())), ("before", pa.string())]),
        "key string, chunk long, after array<int>, before string")
    begins = _folded(passed, forward, pa.schema([("key", pa.string()), ("chunk", pa.int64()), ("state", pa.int32()), ("before", pa.string())]),
                     "key string, chunk long, state int, before string", backwards=False)

    def row(r: dict) -> tuple:
        machine = Machine(vectors)
        _, edits = machine.trace(r["letters"], machine.run(r["letters"], r["end"]), r["state"], r["last"])
        return (r["key"], r["chunk"], r["start"], edits, *measures(r["letters"], edits, r["before"]))
    return _mapped(chunks.join(begins, ["key", "chunk"]), row, _EDITS, _EDITS_DDL)


@dataclass
class Repaired:
    """``turns``: the turns in order; ``edits``: a row per chunk with its turns' edits and counts."""
    turns: DataFrame
    edits: DataFrame
    settings: Settings

    def rows(self) -> DataFrame:
        """The repaired conversations: ``key, conv_id, turn, role, text, edit, at, place``, ordered by at and place."""
        edits = self.edits.select("key", "chunk", "start", "edits")
        placed = self.turns.withColumn("chunk", chunk_of(self.settings)).join(edits, ["key", "chunk"])
        own = F.element_at("edits", (F.col("at") - F.col("start") + 1).cast("int"))
        out = placed.select("key", "conv_id", "turn", "role", "text", "at", F.posexplode(F.split(own, "")).alias("place", "code"))
        made = F.col("code").isin("u", "a")
        return out.where("code <> 'D'").select(
            "key", "conv_id", F.when(~made, F.col("turn")).alias("turn"),
            F.when(F.lower("code") == "u", "user").when(F.lower("code") == "a", "assistant").otherwise(F.col("role")).alias("role"),
            F.when(made, "").otherwise(F.col("text")).alias("text"),
            F.when(made, "I").when(F.col("code") == "K", "K").otherwise("R").alias("edit"), "at", "place")


def repair(rows: DataFrame, settings: Settings = Settings()) -> Repaired:
    """``rows`` (conv_id, turn, role, text) repaired."""
    turns = ordered_turns(rows)
    chunks = chunks_of(turns, settings)
    done = _whole(chunks.where("first AND last")).union(_stitched(cut(chunks.where("NOT (first AND last)"))))
    return Repaired(turns, cut(done), settings)


# -- the query -----------------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of [.!?], repeated or made user turns, by a checksum of ``conv_id:turn``."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    rows = rows.where("kind <> 0").withColumn(
        "text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")


def digests(repaired: DataFrame) -> DataFrame:
    """``key, repaired_sha256``: the turns of each conversation as ``role:text`` lines, read in order as a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            key, state = None, None
            for batch in batches:
                for k, role, text in zip(*(batch.column(c) for c in range(3)), strict=True):
                    k = k.as_py()
                    if k != key:
                        if state:
                            yield key, state.hexdigest()
                        key, state = k, hashlib.sha256()
                    else:
                        state.update(b"\n")
                    state.update(to_bytes(f"{role.as_py()}:"))
                    state.update(to_bytes(text.as_py()))
            if state:
                yield key, state.hexdigest()
        return record_batches(made(), pa.schema([("key", pa.string()), ("repaired_sha256", pa.string())]))
    ordered = repaired.select("key", "role", "text", "at", "place").repartition("key").sortWithinPartitions("key", "at", "place")
    return ordered.select("key", "role", "text").mapInArrow(run, "key string, repaired_sha256 string")


def repair_damaged(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row per original conversation: faults after damage, cost and initials of the cheapest edits, digest of the result."""
    done = repair(damage(conversations), settings)
    counts = done.edits.groupBy("key").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.array_sort(F.collect_list(F.struct("chunk", F.array_join("edits", "").alias("made")))).alias("parts"))
    counts = counts.withColumn("audit", F.translate(F.array_join("parts.made", ""), "uaUA", "IIRR")).drop("parts")
    turns = done.turns.groupBy("key", "turn").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.expr("cast(max(turn) as decimal(38,0)) - cast(min(turn) as decimal(38,0)) + 1 - count(turn)").alias("gaps"))
    whole = conversations.select("conv_id").distinct().withColumn("key", conversation_key(F.col("conv_id")))
    every = whole.join(turns, "key", "left").join(counts, "key", "left").join(digests(done.rows()), "key", "left")
    return every.select(
        "conv_id", F.coalesce(F.expr("try_cast(gaps AS bigint)"), F.lit(0).cast("long")).alias("gaps"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
