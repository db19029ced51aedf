"""Winnowed document fingerprints in column expressions.

Units are the runs of up to ``unit`` characters without white space and the
single characters of longer runs, lower-cased, so that a unit does not depend
on where it stands and unspaced text is matched as well. Every run of ``k`` units is
hashed; of each window of ``window`` consecutive hashes the least is kept, the
rightmost of equal ones. Two texts that share ``window + k - 1`` units in a
row share a fingerprint entry; positions are kept, so the match can be placed.

A hash (33 bits) and its position (30 bits) are packed into one long, the
position counted downwards, so that ``array_min`` breaks ties to the right.
A text has fewer than 2**30 units, as an array of longs is limited to 2 GB.

Defined results: null text counts as empty; an empty text has an empty
fingerprint; a text of fewer than k units has one entry; two empty
fingerprints have likeness 1, an empty and a non-empty one 0. Repeated rows
get equal results. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, settled

_PLACE_BITS = 30
_PLACES = (1 << _PLACE_BITS) - 1
_HASHES = (1 << 33) - 1


@dataclass(frozen=True)
class Settings:
    k: int = 5
    window: int = 4
    unit: int = 12


def with_fingerprint(df: DataFrame, text: str, out: str, s: Settings = Settings()) -> DataFrame:
    """``df`` plus the packed fingerprint (array of long) of column ``text`` as column ``out``."""
    run = r"[^\x20\x09-\x0D]"
    units = F.regexp_extract_all(F.lower(text), F.lit(rf"(?<!{run}){run}{{1,{s.unit}}}+(?!{run})|{run}"), F.lit(0))
    df = df.withColumn(out, F.transform(units, lambda u: F.xxhash64(u)))
    none = F.array().cast("array<bigint>")

    def runs(size, step):
        return F.when(F.size(out) > 0, F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(out) - (size - 1), F.lit(1))), step)).otherwise(none)

    df = df.withColumn(out, runs(s.k, lambda i: F.shiftleft(
        F.xxhash64(F.slice(out, i, s.k)).bitwiseAND(F.lit(_HASHES)), _PLACE_BITS) + (F.lit(_PLACES) - i)))
    return df.withColumn(out, settled(F.array_distinct(runs(s.window, lambda i: F.array_min(F.slice(out, i, s.window))))))


def hashes(fingerprint: str) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, _PLACE_BITS)))


def written(fingerprint: str) -> Column:
    """``hash@unit position`` entries, comma-separated."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(
        F.hex(F.shiftright(x, _PLACE_BITS)), F.lit("@"),
        (F.lit(_PLACES - 1) - x.bitwiseAND(F.lit(_PLACES))).cast("string"))), ",")


def likeness(a: str, b: str) -> Column:
    """Shared share of two hash sets (Jaccard)."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(1.0))


def successors(ids: DataFrame, shifts: tuple[int, ...] = (8, 12, 14, 14)) -> DataFrame:
    """``(id)`` distinct longs -> ``(id, next)``, ascending, the last followed by the first.

    Ids are sorted inside buckets of equal high bits; only the last id of a
    bucket looks up the next bucket, found in the same way from the far fewer
    bucket numbers. After the shifts at most 2**16 numbers are left for one sort.
    """
    if not shifts:
        w = Window.orderBy("id")
        return ids.select("id", F.coalesce(F.lead("id").over(w), F.first("id").over(
            w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    ids = cut(ids.withColumn("bucket", F.shiftright("id", shifts[0])))
    firsts = cut(ids.groupBy("bucket").agg(F.min("id").alias("entry")))
    after = successors(firsts.select(F.col("bucket").alias("id")), shifts[1:])
    entries = after.join(firsts, after["next"] == firsts["bucket"]).select(F.col("id").alias("bucket"), "entry")
    inside = ids.withColumn("next", F.lead("id").over(Window.partitionBy("bucket").orderBy("id")))
    return inside.join(entries, "bucket").select("id", F.coalesce("next", "entry").alias("next"))


def compare_with_edits(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text swaps the last floor(n / 2) code points for as many (or
    all) first ones of the next document's. A row without doc_id has no next
    document (an empty text is used) and is nobody's next; of rows that share a
    doc_id the smallest text counts as the next document.
    """
    # an id that is long already stays as it is: a renamed one would hide that both sides are dealt out alike
    doc_id = docs["doc_id"] if dict(docs.dtypes)["doc_id"] == "bigint" else docs["doc_id"].cast("long").alias("doc_id")
    docs = docs.select(doc_id, F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    named = docs.where("doc_id is not null")  # read and dealt out by doc_id once, for both sides
    order = cut(successors(named.select(F.col("doc_id").alias("id")).distinct()))
    ranked = named.withColumn("rank_", F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
    following = ranked.where(settled(F.col("rank_")) == 1).select("doc_id", "text").join(
        order, F.col("doc_id") == F.col("next")).select(F.col("id").alias("at_"), F.col("text").alias("next_text"))
    paired = named.join(following, named["doc_id"] == following["at_"], "left").select("doc_id", "text", "next_text")
    df = paired.union(docs.where("doc_id is null").select("doc_id", "text", F.lit("")))
    df = df.withColumn("next_text", F.coalesce("next_text", F.lit("")))
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    df = df.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)))
    for text, out in (("text", "own_"), ("edited", "edited_"), ("next_text", "next_")):
        df = with_fingerprint(df, text, out, s).withColumn(f"{out}set", hashes(out))
    return df.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        written("own_").alias("fingerprint"), written("edited_").alias("edited_fingerprint"),
        likeness("own_set", "edited_set").alias("near_edited"), likeness("own_set", "next_set").alias("near_next"))
