"""Chat formatting with cumulative-snapshot collapse, in joins, windows and aggregates.

A logged conversation is often a snapshot of one that went on. The hash of a
conversation's first i turns is a running sum of position-keyed turn hashes (4
lanes of 31 bits), so one window gives all prefix hashes. Conversations with
equal hashes collapse to the smallest conv_id, and an anti-join against the
proper prefixes of all conversations leaves the maximal ones, which are rendered.

Defined results: turns are ordered by turn (null first), role, text; identical
turn rows of a conversation count once; a null role renders as ``unknown``, a
null null text as empty; a row without conv_id is a conversation of its own, so that
such rows are never gathered. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

LANES = tuple(f"lane{j}" for j in range(4))
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, lone, i, n, lane0..3, line`` per turn: lanes hash the conversation's first i of n turns.

    ``lone`` numbers the rows without conv_id and is null for all others.
    """
    lone = F.when(turns["conv_id"].isNull(), F.monotonically_increasing_id()).alias("lone")
    rows = turns.select(turns["conv_id"], lone, turns["turn"], F.coalesce(turns["role"], F.lit("unknown")).alias("role"),
                        F.coalesce(turns["text"], F.lit("")).alias("text"))
    own = Window.partitionBy("conv_id", "lone")
    ordered = own.orderBy("turn", "role", "text")
    turn = F.struct("turn", "role", "text")
    rows = rows.withColumn("before", F.lag(turn).over(ordered)).where(
        F.col("before").isNull() | ~F.col("before").eqNullSafe(turn))
    rows = rows.withColumn("i", F.row_number().over(ordered)).withColumn("n", F.count(F.lit(1)).over(own))
    so_far = own.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lanes = [F.sum(F.xxhash64(F.lit(j), "i", "role", "text").bitwiseAND(F.lit((1 << 31) - 1))).over(so_far).alias(lane)
             for j, lane in enumerate(LANES)]
    line = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"), F.col("text"), F.lit(CLOSE))
    return rows.select("conv_id", "lone", F.col("i").cast("long"), "n", *lanes, line.alias("line"))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies, rendered`` per maximal conversation; n_copies counts equal logs."""
    turns = cut(prefix_hashes(turns))
    key = ["n", *LANES]
    whole = turns.where("i = n").groupBy(*key).agg(F.min(F.struct(
        F.col("conv_id").isNull().alias("none"), "conv_id", "lone")).alias("kept"), F.count(F.lit(1)).alias("n_copies"))
    prefixes = turns.where("i < n").select(F.col("i").alias("n"), *LANES).distinct()
    maximal = whole.join(prefixes, key, "left_anti").select(
        F.col("kept.conv_id").alias("kept_id"), F.col("kept.lone").alias("kept_lone"), "n_copies")
    rows = turns.join(maximal, F.col("conv_id").eqNullSafe(F.col("kept_id")) & F.col("lone").eqNullSafe(F.col("kept_lone")))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("i", "line"))), lambda x: x["line"])
    return rows.groupBy("conv_id", "lone").agg(
        F.max("n").alias("n_turns"), F.max("n_copies").alias("n_copies"), F.array_join(lines, "\n").alias("rendered")).drop("lone")


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, CASE WHEN conv_id IS NULL THEN no END AS lone, turn, coalesce(role, 'unknown') AS role,
  coalesce(text, '') AS text FROM (SELECT row_number() OVER () AS no, conv_id, turn, role, text FROM conversations) c),
c AS (SELECT conv_id, list('<|im_start|>' || role || chr(10) || text || '<|im_end|>'
  ORDER BY turn NULLS FIRST, role, text) AS lines FROM t GROUP BY conv_id, lone),
whole AS (SELECT lines, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY lines),
prefixes AS (SELECT DISTINCT lines[1:i] AS lines
  FROM (SELECT lines, unnest(range(1, len(lines))) AS i FROM whole))
SELECT conv_id, len(lines)::BIGINT AS n_turns, n_copies, array_to_string(lines, chr(10)) AS rendered
FROM whole WHERE lines NOT IN (SELECT lines FROM prefixes)
"""
