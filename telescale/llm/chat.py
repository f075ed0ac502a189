"""Chat formatting: logged snapshots of a conversation collapse into the longest one, which is then rendered.

A system that logs the whole conversation after each turn leaves many that are a prefix of a later one. The turns
of a conversation get rolling hashes: at each turn two 64-bit hashes of all turns up to it. A conversation whose
last hash is an inner one of another is a prefix of it and goes (an anti-join); of equal conversations the one of
the smallest id stays. Both sides of the joins are reduced to one row for each hash first, so that a first turn or
a conversation that a third of all logs share costs no task more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_START, TURN_END = "<|{}|>\n", "\n<|end|>\n"
_HASH = ("_n", "_h1", "_h2")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Turns with their place in the conversation from 1 on: by turn, then role and text; nulls come first."""
    some = turns.select("conv_id", "turn", "role", "text").filter("conv_id is not null")
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return some.withColumn("_n", F.row_number().over(by))


def rolling_hashes(numbered: DataFrame) -> DataFrame:
    """At each turn the combined hashes of the turns up to it. Each turn is hashed with its place, so order counts."""
    upto = Window.partitionBy("conv_id").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    said = [F.col("_n"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), *said)).over(upto).alias(f"_h{seed}") for seed in (1, 2)]
    return numbered.select("conv_id", "_n", *hashes)


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_snapshots) of the conversations that are no prefix of a longer one, once each.

    ``n_snapshots`` counts the logged conversations that equal it.
    """
    rolled = rolling_hashes(numbered_turns(turns))
    length = Window.partitionBy("conv_id")
    rolled = rolled.withColumn("_turns", F.max("_n").over(length))
    whole = rolled.filter("_n = _turns").groupBy(*_HASH).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_snapshots")
    )
    inner = rolled.filter("_n < _turns").select(*_HASH).distinct()
    left = whole.join(inner, list(_HASH), "left_anti")
    return left.select("conv_id", F.col("_n").cast("long").alias("n_turns"), "n_snapshots")


def rendered_turn(role: Column, text: Column) -> Column:
    before, after = TURN_START.split("{}")
    return F.concat(F.lit(before), F.coalesce(role, F.lit("")), F.lit(after), F.coalesce(text, F.lit("")),
                    F.lit(TURN_END))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row for each maximal conversation: conv_id, n_turns, n_snapshots, rendered.

    Turns are ordered by turn, then role and text (nulls first), so ties have an order; repeated rows are turns of
    their own. Null roles and texts differ from empty ones when conversations are compared and are rendered empty.
    Rows without conv_id belong to no conversation and are left out; other columns are not read. A conversation
    becomes one string, so that all its turns must fit into one row. Roles and texts are rendered as they are: a text that
    holds the marks of a turn reads as further turns. An empty table gives no rows.
    """
    kept = maximal(turns)
    numbered = numbered_turns(turns).join(kept, "conv_id")
    said = F.struct("_n", rendered_turn(F.col("role"), F.col("text")).alias("said"))
    in_order = F.sort_array(F.collect_list(said)).alias("said")
    grouped = numbered.groupBy("conv_id", "n_turns", "n_snapshots").agg(in_order)
    return grouped.select("conv_id", "n_turns", "n_snapshots", F.concat_ws("", "said.said").alias("rendered"))
