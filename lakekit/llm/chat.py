"""Logged conversations to training texts, without those that a longer one continues.

A chat service logs a conversation anew after every turn, so most logged conversations
are the beginning of a longer one. Each turn has a rolling hash of the turns up to it.
A conversation whose last rolling hash is the hash of a shorter beginning of another one is
dropped by an anti-join; of equal conversations the smallest conv_id stays. Only hashes
are shuffled for that; texts are gathered for the conversations that remain.

All of it is DataFrame code. Beginnings that many conversations share are folded by
``distinct`` before they meet, so a common first turn is one row.

* Null roles and texts count as empty; a null turn stands first; a null conv_id is an id like
  others and sorts first.
* A row repeated in a conversation counts once. Different rows of one turn all stay, in
  the order of their hash.
* Other columns are ignored. No rows, no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a turn looks like; the opening mark in a text is broken up so that no text can
# end its turn or begin another.
OPEN, CLOSE = "<|", "|>"
END = "<|end|>\n"


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # Two hashes of 64 bits; equal turns are equal texts for all that can happen.
    return rows.withColumns(
        {
            "_a": F.xxhash64(F.length("role"), "role", "text"),
            "_b": F.xxhash64(F.lit(7), "text", F.length("text"), "role"),
        }
    )


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """``conv_id, length, a, b, last``: a row for each turn, with the hashes of the
    conversation up to it."""
    turns = _turns(conversations).select("conv_id", "turn", "_a", "_b").distinct()
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "_a", "_b")
    rows = turns.withColumns(
        {"length": F.row_number().over(order), "last": F.lead("_a").over(order).isNull()}
    )
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    # Each turn is hashed with its place, so that the order of turns counts in the sum.
    a = F.bit_xor(F.xxhash64("length", "_a", "_b")).over(upto)
    b = F.bit_xor(F.xxhash64("_b", "length", "_a")).over(upto)
    return rows.select("conv_id", "length", a.alias("a"), b.alias("b"), "last")


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns`` of the conversations that no other one continues or, of equal
    ones, the smallest."""
    hashes = prefix_hashes(conversations)
    key = ["length", "a", "b"]
    beginnings = hashes.filter(~F.col("last")).select(*key).distinct()
    # min skips nulls: a null id counts only where it is the only one.
    whole = hashes.filter("last").groupBy(*key).agg(
        F.min("conv_id").alias("_min"), F.max(F.col("conv_id").isNull()).alias("_null")
    )
    smallest = F.when(~F.col("_null"), F.col("_min"))
    kept = whole.join(beginnings, key, "left_anti")
    return kept.select(smallest.alias("conv_id"), F.col("length").alias("n_turns"))


def render_turn(role: Column, text: Column) -> Column:
    def safe(x: Column) -> Column:
        return F.replace(x, F.lit(OPEN), F.lit("< |"))

    return F.concat(F.lit(OPEN), safe(role), F.lit(CLOSE + "\n"), safe(text), F.lit("\n" + END))


def chat_texts(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, text``: the conversations of :func:`maximal`, rendered."""
    kept = maximal(conversations).withColumnRenamed("conv_id", "_id")
    turns = _turns(conversations)
    rows = turns.join(kept, F.col("conv_id").eqNullSafe(F.col("_id")))
    turn = F.struct("turn", "_a", "_b", "role", "text")
    lists = rows.groupBy("conv_id", "n_turns").agg(F.sort_array(F.collect_set(turn)).alias("_turns"))
    text = F.array_join(F.transform("_turns", lambda t: render_turn(t["role"], t["text"])), "")
    return lists.select("conv_id", F.col("n_turns").cast("long"), text.alias("text"))


SQL = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations),
lists AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn) AS l, count(*) AS n
  FROM turns GROUP BY conv_id),
beginnings AS (
  SELECT DISTINCT l[1:i] AS l FROM (
    SELECT l, unnest(range(1, n)) AS i FROM lists)),
whole AS (SELECT l, n, min(conv_id) AS conv_id FROM lists GROUP BY l, n),
kept AS (
  SELECT conv_id, n FROM whole WHERE NOT EXISTS (
    SELECT 1 FROM beginnings b WHERE b.l = whole.l))
SELECT conv_id, n AS n_turns, string_agg(
    '<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |')
    || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn) AS text
FROM kept JOIN turns USING (conv_id) GROUP BY conv_id, n
"""
