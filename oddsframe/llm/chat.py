"""Chat formatting: cumulative snapshots collapsed to maximal conversations.

Chat logs store a conversation again after every turn.  A rolling hash of each
turn prefix (the sum, over the turns so far, of a hash of position, role and text)
identifies a stored conversation that is a prefix of a longer one; an anti-join
keeps the maximal ones, and those are rendered.

A conversation may be very long: positions and rolling sums are computed in
blocks of ``BLOCK_TURNS`` turns and carried over by the blocks' totals, and
the text is rendered in parts of as many turns.  A first turn or a
conversation that a third of the rows repeat is pre-aggregated by its hash.
DataFrame functions only.

Defined results: rows without ``conv_id`` belong to no conversation and are left
out.  Turns are ordered by turn number (null first), then role and text, so
equal rows stay as repeated turns.  Null roles and texts render as empty but do
not equal empty ones.  Of conversations with equal turns the smallest id stays.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Turns that are ordered, summed and rendered at a time.
BLOCK_TURNS = 512
_LANES = ("h1", "h2", "h3")


def _turn_hash() -> list[Column]:
    """Three 40-bit numbers from one digest of position, role and text."""
    part = lambda c: F.coalesce(F.concat(F.lit("v"), F.length(c), F.lit(":"), F.col(c)), F.lit("n"))
    digest = F.sha2(F.concat_ws("|", F.col("pos").cast("string"), part("role"), part("text")), 256)
    return [F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 10).cast("long").alias(lane)
            for i, lane in enumerate(_LANES)]


def numbered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, pos, role, text`` with positions 1, 2, ... in each conversation;
    a range of turn numbers is ordered at a time."""
    rows = turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                        F.col(f"`{role}`").cast("string").alias("role"),
                        F.col(f"`{text}`").cast("string").alias("text")).where("conv is not null")
    block = F.expr(f"coalesce(turn div {BLOCK_TURNS}, -9223372036854775808)")
    rows = rows.withColumn("block", block)
    before = (rows.groupBy("conv", "block").agg(F.count("*").alias("m"))
              .withColumn("before", F.sum("m").over(Window.partitionBy("conv").orderBy("block")
                                                    .rowsBetween(Window.unboundedPreceding, -1))))
    inside = F.row_number().over(Window.partitionBy("conv", "block").orderBy("turn", "role", "text"))
    return (rows.withColumn("inside", inside).join(before.drop("m"), ["conv", "block"])
            .select("conv", (F.coalesce("before", F.lit(0)) + F.col("inside")).alias("pos"), "role", "text"))


def prefix_hashes(numbered: DataFrame) -> DataFrame:
    """``conv, pos, h1, h2, h3``: the rolling hash after each turn."""
    rows = numbered.select("conv", "pos", F.expr(f"(pos - 1) div {BLOCK_TURNS}").alias("block"), *_turn_hash())
    total = rows.groupBy("conv", "block").agg(*[F.sum(h).alias(h) for h in _LANES])
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = total.select("conv", "block", *[F.coalesce(F.sum(h).over(earlier), F.lit(0)).alias(f"c{h}")
                                              for h in _LANES])
    so_far = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.select("conv", "block", "pos", *[F.sum(h).over(so_far).alias(h) for h in _LANES])
            .join(carried, ["conv", "block"])
            .select("conv", "pos", *[(F.col(h) + F.col(f"c{h}")).alias(h) for h in _LANES]))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """``conv, n_turns, n_copies`` of conversations that are no prefix of a longer one."""
    last = F.max(F.struct("pos", *_LANES)).alias("last")
    whole = (prefixes.groupBy("conv").agg(last).select("conv", "last.*")
             .groupBy("pos", *_LANES).agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies")))
    ended = F.max(F.struct("pos", *_LANES)).over(Window.partitionBy("conv"))
    longer = (prefixes.withColumn("end", ended["pos"]).where("pos < end")
              .select("pos", *_LANES).distinct())
    return (whole.join(longer, ["pos", *_LANES], "left_anti")
            .select("conv", F.col("pos").alias("n_turns"), "n_copies"))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", opening: str = "<|im_start|>", closing: str = "<|im_end|>") -> DataFrame:
    """Rendered maximal conversations: ``conv, part, n_turns, n_copies, rendered``.
    A conversation is one row, or one for every ``BLOCK_TURNS`` turns (``part`` 0,
    1, ... to be joined in order)."""
    numbered = cut(numbered_turns(turns, conv, turn, role, text))
    kept = maximal_conversations(prefix_hashes(numbered))
    piece = F.concat(F.lit(opening), F.coalesce("role", F.lit("")), F.lit("\n"),
                     F.coalesce("text", F.lit("")), F.lit(closing + "\n"))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"])
    parts = (numbered.select("conv", F.expr(f"cast((pos - 1) div {BLOCK_TURNS} as int)").alias("part"), "pos",
                             piece.alias("piece"))
             .join(kept.select("conv"), "conv", "left_semi")
             .groupBy("conv", "part").agg(F.array_join(pieces, "").alias("rendered")))
    return (parts.join(kept, "conv")
            .select(F.col("conv").alias(conv), "part", "n_turns", "n_copies", "rendered"))


#: DuckDB: lists of turns compared as such.
CHAT_SQL = """
WITH numbered AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                            text NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
chats AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS turns, count(*) AS n_turns,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>'
                    || chr(10), '' ORDER BY pos) AS rendered
  FROM numbered GROUP BY conv_id
),
distinct_chats AS (
  SELECT turns, n_turns, rendered, min(conv_id) AS conv_id, count(*) AS n_copies
  FROM chats GROUP BY turns, n_turns, rendered
)
SELECT conv_id, CAST(0 AS INTEGER) AS part, n_turns, n_copies, rendered
FROM distinct_chats AS a
WHERE NOT EXISTS (SELECT 1 FROM distinct_chats AS b
                  WHERE b.n_turns > a.n_turns AND b.turns[1] = a.turns[1]
                    AND b.turns[1:a.n_turns] = a.turns)
"""
