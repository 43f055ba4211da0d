"""Chat formatting: only maximal conversations are rendered.

A log often holds snapshots of a conversation as it grows. Turns are put in order
and every prefix of a conversation gets a rolling hash: the sums of four 32-bit
hashes of (position, role, text) over its turns. A conversation whose whole hash
is a proper prefix of another one is left out by an anti-join; of equal
conversations the smallest id stays. Positions and sums are first taken within
blocks of turns and then over blocks, so that one very long conversation is not
the work of a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millpulse.llm.common import stored, table

BLOCK_TURNS = 256
_SUMS = ("s0", "s1", "s2", "s3")


def _hashes(position: Column) -> dict[str, Column]:
    """Four 32-bit numbers of a turn at its position; null differs from empty."""
    content = [
        position, F.col("role").isNull(), F.coalesce("role", F.lit("")),
        F.col("text").isNull(), F.coalesce("text", F.lit("")),
    ]
    one, two = (F.xxhash64(F.lit(n), *content) for n in (1, 2))
    low = F.lit(0xFFFFFFFF)
    return {
        "h0": one.bitwiseAND(low), "h1": F.shiftrightunsigned(one, 32),
        "h2": two.bitwiseAND(low), "h3": F.shiftrightunsigned(two, 32),
    }


def ordered_turns(log: DataFrame) -> DataFrame:
    """(conv_id, block, turn, role, text, position from 1, n_turns), ordered by turn,
    role and text, nulls first."""
    turns = log.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    turns = turns.withColumn(
        "block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS).cast("long"), F.lit(-(1 << 62)))
    )
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(F.count("*").alias("size")).select(
        "conv_id", "block",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead"),
        F.sum("size").over(whole).alias("n_turns"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(
        F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")
    )
    return (
        turns.withColumn("place", F.row_number().over(inside)).join(blocks, ["conv_id", "block"])
        .withColumn("position", F.col("ahead") + F.col("place")).drop("ahead", "place")
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, position, n_turns, s0..s3): the hash of each conversation's first
    ``position`` turns."""
    hashed = turns.select("conv_id", "block", "position", "n_turns", *(
        c.alias(n) for n, c in _hashes(F.col("position")).items()
    ))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = hashed.groupBy("conv_id", "block").agg(*(F.sum(f"h{k}").alias(f"b{k}") for k in range(4)))
    blocks = blocks.select("conv_id", "block", *(
        F.coalesce(F.sum(f"b{k}").over(before), F.lit(0)).alias(f"b{k}") for k in range(4)
    ))
    inside = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = hashed.select("conv_id", "block", "position", "n_turns", *(
        F.sum(f"h{k}").over(inside).alias(f"i{k}") for k in range(4)
    ))
    return sums.join(blocks, ["conv_id", "block"]).select(
        "conv_id", "position", "n_turns", *((F.col(f"i{k}") + F.col(f"b{k}")).alias(f"s{k}") for k in range(4))
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """Ids of the conversations that are no proper prefix of another one; the
    smallest id of equal ones."""
    whole = (
        prefixes.where("position = n_turns").groupBy("position", *_SUMS).agg(F.min("conv_id").alias("conv_id"))
    )
    proper = prefixes.where("position < n_turns").select("position", *_SUMS).distinct()
    return whole.join(proper, ["position", *_SUMS], "left_anti").select("conv_id")


def rendered(role: Column, text: Column) -> Column:
    """One turn of the chat format; a null role is "user", a null text is empty."""
    return F.concat(
        F.lit("<|im_start|>"), F.coalesce(role, F.lit("user")), F.lit("\n"),
        F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"),
    )


def collapse(log: DataFrame) -> DataFrame:
    """(conv_id, position, n_turns, rendered) for the turns of maximal
    conversations; joined in the order of positions they are the conversation.

    Turns of null conv_id belong to no conversation and are left out. Turns that
    repeat a number are ordered by role and text; repeated rows are turns of
    their own. Other columns are ignored.
    """
    turns = stored(ordered_turns(log), "chat-turns")
    prefixes = stored(prefix_hashes(turns), "chat-prefixes")
    kept = stored(maximal_conversations(prefixes), "chat-maximal")
    return turns.join(kept, "conv_id", "left_semi").select(
        "conv_id", "position", "n_turns", rendered(F.col("role"), F.col("text")).alias("rendered")
    )


def op10_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(table(spark, sf_dir, "conversations"))


QUERIES = {"op10_chat_collapse": op10_chat_collapse}

ORACLE = {
    "op10_chat_collapse": r"""
WITH turns AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
           AS position,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM conversations WHERE conv_id IS NOT NULL
), prefixes AS (
  SELECT conv_id, position, n_turns,
         string_agg((CASE WHEN role IS NULL THEN '0' ELSE '1' || role END) || chr(30)
                    || (CASE WHEN text IS NULL THEN '0' ELSE '1' || text END) || chr(31), '')
           OVER (PARTITION BY conv_id ORDER BY position) AS prefix
  FROM turns
), whole AS (
  SELECT prefix, min(conv_id) AS conv_id FROM prefixes WHERE position = n_turns GROUP BY prefix
), kept AS (
  SELECT conv_id FROM whole
  WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE position < n_turns)
)
SELECT conv_id, position, n_turns,
       '<|im_start|>' || coalesce(role, 'user') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered
FROM turns WHERE conv_id IN (SELECT conv_id FROM kept)
"""
}
