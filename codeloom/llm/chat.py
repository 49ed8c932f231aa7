"""Chat formatting after collapsing cumulative snapshots (operator 4). DataFrame functions only.

A logger that writes a conversation after every turn leaves each state of it. A rolling hash names every prefix of
every conversation; a conversation whose whole hash is the hash of a proper prefix of another one is dropped by an
anti-join, of equal ones the one with the smallest id stays, and only the rest is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from codeloom.llm.shared import saved

START, END = "<|im_start|>", "<|im_end|>"


def hashed_turns(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, i, role, text, the rolling hash of turns 1..i, and whether the turn is the last.

    The hash of a prefix is the exclusive-or of the hashes of its numbered turns, so a window adds one turn at a time.
    """
    rows = turns.select(F.col(key).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    numbered = rows.withColumns({"i": F.row_number().over(order), "last": F.lead(F.lit(True)).over(order).isNull()})
    # Nulls do not change a hash, so they are marked.
    own = F.xxhash64("i", F.col("role").isNull(), "role", F.col("text").isNull(), "text")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered.withColumn("own", own).withColumn("hash", F.bit_xor("own").over(running)).drop("own", "turn")


def maximal(hashed: DataFrame) -> DataFrame:
    """conv, i (turns) and n_copies of the conversations that are no prefix of a longer one, one of equal ones."""
    whole = hashed.where("last").groupBy("i", "hash").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_copies"))
    # Combined before the shuffle: a first turn that everyone shares leaves a task once.
    prefixes = hashed.where("not last").select("i", "hash").distinct()
    return whole.join(prefixes, ["i", "hash"], "left_anti")


def format_conversations(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Key, n_turns, n_copies (equal conversations) and text, rendered, of the maximal conversations.

    Turns go by number, then role and text, so that ties and repeated rows have one order; a null number comes first.
    A null role or text is rendered as empty and differs from an empty one when conversations are compared. Rows with
    a null key are one conversation. The markers are broken up where they occur in a text. Other columns are ignored.
    """
    hashed = saved(hashed_turns(turns, key, turn, role, text), "turns")
    kept = maximal(hashed).select(F.col("conv").alias("_conv"), F.col("i").alias("n_turns"), "n_copies")
    safe = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|"), F.lit("< |"))
    shown = F.concat(F.lit(START), safe("role"), F.lit("\n"), safe("text"), F.lit(END + "\n"))
    rows = hashed.join(kept, F.col("conv").eqNullSafe(F.col("_conv"))).withColumn("shown", shown)
    # The result has one row for a conversation, so its turns have to meet here and nowhere before.
    out = rows.groupBy("conv", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(F.struct("i", "shown"))).alias("all"))
    return out.select(
        F.col("conv").alias(key), F.col("n_turns").cast("long").alias("n_turns"), "n_copies",
        F.array_join(F.col("all.shown"), "").alias("text"),
    )
