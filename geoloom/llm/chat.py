"""Logged conversations: keep the longest snapshot of each and render it.

A log holds a conversation again and again as it grows. The rolling hash of a
conversation's first n turns is the xor of 128-bit hashes of (position, role,
text); a conversation whose whole hash is the hash of a proper prefix of another
one is dropped by an anti-join. Long conversations are cut into parts of turn
numbers, so that no step needs a whole conversation in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Turn numbers in a part.
PART_TURNS = 256


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Rows (conv, part, turn, role, text) with position `n` (from 1) and the rolling hash (`x`, `y`) up to the row."""
    inside = W.partitionBy("conv", "part").orderBy("turn", "role", "text")
    placed = turns.withColumn("place", F.row_number().over(inside).cast("long"))
    # Counts of the parts before: one row per part, however many turns it has.
    before = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = turns.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("rows"))
    starts = parts.select("conv", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    numbered = placed.join(starts, ["conv", "part"]).withColumn("n", F.col("start") + F.col("place")).drop("start", "place")
    hashed = numbered.withColumns({"hx": F.xxhash64("n", "role", "text"), "hy": F.xxhash64(F.lit("y"), "text", "role", "n")})
    sums = hashed.groupBy("conv", "part").agg(F.bit_xor("hx").alias("px"), F.bit_xor("hy").alias("py"))
    carried = sums.select("conv", "part", F.coalesce(F.bit_xor("px").over(before), F.lit(0)).alias("cx"), F.coalesce(F.bit_xor("py").over(before), F.lit(0)).alias("cy"))
    running = W.partitionBy("conv", "part").orderBy("n").rowsBetween(W.unboundedPreceding, W.currentRow)
    return hashed.join(carried, ["conv", "part"]).select(
        "conv", "part", "turn", "role", "text", "n",
        F.col("cx").bitwiseXOR(F.bit_xor("hx").over(running)).alias("x"), F.col("cy").bitwiseXOR(F.bit_xor("hy").over(running)).alias("y"))


def maximal_conversations(hashes: DataFrame) -> DataFrame:
    """Ids (`conv`) of the conversations of `prefix_hashes` that are no proper prefix of another one; of equal ones the smallest id."""
    lengths = hashes.groupBy("conv").agg(F.max("n").alias("length"))
    marked = hashes.select("conv", "n", "x", "y").join(lengths, "conv")
    wholes = marked.filter("n = length").groupBy("n", "x", "y").agg(F.min("conv").alias("conv"))
    prefixes = marked.filter("n < length").select("n", "x", "y").distinct()
    return wholes.join(prefixes, ["n", "x", "y"], "left_anti").select("conv")


def format_conversations(log: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (id, part, n_turns, text) of the maximal conversations, rendered as `<|role|>`, line end, text, line end per turn.

    A part has 256 turns (the last one fewer); a conversation's text is its parts
    in order, so a short conversation is one row. Turns are ordered by number,
    role and text; a null number comes first, a null role is "unknown", a null
    text is empty. A row that repeats counts once; rows of a null id belong to no
    conversation and are left out. Other columns are not read.
    """
    turn = F.coalesce(F.col(turn_col).cast("long"), F.lit(-1).cast("long"))
    turns = log.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.floor(turn / PART_TURNS).cast("long").alias("part"), turn.alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    hashes = prefix_hashes(turns)
    rendered = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n"))
    kept = hashes.join(maximal_conversations(hashes), "conv", "left_semi") \
        .select("conv", F.floor((F.col("n") - 1) / PART_TURNS).cast("long").alias("part"), "n", rendered.alias("rendered"))
    pieces = F.array_sort(F.collect_list(F.struct("n", "rendered")))
    return kept.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n_turns"), F.array_join(F.transform(pieces, lambda p: p["rendered"]), "").alias("text")) \
        .withColumnRenamed("conv", id_col)
