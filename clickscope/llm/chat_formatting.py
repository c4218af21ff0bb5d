"""Chat rendering of maximal conversations, in DataFrame functions only.

Logs often hold every snapshot of a growing conversation.  Turns are numbered
by their order in the conversation; each numbered turn has a hash, and the
rolling prefix hash of a turn is the exclusive-or of the hashes up to it (the
number is hashed in, so order counts; two independent 64-bit hashes).  A
conversation whose last prefix hash is an inner prefix hash of another one is a
snapshot of a longer one: an anti-join keeps the others, of equal ones the
smallest id, and renders them.

Numbers and prefixes are computed in two levels (inside ranges of turns, then
over the ranges' totals), and the text is rendered in parts of ``part_turns``
turns, so no conversation has to fit in one task or one string.

Defined cases: rows without a conversation id belong to no conversation; equal
rows of a conversation are one turn; turns with the same number are ordered by
their hashes, null numbers come first; a null role is rendered as ``unknown``,
a null text as an empty one (they differ from that role and from an empty text
in comparisons); ``<|`` inside a text is rendered as ``< |``, so that no text
can start a turn; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.session import cut_lineage

RANGE_TURNS = 256


def _turn_hash(seed: int, role: str, text: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(role).isNull(), F.col(text).isNull(), F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit("")))


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, a, b`` (turn hashes), ``pos`` (from 1) and the prefix
    hashes ``pa, pb`` of every distinct turn."""
    turns = (conversations.where(F.col(conv).isNotNull())
             .select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _turn_hash(1, role, text).alias("a"), _turn_hash(2, role, text).alias("b"))
             .distinct().withColumn("range", F.coalesce(F.floor(F.col("turn") / RANGE_TURNS), F.lit(-(2**62)))))
    inner = Window.partitionBy("conv", "range").orderBy("turn", "a", "b")
    outer = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = turns.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("c")).withColumn("skip", F.coalesce(F.sum("c").over(outer), F.lit(0))).drop("c")
    placed = turns.withColumn("at", F.row_number().over(inner)).join(before, ["conv", "range"]).withColumn("pos", F.col("at") + F.col("skip"))
    hashed = placed.withColumn("ha", F.xxhash64(F.lit(3), "pos", "a", "b")).withColumn("hb", F.xxhash64(F.lit(4), "pos", "b", "a"))
    totals = hashed.groupBy("conv", "range").agg(F.bit_xor("ha").alias("ta"), F.bit_xor("hb").alias("tb"))
    over = totals.select("conv", "range", *[F.coalesce(F.bit_xor(t).over(outer), F.lit(0)).alias(o) for t, o in (("ta", "oa"), ("tb", "ob"))])
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = hashed.withColumn("ra", F.bit_xor("ha").over(upto)).withColumn("rb", F.bit_xor("hb").over(upto)).join(over, ["conv", "range"])
    return run.select("conv", "turn", "a", "b", "pos", F.col("ra").bitwiseXOR(F.col("oa")).alias("pa"), F.col("rb").bitwiseXOR(F.col("ob")).alias("pb"))


def maximal(turns: DataFrame) -> DataFrame:
    """``conv, n_turns`` of conversations that prefix no longer one."""
    length = turns.groupBy("conv").agg(F.max(F.struct("pos", "pa", "pb")).alias("last"))
    ends = length.select("conv", "last.*").groupBy("pos", "pa", "pb").agg(F.min("conv").alias("conv"))
    sizes = length.select("conv", F.col("last.pos").alias("n"))
    prefixes = turns.join(sizes, "conv").where("pos < n").select("pos", "pa", "pb").distinct()
    return ends.join(prefixes, ["pos", "pa", "pb"], "left_anti").select("conv", F.col("pos").alias("n_turns"))


def render(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = 200) -> DataFrame:
    """``conv, n_turns, part`` (from 0), ``rendered`` of every maximal
    conversation."""
    turns = cut_lineage(numbered(conversations, conv, turn, role, text), "turns")
    keep = maximal(turns)
    places = turns.join(keep, "conv").select("conv", "n_turns", F.col("turn").alias("__turn"), "a", "b", "pos")
    said = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("__t"), _turn_hash(1, role, text).alias("a"), _turn_hash(2, role, text).alias("b"),
        F.concat(F.lit("<|im_start|>"), F.replace(F.coalesce(F.col(role), F.lit("unknown")), F.lit("<|"), F.lit("< |")), F.lit("\n"),
                 F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |")), F.lit("<|im_end|>\n")).alias("line"))
    rows = said.join(places, ["conv", "a", "b"]).where(F.col("__t").eqNullSafe(F.col("__turn")))
    part = F.floor((F.col("pos") - 1) / part_turns).cast("int")
    once = rows.groupBy("conv", "n_turns", part.alias("part"), "pos").agg(F.min("line").alias("line"))
    whole = once.groupBy("conv", "n_turns", "part").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("l"))
    return whole.select(F.col("conv").alias(conv), F.col("n_turns").cast("long").alias("n_turns"), "part", F.array_join(F.col("l.line"), "").alias("rendered"))
