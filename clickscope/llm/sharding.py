"""Contiguous balanced shards from global byte-size prefix sums.

The rows are ordered by id (then checksum and size) and dealt into parts of
that order.  Each part is summed first (one row per part), the parts' totals
are added up in order, and a running sum inside each part, moved by its part's
offset, gives every row the number of bytes before it in the whole table.
Cutting that prefix at the targets ``j * total / n_shards`` gives contiguous
shards; a shard differs from its target by less than a row.

Only id, size and checksum move; texts stay where they are read.

Defined cases: a null text has no bytes (checksum 0), its row has the header's
size; null ids come first; a repeated or null id may hold any share of the rows
(its rows are ordered and dealt by checksum); rows equal in all three take any
order among themselves, which gives the same set of results; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.ordered import cut_points, offsets, part_of
from clickscope.session import cut_lineage

ROW_HEADER = 16


def sizes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(content) + ROW_HEADER).cast("long").alias("size"),
                       F.crc32(content.cast("binary")).alias("text_crc32"))


def assign(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32``, ``shard`` from 0, ``slot`` (place in the
    shard, gapless from 0) and ``byte_start`` (bytes of all rows before)."""
    rows = cut_lineage(sizes(docs, id_col, text), "sizes")
    order = ["doc_id", "text_crc32", "size"]
    rows = rows.withColumn("part", part_of(F.col("doc_id"), cut_points(rows, "doc_id"), F.col("text_crc32") / 2.0**32))
    w = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(*order, "part", F.coalesce(F.sum("size").over(w), F.lit(0)).alias("b"), F.count(F.lit(1)).over(w).alias("r"))
    before = offsets(rows, "part", {"part_bytes": F.col("size"), "part_rows": F.lit(1)})
    placed = local.join(before, "part").select(*order, (F.col("b") + F.col("part_bytes")).alias("byte_start"), (F.col("r") + F.col("part_rows")).alias("row"))
    total = int(rows.select(F.sum("size")).first()[0] or 1)
    # whole-number cut: shard j starts at the first row with byte_start * n >= j * total
    shard = F.expr(f"cast(cast(byte_start as decimal(20,0)) * {n_shards} div cast({total} as decimal(20,0)) as int)")
    placed = cut_lineage(placed.withColumn("shard", F.least(shard, F.lit(n_shards - 1))), "placed")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(*order, "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"), F.col("byte_start").cast("long").alias("byte_start"))
