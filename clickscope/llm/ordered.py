"""Rows in id order over many tasks, without a sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows per part that an ordering aims at, and the most parts it makes.
PART_ROWS = 50_000
MOST_PARTS = 2_000
#: Sub-parts of a part that holds one id only.
SPLITS = 256


def cut_points(df: DataFrame, id_col: str, parts: int | None = None) -> list[int]:
    """Quantiles of the ids that give parts of about equal rows (at most
    ``MOST_PARTS`` values reach the driver)."""
    if parts is None:
        parts = -(-df.count() // PART_ROWS)
    n = min(MOST_PARTS, max(2, parts))
    cuts = df.select(F.percentile_approx(id_col, [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    return sorted({int(c) for c in cuts})


def part_of(id_col: Column, cuts: list[int], then: Column) -> Column:
    """Part number, monotone in (id, ``then``); ``then`` is in [0, 1).

    Between two cut points lies one part.  A cut point itself, where a repeated
    id may hold any share of the rows, and the null id have ``SPLITS`` parts by
    ``then`` each."""
    sub = F.floor(then * SPLITS).cast("long")
    if not cuts:
        return F.when(id_col.isNull(), sub - SPLITS).otherwise(F.lit(0).cast("long"))
    points = F.lit(cuts)

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.element_at(points, F.least(mid, F.lit(len(cuts) - 1)) + 1) < id_col
        return F.struct(F.when((s["lo"] < s["hi"]) & below, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when((s["lo"] < s["hi"]) & ~below, mid).otherwise(s["hi"]).alias("hi"))

    steps = F.array_repeat(F.lit(0), len(cuts).bit_length() + 1)
    j = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), halve)["lo"]
    at_cut = (j < len(cuts)) & (F.element_at(points, F.least(j, F.lit(len(cuts) - 1)) + 1) == id_col)
    base = j.cast("long") * (2 * SPLITS)
    return F.when(id_col.isNull(), sub - SPLITS).when(at_cut, base + SPLITS + sub).otherwise(base)


def offsets(df: DataFrame, part: str, sums: dict[str, Column]) -> DataFrame:
    """Per part the totals of all parts before it.  The window runs over one
    row per part, whatever the table's size."""
    totals = df.groupBy(part).agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, *[F.coalesce(F.sum(k).over(w), F.lit(0)).cast("long").alias(k) for k in sums])
