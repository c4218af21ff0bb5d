"""Cleaning and encoding.

Fitted constants (medians, category labels) are computed by one aggregate
job each and then applied as literals, exactly like a Spark ML ``fit`` /
``transform`` pair: the row-level work stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.session import cut_lineage

UNKNOWN = "Unknown"
#: Label sets of at most so many labels become literals.
LITERAL_LABELS = 128
#: A code table is broadcast up to so many rows and bytes of text, both counted.
BROADCAST_LABELS, BROADCAST_BYTES = 100_000, 8 << 20


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; absent names are a no-op."""
    return df.drop(*[c for c in cols if c in df.columns])


def keep_labelled(df: DataFrame, target: str) -> DataFrame:
    """Keep rows with a non-null target."""
    return df.filter(F.col(target).isNotNull())


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fill nulls with constants (``'Unknown'`` for the nominal columns)."""
    return df.fillna(values)


def fit_medians(df: DataFrame, cols: Sequence[str], exact: bool = True,
                distinct_counts: dict[str, int] | None = None) -> dict[str, float]:
    """A4/P6 fit: all medians in one aggregate pass; exact medians of
    high-cardinality columns by distributed selection
    (:func:`clickscope.functions.quantiles.quantile_columns`)."""
    if not cols:
        return {}
    from clickscope.functions.quantiles import quantile_columns
    q = quantile_columns(df, cols, [0.5], exact=exact, distinct_counts=distinct_counts)
    row = df.agg(*[q[c][0].alias(c) for c in cols]).first()
    return {c: row[c] for c in cols if row[c] is not None}


def fill_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """P5/P6 transform: replace nulls by the fitted medians."""
    return df.fillna({c: float(v) for c, v in medians.items()})


@dataclass(frozen=True)
class LabelCodes:
    """F2 fit: the written table ``(feature, label, code)``, and the number of
    labels and bytes of each feature."""
    table: DataFrame
    sizes: dict[str, tuple[int, int]]

    def add(self, df: DataFrame, col: str, out: str) -> DataFrame:
        """F2/F3 transform: ``out`` is the code of ``col``; null and labels that
        were not there at fit time get the code of ``'Unknown'`` (null without
        that class).  The plan does not depend on the number of labels."""
        rows, size = self.sizes[col]
        codes = self.table.where(F.col("feature") == col)
        unknown = codes.where(F.col("label") == UNKNOWN).select("code").first()
        side = codes.select(F.col("label").alias("__label"), F.col("code").alias("__code"))
        if rows <= BROADCAST_LABELS and size <= BROADCAST_BYTES:
            side = F.broadcast(side)
        joined = df.join(side, F.col(col).cast("string") == F.col("__label"), "left")
        code = F.coalesce("__code", F.lit(unknown["code"] if unknown else None)).cast("int")
        keep = [c for c in df.columns if c != out]
        return joined.select(*[code.alias(c) if c == out else F.col(f"`{c}`") for c in (df.columns if out in df.columns else [*keep, out])])

    def labels(self, col: str) -> list[str]:
        """The labels of one feature in code order, for reports and small sets."""
        if self.sizes[col][0] > LITERAL_LABELS:
            raise ValueError(f"{col}: {self.sizes[col][0]} labels; read them from the table")
        return [r["label"] for r in self.table.where(F.col("feature") == col).orderBy("code").collect()]


def fit_label_codes(df: DataFrame, cols: Sequence[str], add_unknown: bool = True) -> LabelCodes:
    """Codes of all labels of ``cols`` (nulls are no label), written once."""
    table = cut_lineage(label_code_table(df, cols, add_unknown), "label-codes")
    sizes = {c: (0, 0) for c in cols}
    for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("label")).alias("b")).collect():
        sizes[r["feature"]] = (r["n"], r["b"])
    return LabelCodes(table, sizes)


def encode_labels(df: DataFrame, encoder: LabelCodes | dict[str, list[str]]) -> DataFrame:
    """F2/F3 transform in place of the columns: code = index in the sorted
    classes; unseen -> 'Unknown'.  A dict holds short label lists, which become
    a literal map: a codegen'd hash probe, no join."""
    if isinstance(encoder, LabelCodes):
        for c in encoder.sizes:
            df = encoder.add(df, c, c)
        return df
    out = df
    for c, labels in encoder.items():
        m = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(lab), F.lit(i))])
        known = F.col(c).isin(labels)
        key = F.when(known, F.col(c)).otherwise(F.lit(UNKNOWN if UNKNOWN in labels else None))
        out = out.withColumn(c, m[key].cast("int"))
    return out


def label_code_table(df: DataFrame, cols: Sequence[str], add_unknown: bool = True) -> DataFrame:
    """F2 as a relation: (feature, label, code) with ``dense_rank - 1``.

    Scales to any cardinality: one distinct per (feature, label) (partial
    aggregation), then a window per feature over distinct labels only.
    """
    long = None
    for c in cols:
        part = df.select(F.lit(c).alias("feature"), F.col(c).cast("string").alias("label"))
        long = part if long is None else long.unionByName(part)
    long = long.filter(F.col("label").isNotNull())
    if add_unknown:
        extra = df.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"),
            F.lit(UNKNOWN).alias("label"))
        long = long.unionByName(extra)
    # code = number of distinct labels before this one.  Spark orders strings
    # by their UTF-8 bytes, so the leading two bytes are a monotone bucket:
    # exact ranks via running totals, no single task per feature
    from clickscope.functions.windows import running_totals
    d = long.distinct().withColumn(
        "__b", F.conv(F.rpad(F.substring(F.hex(F.col("label")), 1, 4), 4, "0"), 16, 10)
        .cast("int"))
    r = running_totals(d, ["feature"], "__b", ["label"], {}, row_number="__rn")
    return r.select("feature", "label", (F.col("__rn") - 1).cast("int").alias("code"))


def clean_sessions(raw: DataFrame, id_col: str | None = "session_id", target: str = "ad_clicked",
                   unknown_cols: Iterable[str] = ("gender", "device_type"),
                   median_cols: Iterable[str] = ("avg_session_time",),
                   encode: bool = True, exact_median: bool = True
                   ) -> tuple[DataFrame, LabelCodes | dict[str, list[str]], dict[str, float]]:
    """The preprocessing stage: drop id (P1), fill nominal nulls with
    'Unknown' (P4), fill medians fitted on ALL rows before the target filter
    (P5), drop unlabelled rows (P3), label-encode (F2).

    Returns (processed, encoder, medians).
    """
    unknown_cols = [c for c in unknown_cols if c in raw.columns]
    median_cols = [c for c in median_cols if c in raw.columns]
    medians, encoder = fit_clean_constants(raw, median_cols, unknown_cols if encode else [],
                                           target, exact_median)
    df = drop_if_present(raw, id_col) if id_col else raw
    df = fill_constant(df, {c: UNKNOWN for c in unknown_cols})
    df = fill_medians(df, medians)
    df = keep_labelled(df, target)
    if encoder:
        df = encode_labels(df, encoder)
    return df, encoder, medians


def fit_clean_constants(raw: DataFrame, median_cols: Sequence[str], label_cols: Sequence[str],
                        target: str, exact_median: bool = True
                        ) -> tuple[dict[str, float], LabelCodes | dict[str, list[str]]]:
    """The fitted constants of the cleaning stage: medians over all rows
    (before the target filter) and the label sets of the filled nominal
    columns over the labelled rows.

    Job 1 estimates distinct counts of every column (HyperLogLog, fixed
    memory); up to ``LITERAL_LABELS`` labels are read as short lists (job 2),
    more stay a written table; job 3 takes the medians (exact map when bounded,
    else distributed selection).
    """
    cols = list(dict.fromkeys([*median_cols, *label_cols]))
    if not cols:
        return {}, {}
    est = raw.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    encoder: LabelCodes | dict[str, list[str]] = {}
    if label_cols:
        filled = raw.filter(F.col(target).isNotNull()).select(*[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in label_cols])
        if all((est[c] or 0) < LITERAL_LABELS // 2 for c in label_cols):
            pairs = filled.select(F.inline(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).alias("v")) for c in label_cols]))).distinct().collect()
            encoder = {c: sorted({r["v"] for r in pairs if r["f"] == c} | {UNKNOWN}) for c in label_cols}
        else:
            encoder = fit_label_codes(filled, label_cols)
    medians = (fit_medians(raw, list(median_cols), exact_median,
                           {c: est[c] for c in median_cols}) if median_cols else {})
    return medians, encoder
