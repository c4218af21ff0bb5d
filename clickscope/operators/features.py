"""Engineered features.

Fitted statistics are computed once (one aggregate) and applied as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.operators.clean import LabelCodes


def one_hot(df: DataFrame, col: str, labels: Sequence[str], prefix: str | None = None,
            drop_source: bool = True) -> DataFrame:
    """``<prefix>_<label>`` byte flags for each fitted label (dropLast=False)."""
    prefix = prefix or col
    flags = [F.when(F.col(col) == F.lit(v), 1).otherwise(0).cast("byte").alias(f"{prefix}_{v}")
             for v in labels]
    out = df.select("*", *flags)
    return out.drop(col) if drop_source else out


def one_hot_vector(df: DataFrame, codes: LabelCodes, cols: Sequence[str], out: str = "hot") -> DataFrame:
    """one sparse vector a row with the flags of all fitted labels of
    ``cols`` (dropLast=False): one row stays one row, however many labels.  The
    sizes come with the codes, so nothing is scanned; ``one_hot_names`` has the
    label of each place."""
    for c in cols:
        df = codes.add(df, c, f"{c}__code").withMetadata(f"{c}__code", {"ml_attr": {"type": "nominal", "num_vals": codes.sizes[c][0]}})
    codes_in, flags = [f"{c}__code" for c in cols], [f"{c}__flags" for c in cols]
    hot = OneHotEncoder(inputCols=codes_in, outputCols=flags, dropLast=False)
    made = VectorAssembler(inputCols=flags, outputCol=out).transform(hot.fit(df).transform(df))
    return made.drop(*codes_in, *flags)


def one_hot_names(codes: LabelCodes, cols: Sequence[str]) -> DataFrame:
    """``place, feature, label`` of the vectors of :func:`one_hot_vector`."""
    start, before = F.lit(0), 0
    for c in cols:
        start = F.when(F.col("feature") == c, F.lit(before)).otherwise(start)
        before += codes.sizes[c][0]
    return codes.table.where(F.col("feature").isin(list(cols))).select((F.col("code") + start).alias("place"), "feature", "label")


def fit_standard(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """F5 fit: mean and POPULATION std per column in one aggregate
    (Spark ML's StandardScaler uses the sample std, so it is not used)."""
    row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"{c}__m"),
                                             F.stddev_pop(c).alias(f"{c}__s"))]).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}


def standardize(df: DataFrame, stats: dict[str, tuple[float, float]],
                suffix: str = "") -> DataFrame:
    """F5 transform: ``(x - mean) / std``; a constant column (std 0) maps to 0."""
    out = df
    for c, (m, s) in stats.items():
        z = (F.col(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
        out = out.withColumn(c + suffix, z.cast("double"))
    return out


def engagement_score(df: DataFrame, pages: str = "pages_viewed", time: str = "time_on_site",
                     cart: str = "cart_items", out: str = "engagement_score") -> DataFrame:
    """pages * time / (cart + 1), on raw (unscaled) values."""
    return df.withColumn(out, (F.col(pages) * F.col(time) / (F.col(cart) + 1)).cast("double"))


def interaction(df: DataFrame, a: str, b: str, out: str | None = None) -> DataFrame:
    """product of two columns."""
    return df.withColumn(out or f"{a}_x_{b}", (F.col(a) * F.col(b)).cast("double"))


def session_obt(processed_filled: DataFrame, gender_labels: Sequence[str],
                device_labels: Sequence[str], run_id: str, ingested_at: Column | None = None) -> DataFrame:
    """One-big-table of the written design: typed columns, one-hot flags,
    engagement score, lineage (S8; ``ingested_at`` is now unless given)."""
    df = one_hot(processed_filled, "gender", gender_labels, "gender")
    df = one_hot(df, "device_type", device_labels, "device")
    df = engagement_score(df)
    out = df.select(
        F.col("session_id").cast("long").alias("user_id"),
        F.col("age").cast("int").alias("age"),
        *[F.col(f"gender_{g}") for g in gender_labels],
        *[F.col(f"device_{d}") for d in device_labels],
        F.col("time_on_site").cast("float").alias("time_on_site"),
        F.col("pages_viewed").cast("int").alias("pages_viewed"),
        F.col("previous_purchases").cast("int").alias("previous_purchases"),
        F.col("cart_items").cast("int").alias("cart_items"),
        F.col("discount_seen").cast("byte").alias("discount_seen"),
        F.col("engagement_score").cast("float").alias("engagement_score"),
        F.col("ad_clicked").cast("byte").alias("ad_clicked"))
    return out.withColumn("pipeline_run_id", F.lit(run_id)).withColumn("ingestion_ts", F.current_timestamp() if ingested_at is None else ingested_at)
