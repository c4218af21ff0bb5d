"""Column-expression helpers (JVM-side built-ins only, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """P10: numeric columns in schema order, minus an exclusion list."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """P10: string (categorical) columns in schema order."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def normalise_missing(df: DataFrame, markers: Iterable[str] | None = None) -> DataFrame:
    """NaN -> null for float columns, text null markers -> null for strings.

    Done once at the source so that every later aggregate is null-aware
    (Spark's ``avg``/``max`` propagate NaN, pandas skips it).
    """
    if markers is None:
        from clickscope.sources.tables import NULL_MARKERS
        markers = NULL_MARKERS
    markers = list(markers)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType) and markers:
            c = F.when(F.trim(c).isin(markers), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def safe_div(num: Column, den: Column, zero: float | None = 0.0) -> Column:
    """num/den as DOUBLE; 0/0 (or x/0) gives ``zero`` (scikit-learn's rule)."""
    res = num.cast("double") / den.cast("double")
    if zero is None:
        return F.when(den != 0, res)
    return F.when(den != 0, res).otherwise(F.lit(zero))


def r6(c: Column | str) -> Column:
    """Round a float output to 6 places (oracle hygiene, both engines)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def hash_order_key(key: Column | str, seed: int) -> Column:
    """Seeded pseudo-random order: md5 of ``key:seed`` as hex text.

    The same string is produced by DuckDB's ``md5(concat_ws(':', key, seed))``,
    so every split is reproducible outside Spark.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", k.cast("string"), F.lit(str(seed))))


def hash_bucket(order_key: Column, bits: int) -> Column:
    """Leading ``bits`` of an md5 hex key as an integer bucket (uniform)."""
    hex_digits = max(1, (bits + 3) // 4)
    raw = F.conv(F.substring(order_key, 1, hex_digits), 16, 10).cast("long")
    return F.shiftright(raw, hex_digits * 4 - bits)


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 for TIMESTAMP or TIMESTAMP_NTZ.

    Works on the wall-clock value (cast to TIMESTAMP_NTZ), so the result
    never depends on the session time zone.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND",
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))
