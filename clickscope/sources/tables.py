"""Scans and sinks.

Every reader takes an explicit schema or reads Parquet (self-describing), so
no job ever infers types from data at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.functions import checksums

# The tables of the test-data directory.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Schema of a raw session file (one row per user session).
RAW_SESSION_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("gender", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("time_on_site", T.DoubleType()),
    T.StructField("pages_viewed", T.DoubleType()),
    T.StructField("previous_purchases", T.DoubleType()),
    T.StructField("cart_items", T.DoubleType()),
    T.StructField("discount_seen", T.DoubleType()),
    T.StructField("returning_user", T.DoubleType()),
    T.StructField("avg_session_time", T.DoubleType()),
    T.StructField("bounce_rate", T.DoubleType()),
    T.StructField("purchase", T.DoubleType()),
    T.StructField("ad_clicked", T.DoubleType()),
])

# Text markers read as missing (the pandas CSV defaults).
NULL_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                "n/a", "nan", "null")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one test table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_clean_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """:func:`read_table` with NaN of float columns as null (F1): done at the
    source, as Spark's ``avg`` and ``max`` propagate NaN."""
    from clickscope.functions.columns import normalise_missing
    return normalise_missing(read_table(spark, sf_dir, name), markers=())


def read_csv_folder(spark: SparkSession, path: str,
                    schema: T.StructType = RAW_SESSION_SCHEMA,
                    mode: str = "FAILFAST") -> DataFrame:
    """Header CSV with an explicit schema over the WHOLE folder.

    Text null markers become null for string columns (F1).  A malformed row
    fails the job; with ``mode="PERMISSIVE"`` its text is kept in the column
    ``_corrupt_record`` (null for good rows), so no value is lost unseen.
    """
    if mode == "PERMISSIVE" and "_corrupt_record" not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.schema(schema).option("header", True).option("mode", mode)
          .option("nanValue", "NaN").csv(path))
    from clickscope.functions.columns import normalise_missing
    return normalise_missing(df)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, replace_partitions: bool = False) -> None:
    """Table write; ``overwrite`` replaces, ``append``/``error`` map 1:1.
    ``replace_partitions``: only the partitions that ``df`` has."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if replace_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`write_table`, partition columns as text."""
    return spark.read.option("inferTypes", False).parquet(path)


def landing_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Files of a landing folder with size and mtime; no bytes are read
    unless ``content`` is."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def landing_listing(spark: SparkSession, path: str, glob: str = "*.csv",
                    part: int = checksums.PART) -> DataFrame:
    """Files of a landing folder with size, mtime and SHA-256.

    ``binaryFile`` reads files of up to ``part`` bytes in parallel on
    executors, their checksum is computed JVM-side.  Larger ones are hashed
    when this is called, a part per task (:func:`checksums.file_digests`);
    compressed ones have no parts to read and go whole like the small ones, as
    do all where the OpenSSL functions are missing (up to 2 GB a file).
    """
    files = landing_files(spark, path, glob)
    hashed = ["path", "length", "modificationTime", F.sha2("content", 256).alias("sha256")]
    is_large = F.col("length") > part
    seen = files.where(is_large).select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("uri"))
    large = seen.collect() if checksums.resumable() else []
    by_parts = [r for r in large if checksums.splittable(spark, r["path"])]
    if not by_parts:
        return files.select(*hashed)
    digests = checksums.file_digests(spark, [(r["path"], r["length"]) for r in by_parts], part)
    now = {(r["path"], r["length"], r["modificationTime"]) for r in landing_files(spark, path, glob).where(is_large).select("path", "length", "modificationTime").collect()}
    if changed := [r["path"] for r in by_parts if (r["path"], r["length"], r["modificationTime"]) not in now]:
        raise RuntimeError(f"changed while they were read: {changed}")
    found = files.where(~is_large).select(*hashed)
    whole = [r["uri"] for r in large if r not in by_parts]
    if whole:
        found = found.unionAll(files.where(F.col("_metadata.file_path").isin(whole)).select(*hashed))
    digests = spark.createDataFrame(digests, "path string, sha256 string")
    return found.unionAll(seen.drop("uri").join(F.broadcast(digests), "path"))
