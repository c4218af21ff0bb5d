"""Small shared helpers of the training-data operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

from clickscope.session import cut_lineage

#: A side is broadcast only when its counted rows stay under this.
BROADCAST_ROWS = 200_000
#: And only when the bytes of its values, added up, stay under this.
BROADCAST_BYTES = 128 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches set to few rows: a batch of
    whole texts has to fit in a Python worker's memory."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 500), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        if not 0 < int(conf.get(key).rstrip("b")) <= most:
            conf.set(key, str(most))
    return df


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``cut_lineage`` wrote, once the tables made from
    them are written: a long chain of steps then holds a few of them at a time."""
    for df in tables:
        files = df.inputFiles()
        if files and "/clickscope-tables/" in files[0]:
            jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
            at = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            at.getFileSystem(conf).delete(at, True)


def value_bytes(c: Column, kind: DataType) -> Column:
    """About the bytes that a value takes in memory."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long") + 16
    if isinstance(kind, StructType):
        return reduce(lambda a, b: a + b, [value_bytes(c.getField(f.name), f.dataType) for f in kind.fields], F.lit(16).cast("long"))
    if isinstance(kind, ArrayType):
        inner = F.aggregate(c, F.lit(16).cast("long"), lambda n, x: n + value_bytes(x, kind.elementType))
        if not isinstance(kind.elementType, (StringType, BinaryType, StructType, ArrayType)):
            inner = F.size(c).cast("long") * 8 + 16
        return F.greatest(F.coalesce(inner, F.lit(8)), F.lit(8))
    return F.lit(8).cast("long")


def small_side(df: DataFrame, rows: int | None = None, size: int | None = None) -> DataFrame:
    """``df`` written once, marked for broadcast if its counted rows and bytes
    are few; a larger one is left to a shuffled join."""
    df = cut_lineage(df, "side")
    held = df.agg(F.count("*"), F.coalesce(F.sum(reduce(lambda a, b: a + b, [value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])), F.lit(0))).first()
    few = held[0] <= (BROADCAST_ROWS if rows is None else rows) and held[1] <= (BROADCAST_BYTES if size is None else size)
    return F.broadcast(df) if few else df


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def row_key(df: DataFrame) -> Column:
    """128-bit identity of a whole row (equal rows share it)."""
    cols = [F.struct(F.col(f"`{c}`").isNull().alias("n"), F.col(f"`{c}`").alias("v")) for c in sorted(df.columns)]
    return F.struct(F.xxhash64(F.lit(1), *cols).alias("a"), F.xxhash64(F.lit(2), *cols).alias("b"))


def minimum_labels(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge table: ``(node, label)`` with
    the smallest node of the component as its label.

    Each round replaces every edge by edges to the smallest known label of its
    ends (minimum by partial aggregation, no neighbour lists) and follows the
    label's own label, so chains shorten geometrically; the table of a round is
    written, so a lost executor repeats one round only.
    """
    edges = cut_lineage(edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = cut_lineage(both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = (both.join(labels, both["v"] == labels["node"]).groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = cut_lineage(step.join(up, "label", "left").select("node", "old", F.least("label", "up").alias("label")), "labels")
        discard(labels)
        labels = step.select("node", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            discard(edges)
            return labels
    raise RuntimeError(f"labels still move after {max_rounds} rounds")
