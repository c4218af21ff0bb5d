"""Spark session and checkpoint-directory helpers.

The library never assumes a machine-local folder on a cluster: it reads
``spark.checkpoint.dir`` from the session and only invents a scratch folder
when the master is ``local[...]`` (tests, the bench) and nothing is set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "clickscope",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with the settings every operator relies on.

    * AQE on (coalesce small shuffles, split skewed join partitions);
    * session time zone UTC (``events.ts`` is TIMESTAMP_NTZ; windows and
      watermarks need a TIMESTAMP cast that must not depend on the host);
    * UI off (no server is opened).
    """
    master = master or os.environ.get("CLICKSCOPE_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("CLICKSCOPE_SHUFFLE_PARTITIONS", "8"))
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("CLICKSCOPE_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster the directory must be given by the deployment
    (``spark.checkpoint.dir`` on a shared file system); a local scratch folder
    is created only for ``local`` masters where nothing was configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="clickscope-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and
    read it back: later jobs start from the table (lineage cut, survives
    executor loss, and still gets column pruning / filter pushdown, unlike an
    RDD checkpoint).  Never ``localCheckpoint``."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "clickscope-tables",
                        f"{name}-{uuid.uuid4().hex[:16]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(conf).exists(at)


def durable_dir(spark: SparkSession) -> str:
    """Folder of what outlives a run (models, run log): the session setting
    ``spark.clickscope.home``, else the shared warehouse; with neither on a
    ``local`` master (tests) the scratch folder."""
    home = spark.conf.get("spark.clickscope.home", None)
    if home:
        return home
    given = spark.sparkContext.getConf().get("spark.sql.warehouse.dir", None)
    if given or not spark.sparkContext.master.startswith("local["):
        return os.path.join(given or spark.conf.get("spark.sql.warehouse.dir"), "clickscope")
    return os.path.join(ensure_checkpoint_dir(spark), "clickscope-home")


_STAGES: dict = {}


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files below ``path`` (two levels)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)

    def listing(at, depth):
        if not fs.exists(at):
            return
        for st in fs.listStatus(at):
            yield st.getPath().getName(), st.getLen(), st.getModificationTime()
            if depth and st.isDirectory():
                yield from listing(st.getPath(), depth - 1)

    return tuple(sorted(listing(jvm.org.apache.hadoop.fs.Path(path), 1)))


def stage_table(spark: SparkSession, key: tuple, build) -> DataFrame:
    """A pipeline stage output written once per Spark application and state of
    its input, and reused by every later consumer (the ELT hand-off between
    stages).  Folder names in ``key`` stand for the files in them: after a
    change of the source the stage is built anew."""
    files = tuple(folder_state(spark, x) for x in key if isinstance(x, str) and "/" in x)
    k = (spark.sparkContext.applicationId, files) + tuple(key)
    hit = _STAGES.get(k)
    if hit is None:
        hit = cut_lineage(build(), name=str(key[0]))
        _STAGES[k] = hit
    return hit
