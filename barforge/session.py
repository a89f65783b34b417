"""Session helpers: UTC clock, ANSI-safe arithmetic, AQE, shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every bar job relies on. The store is UTC throughout; AQE re-plans
# shuffles at runtime (coalescing small partitions, splitting skewed ones).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Sizing defaults, applied only where the deployment has not set them: AQE
# coalesces small shuffle partitions, and splits partitions that are 5x the
# median and above the 128 MB advisory size (skew).
SIZING_DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library needs to an existing session
    (UTC clock, AQE); sizing knobs only when unset."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in SIZING_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "barforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session for local runs and tests. On a cluster the
    master and all sizing come from spark-submit: shuffle partitions and driver
    memory are set here only for a local master or when asked for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    if shuffle_partitions or (master or "").startswith("local"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    if (master or "").startswith("local") or "BARFORGE_DRIVER_MEMORY" in os.environ:
        conf["spark.driver.memory"] = os.environ.get("BARFORGE_DRIVER_MEMORY", "4g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or already set on
    the SparkContext).

    On a cluster this must come from the deployment (a shared file system). A
    folder of this machine is made only when neither is set and the master is
    local, i.e. driver and executors are one process; elsewhere it raises."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; a shared folder is needed on master {master}")
        current = tempfile.mkdtemp(prefix="barforge-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back. Every
    reader sees the same rows with the same values of non-deterministic columns
    (partition ids, positions), whatever columns it prunes and however often
    tasks are retried."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob of any Hadoop file system exists; errors of the
    file system other than a missing path are raised."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads (0 when it reads none), from their
    listing alone."""
    spark = df.sparkSession
    total = 0
    for name in df.inputFiles():
        target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        total += target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).getLen()
    return total
