"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings every job relies on. All are run-time settings, so they also hold
# for a session that somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, whose tasks
    run on this very machine, may do without: it gets a temporary folder per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"file://{tempfile.gettempdir()}/slotwise-{spark.sparkContext.applicationId}"


def new_work_dir(spark: SparkSession, label: str) -> str:
    return f"{work_root(spark)}/slotwise/{label}-{uuid.uuid4().hex}"


def persist_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and gives the
    optimizer the true size of the result.
    """
    spark = df.sparkSession
    path = new_work_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deal_table(df: DataFrame, label: str) -> DataFrame:
    """`persist_table` with the rows dealt out by their hash into one file per shuffle partition.

    For rows that cost far more than their bytes tell: adaptive execution would write them
    to one or two files, and whatever reads those has as many tasks.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return persist_table(df.repartition(parts, F.xxhash64(*df.columns)), label)
