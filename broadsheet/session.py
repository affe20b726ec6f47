"""Session defaults the operators rely on, and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# UTC keeps every parsed date an absolute instant; the AQE switches let Spark choose
# partition counts, split skewed join partitions and pick broadcast joins by measured size.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Texts take long for their size, so splits are small and small files are not packed tightly.
    "spark.sql.files.maxPartitionBytes": "33554432",
    "spark.sql.files.openCostInBytes": "4194304",
}


def build_session(app_name: str = "broadsheet", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a job's files, under the cluster's ``spark.checkpoint.dir``.

    Only a local master may do without that setting; on a cluster a folder of one machine
    would hide the files from the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="broadsheet-")
    return f"{root.rstrip('/')}/broadsheet-{name}-{os.urandom(8).hex()}"


def written(df: DataFrame, name: str) -> DataFrame:
    """A table written to a folder of its own and read back, which cuts its lineage."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that nothing refers to any more.

    Spark drops them when the driver collects their handles, which may otherwise take long to happen.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more, and release shuffle files.

    Only for tables whose results are written themselves: a lost task must not need them again.
    """
    for table in tables:
        if (at := getattr(table, "stored_at", None)) is not None:
            context = table.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    for spark in {id(t.sparkSession): t.sparkSession for t in tables}.values():
        release(spark)
