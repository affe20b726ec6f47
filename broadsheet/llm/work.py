"""The folder that all executors share, and tables written to it to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder for local runs."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="broadsheet-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back."""
    path = f"{work_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more.

    Only for tables whose results are stored themselves: a lost task must not need them again.
    """
    jvm = spark.sparkContext._jvm
    for table in tables:
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that nothing refers to any more.

    Spark drops them when the driver collects their handles, which may otherwise take long to happen.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


# Texts are long: batches to Python workers are limited by bytes, so that these stay small.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application, and size their batches."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="broadsheet-src-")) / f"{package.name}_src.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)
