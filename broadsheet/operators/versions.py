"""Snapshots of a log of batches: complete versions that say which batch they end with.

A version is a folder of rows and a record (number, folder, last batch). The record is what makes it
visible: it is created under the version's number only if there is none yet, which file systems do as one
step, so of two writers that compact at once one wins and the other is told. The present content is the
newest version and the batches after its last one; older batches need not be read.
"""

from __future__ import annotations

import json
import os
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.operators.maintain import latest_per_key

RECORDS = "_versions"  # read as no part of the log, by its first letter
DATA = "_data"


class VersionConflict(Exception):
    """Another writer has published this version."""


class Version(NamedTuple):
    number: int
    folder: str
    last_batch: int


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    _, root, fs = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches whose write has finished, in order."""
    found = [n for n in _names(spark, path) if n.startswith("batch_id=")]
    return sorted(int(n.split("=")[1]) for n in found if "_SUCCESS" in _names(spark, f"{path}/{n}"))


def newest_version(spark: SparkSession, path: str) -> Version | None:
    """The version that readers see, if any has been published."""
    numbers = [int(n) for n in _names(spark, f"{path}/{RECORDS}") if n.isdigit()]
    if not numbers:
        return None
    jvm, _, fs = _files(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{path}/{RECORDS}/{max(numbers):010d}"))
    try:
        text = bytearray(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return Version(**json.loads(text))


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Make a version visible, or raise ``VersionConflict`` if its number is taken."""
    jvm, record, fs = _files(spark, f"{path}/{RECORDS}/{version.number:010d}")
    try:
        stream = fs.create(record, False)
    except Exception as error:  # the gateway wraps what the file system throws
        if fs.exists(record):
            raise VersionConflict(f"version {version.number} of {path} exists") from error
        raise
    stream.write(bytearray(json.dumps(version._asdict()).encode()))
    stream.close()


def _batch_rows(spark: SparkSession, path: str, ids: list[int]) -> DataFrame | None:
    """Rows of some batches with ``batch_id``; only their folders are listed."""
    if not ids:
        return None
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={i}" for i in ids])
    return rows.withColumn("batch_id", F.col("batch_id").cast("long"))


def committed(spark: SparkSession, path: str, key: str = "id", upto: int | None = None) -> DataFrame | None:
    """The present content: each key's row from its latest batch, in the newest version or after it."""
    version = newest_version(spark, path)
    after = -1 if version is None else version.last_batch
    ids = [i for i in batches(spark, path) if i > after and (upto is None or i <= upto)]
    newer = _batch_rows(spark, path, ids)
    if version is None:
        return None if newer is None else latest_per_key(newer, key, "batch_id").drop("batch_id")
    base = spark.read.parquet(f"{path}/{version.folder}")
    if newer is None:
        return base
    fresh = latest_per_key(newer, key, "batch_id").drop("batch_id")
    kept = base.join(fresh.select(key), key, "left_anti").select(*base.columns)
    return kept.unionByName(fresh, allowMissingColumns=True)


def compact(spark: SparkSession, path: str, key: str = "id") -> Version | None:
    """Write the present content as the next version and publish it; None without anything new.

    Batches that arrive meanwhile are not in it, as it ends with the last batch found at first. On a
    ``VersionConflict`` nothing is lost: what was written is not referred to by any record.
    """
    version, ids = newest_version(spark, path), batches(spark, path)
    if not ids or (version is not None and ids[-1] <= version.last_batch):
        return None
    number = 1 if version is None else version.number + 1
    folder = f"{DATA}/{number:010d}-{os.urandom(8).hex()}"
    committed(spark, path, key, ids[-1]).write.parquet(f"{path}/{folder}")
    made = Version(number, folder, ids[-1])
    publish(spark, path, made)
    return made
