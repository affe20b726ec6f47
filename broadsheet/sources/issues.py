"""Issue XML found under a common prefix, keyed by the id in its address."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F


# ---- fixed values: how many files are asked for by name, and how many in one listing ---
MOST_LISTED = 10_000
LISTED_AT_ONCE = 200


def read_issue_xml(spark: SparkSession, prefix: str, suffix: str = "") -> DataFrame:
    """Every document at ``prefix/<domid><suffix>`` as (domid, xml).

    The files are listed and packed into tasks by Spark; nothing is fetched row by row. A file
    declared as Latin-1 or ASCII is read so. Any other file must hold UTF-8; one that doesn't
    gets a NULL, which extraction reports as broken XML.
    """
    return _documents(spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(prefix), suffix)


def read_issue_files(spark: SparkSession, wanted: DataFrame, prefix: str, suffix: str = "") -> DataFrame:
    """The documents of ``wanted`` (domid) only, those that exist; no other file is listed or read.

    Meant for a job's or a micro-batch's own manifest: its ids, at most ``MOST_LISTED``, are looked up by name.
    With more of them, or ids that are no plain names, the whole prefix is listed and cut by the ids.
    """
    ids = wanted.select("domid").where("domid is not null").distinct()
    names = [r["domid"] for r in ids.limit(MOST_LISTED + 1).collect()]
    if len(names) > MOST_LISTED or not all(re.fullmatch(r"[\w.-]+", n) for n in names):
        return read_issue_xml(spark, prefix, suffix).join(ids, "domid", "left_semi")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(prefix)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for at in range(0, len(names), LISTED_AT_ONCE):
        some = "{" + ",".join(names[at : at + LISTED_AT_ONCE]) + "}"
        found += [str(f.getPath()) for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{prefix.rstrip('/')}/{some}{suffix}")) or []]
    if not found:
        return spark.createDataFrame([], "domid string, xml string")
    return _documents(spark.read.format("binaryFile").load(found), suffix)


def _documents(files: DataFrame, suffix: str) -> DataFrame:
    domid = F.regexp_extract("path", "([^/]+)" + re.escape(suffix) + "$", 1)
    start = F.decode(F.substring("content", 1, 200), "ISO-8859-1")
    declared = F.upper(F.regexp_extract(start, r"""^\s*<\?xml[^>]*?encoding\s*=\s*["']([\w.:-]+)["']""", 1))
    text = F.col("content").cast("string")
    xml = F.when(declared.isin("ISO-8859-1", "LATIN1", "LATIN-1", "US-ASCII", "ASCII"), F.decode("content", "ISO-8859-1")).when(
        F.is_valid_utf8(text), text
    )
    return files.select(domid.alias("domid"), xml.alias("xml"))


def read_issue_archive(spark: SparkSession, path: str) -> DataFrame:
    """Issue documents packed as a (domid, xml) table: the layout to use for many issues."""
    return spark.read.parquet(path).select("domid", "xml")
