"""Issue manifests: one quoted CSV line, or one ctrl-A separated line, per issue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.functions.naming import digi_date, parse_filename, pub_date
from broadsheet.functions.shape import computed
from broadsheet.schemas import MANIFEST_COLUMNS, MANIFEST_SCHEMA

OK = "OK"
HEADER = "HEADER"
BAD_LINE = "BAD_LINE"
BAD_FILENAME = "BAD_FILENAME"


def _balanced_quotes(line: Column) -> Column:
    """True when the line has an even number of quotes that are not backslash-escaped.

    The CSV parser accepts a last field whose quote never closes, so this is checked apart.
    """
    bare = F.regexp_replace(line, r"\\.", "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2 == 0


def _csv_fields(line: Column) -> Column:
    # A doubled quote inside a field is the same as an escaped one. An empty field looks alike,
    # but follows a comma and is followed by one.
    doubled = '(?<=[^,])""(?!$)|(?<=,)""(?=[^,"])'
    escaped = F.regexp_replace(line, doubled, r'\\"')
    return F.from_csv(escaped, MANIFEST_SCHEMA.toDDL(), {"mode": "PERMISSIVE", "escape": "\\"})


def _ctrl_a_fields(line: Column) -> Column:
    parts = F.split(line, "\x01")
    return F.struct(*[F.get(parts, i).alias(c) for i, c in enumerate(MANIFEST_COLUMNS)])


def _typed(lines: DataFrame, fields: Column, well_formed: Column) -> DataFrame:
    name = parse_filename(F.col("m.originalname"))
    parsed = computed(lines, [F.col("value").alias("line")], [fields.alias("m"), well_formed.alias("well_formed")])
    row = parsed.select(
        "line",
        "well_formed",
        F.col("m.entityid").alias("entityid"),
        F.col("m.simpletitle").alias("simpletitle"),
        F.col("m.originalname").alias("originalname"),
        F.col("m.recordcreated_dt").alias("recordcreated_dt"),
        F.col("m.domid").alias("domid"),
        name.alias("name"),
    )
    published = pub_date(F.col("name.year"), F.col("name.month"), F.col("name.day"))
    status = (
        F.when(F.col("entityid") == "entityid", HEADER)
        .when(~F.col("well_formed") | F.col("domid").isNull(), BAD_LINE)
        .when(published.isNull(), BAD_FILENAME)
        .otherwise(OK)
    )
    return row.select(
        status.alias("status"),
        "line",
        "domid",
        "simpletitle",
        "originalname",
        F.col("name.npid").alias("npid"),
        F.col("name.year").alias("year"),
        published.alias("pub_date"),
        digi_date(F.col("recordcreated_dt")).alias("digi_date"),
    )


def parse_manifest(lines: DataFrame) -> DataFrame:
    """Parse quoted CSV lines (column ``value``), giving every line a status.

    ``OK`` rows carry the typed issue attributes. Header lines may occur anywhere, as the
    check is per line. Unused manifest columns are not carried.
    """
    return _typed(lines, _csv_fields(F.col("value")), _balanced_quotes(F.col("value")))


def parse_manifest_ctrl_a(lines: DataFrame) -> DataFrame:
    """Parse ctrl-A separated lines (column ``value``); no quoting in this form."""
    return _typed(lines, _ctrl_a_fields(F.col("value")), F.lit(True))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def read_manifest_ctrl_a(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest_ctrl_a(spark.read.text(path))


def accepted(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status") == OK).drop("status", "line")


def rejected(manifest: DataFrame) -> DataFrame:
    """Lines that name no readable issue, with the reason. Headers are not rejects."""
    return manifest.where(~F.col("status").isin(OK, HEADER)).select("line", F.col("status").alias("reason"))
