"""Ready-made records as CSV, JSON or XML documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_ADD_DOC = "field ARRAY<STRUCT<_VALUE: STRING, _name: STRING>>"


def _field_values(fields: Column, name: str) -> Column:
    return F.transform(F.filter(fields, lambda f: f["_name"] == name), lambda f: f["_VALUE"])


def _from_fields(fields: Column, schema: T.StructType) -> list[Column]:
    """Columns of ``schema`` out of (name, value) pairs; a repeated plain field: last wins."""
    out = []
    for field in schema.fields:
        values = _field_values(fields, field.name)
        if isinstance(field.dataType, T.ArrayType):
            kept = F.when(F.size(values) > 0, values)
            out.append(kept.try_cast(field.dataType).alias(field.name))
        else:
            out.append(F.try_element_at(values, F.lit(-1)).try_cast(field.dataType).alias(field.name))
    return out


def parse_csv_docs(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """CSV lines (column ``value``) to typed rows."""
    return lines.select(F.from_csv("value", schema.toDDL()).alias("r")).select("r.*")


def parse_json_docs(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines (column ``value``) to typed rows."""
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def parse_xml_docs(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``<doc><field name="..">..</field></doc>`` strings (column ``value``) to typed rows."""
    doc = lines.select(F.from_xml("value", _ADD_DOC, {"ignoreSurroundingSpaces": "false"}).alias("r"))
    return doc.select(*_from_fields(F.col("r.field"), schema))


def read_csv_docs(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=header)


def read_json_docs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.json(path, schema=schema)


def read_xml_docs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files of ``<add><doc>…</doc>…</add>``; files are split between tasks at ``<doc>``."""
    docs = spark.read.format("xml").option("rowTag", "doc").schema(_ADD_DOC).load(path)
    return docs.select(*_from_fields(F.col("field"), schema))


def _named(items: Column, name: str) -> Column:
    return F.transform(items, lambda v: F.struct(F.lit(name).alias("field"), v.alias("value")))


def export_long(df: DataFrame, key: str) -> DataFrame:
    """Rows to (doc, field, value) triples: ``score`` dropped, arrays repeated, NULLs absent."""
    triples = []
    for field in df.schema.fields:
        if field.name == "score":
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            items = F.filter(F.transform(value, lambda v: v.cast("string")), lambda v: v.isNotNull())
        else:
            items = F.when(value.isNotNull(), F.array(value.cast("string")))
        items = F.coalesce(items, F.array().cast("array<string>"))
        triples.append(_named(items, field.name))
    return df.select(F.col(key).alias("doc"), F.inline(F.concat(*triples)))
