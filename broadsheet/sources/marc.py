"""Catalogue records from a flattened table of fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.functions.charset import decode_escaped
from broadsheet.schemas import MARC_SCHEMA

BAD_CHARSET = "BAD_CHARSET"


def read_marc_table(spark: SparkSession, path: str) -> DataFrame:
    """Records already stored in the nested shape."""
    return spark.read.schema(MARC_SCHEMA).parquet(path)


def assemble_marc(rows: DataFrame) -> DataFrame:
    """Nest flat rows (record_id, leader, field_no, tag, ind1, ind2, data, sub_no, code, value).

    Input is one row per subfield, or per control field with ``code`` NULL. Malformed records,
    i.e. those without an id, without a 001 field or with a tag that is not three characters,
    are left out. The exchange format limits a record to 99,999 bytes, which bounds the groups.
    """
    placed = rows.where(F.col("record_id").isNotNull())
    item = F.struct("field_no", "sub_no", "code", "value")
    fields = (
        placed.groupBy("record_id", "leader", "field_no", "tag", "ind1", "ind2", "data")
        .agg(F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), item))).alias("subs"))
        .select(
            "record_id",
            "leader",
            F.struct(
                "field_no",
                "tag",
                "ind1",
                "ind2",
                "data",
                F.transform("subs", lambda s: F.struct(s["code"].alias("code"), s["value"].alias("value"))).alias("subfields"),
            ).alias("f"),
        )
    )
    return (
        fields.groupBy("record_id", "leader")
        .agg(
            F.array_sort(F.collect_list("f")).alias("fs"),
            F.count_if(F.col("f.tag") == "001").alias("ids"),
            F.count_if(F.length("f.tag") != 3).alias("bad"),
        )
        .where((F.col("ids") > 0) & (F.col("bad") == 0))
        .select(
            "record_id",
            "leader",
            F.transform(
                "fs",
                lambda f: F.struct(
                    f["tag"].alias("tag"),
                    f["ind1"].alias("ind1"),
                    f["ind2"].alias("ind2"),
                    f["data"].alias("data"),
                    f["subfields"].alias("subfields"),
                ),
            ).alias("fields"),
        )
    )


def normalised_rows(rows: DataFrame) -> DataFrame:
    """Flat rows with ``data`` and ``value`` as composed Unicode, and ``mapped``: whether that succeeded.

    A record whose leader has ``a`` in place 9 is Unicode already. Any other is in the catalogue's default
    set, its bytes given as characters below 256.
    """
    unicode = F.coalesce(F.substring("leader", 10, 1) == "a", F.lit(False))
    for name in ("data", "value"):
        rows = rows.withColumn(f"_{name}", F.when(~unicode, decode_escaped(F.col(name))))
    told = rows.withColumn("mapped", F.coalesce("_data.mapped", F.lit(True)) & F.coalesce("_value.mapped", F.lit(True)))
    for name in ("data", "value"):
        told = told.withColumn(name, F.when(unicode, F.col(name)).otherwise(F.col(f"_{name}.text")))
    return told.drop("_data", "_value")


def split_by_charset(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flat rows of the records that could be mapped in whole, and rejects (record_id, reason) of the others."""
    told = normalised_rows(rows)
    bad = told.where(~F.col("mapped")).select("record_id").distinct()
    good = told.join(bad, "record_id", "left_anti").drop("mapped")
    return good, bad.select("record_id", F.lit(BAD_CHARSET).alias("reason"))
