"""Cast text fields to the type their name's suffix declares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.schemas import SUFFIX_TYPES


def suffix_type(name: str) -> str | None:
    """Declared type of a field: ``ignored`` / a type name / None when nothing matches."""
    if name.startswith("ignored_"):
        return "ignored"
    if name.startswith("attr_"):
        return "array<string>"
    matches = [s for s in SUFFIX_TYPES if name.endswith(s)]
    return SUFFIX_TYPES[max(matches, key=len)] if matches else None


def cast_field(value: Column, kind: str) -> Column:
    """Tolerant cast: text that is not of the type becomes NULL."""
    if kind == "latlon":
        parts = F.split(value, ",")
        return F.when(
            value.isNotNull(),
            F.struct(
                F.trim(F.get(parts, 0)).try_cast("double").alias("lat"),
                F.trim(F.get(parts, 1)).try_cast("double").alias("lon"),
            ),
        )
    if kind == "currency":
        parts = F.split(value, ",")
        return F.when(
            value.isNotNull(),
            F.struct(
                F.trim(F.get(parts, 0)).try_cast("decimal(18,4)").alias("amount"),
                F.coalesce(F.trim(F.get(parts, 1)), F.lit("USD")).alias("code"),
            ),
        )
    return value.try_cast(kind)


def cast_by_suffix(df: DataFrame) -> DataFrame:
    """Apply the suffix types to string (or string-array) columns; drop ``ignored_*``."""
    out = []
    for name in df.columns:
        kind = suffix_type(name)
        if kind == "ignored":
            continue
        if kind is None or kind == "string":
            out.append(F.col(name))
        elif kind.startswith("array<") and df.schema[name].dataType.typeName() != "array":
            out.append(cast_field(F.array(F.col(name)), kind).alias(name))
        else:
            out.append(cast_field(F.col(name), kind).alias(name))
    return df.select(*out)
