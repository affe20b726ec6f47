"""Column functions for cleaning and showing text. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EDGE_CONTROLS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def trim_controls(text: Column) -> Column:
    """Drop leading and trailing characters up to U+0020 (SQL ``trim`` drops spaces only)."""
    return F.regexp_replace(text, _EDGE_CONTROLS, "")


def collapse_ws(text: Column) -> Column:
    """Runs of space, newline and tab become one space; edges are trimmed.

    Carriage returns and no-break spaces inside the text are kept.
    """
    return trim_controls(F.regexp_replace(text, "[ \n\t]+", " "))


def clean_label(text: Column) -> Column:
    """Trim, then turn each newline into a space. Runs are not collapsed."""
    return F.translate(trim_controls(text), "\n", " ")


def text_length(text: Column) -> Column:
    """Length in characters; a missing text has length 0."""
    return F.coalesce(F.length(text), F.lit(0))


def preview(text: Column, n: int = 100) -> Column:
    return F.substring(text, 1, n)


def utc_format(ts: Column) -> Column:
    """ISO instant with a literal ``Z``; the session runs in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def html_escape(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def natural_key(name: Column) -> Column:
    """Sort key under which digit runs compare as numbers: ``shard2`` before ``shard10``.

    A run is written as the number of its digits, in ten places, and the digits themselves, so
    runs of any length keep their order.
    """
    runs = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))
    digits = lambda r: F.regexp_replace(r, "^0+(?=.)", "")
    padded = F.transform(
        runs,
        lambda r: F.when(
            r.rlike(r"^\d"), F.concat(F.lpad(F.length(digits(r)).cast("string"), 10, "0"), digits(r))
        ).otherwise(r),
    )
    return F.array_join(padded, "")


def field_list(fields: Column, pattern: str) -> Column:
    """Names in a map column that match ``pattern``, sorted."""
    return F.array_sort(F.filter(F.map_keys(fields), lambda k: k.rlike(pattern)))
