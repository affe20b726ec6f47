"""Dictionaries and word lists kept as text files.

Large ones (language codes, call number classes, stop words per language) are not shipped:
callers pass the path or a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Above this a word list is not a constant any more and must be joined as a table.
MAX_INLINE_WORDS = 20_000


def parse_lookup(lines: DataFrame) -> DataFrame:
    """``key = value`` lines (column ``value``) as (key, label).

    Blank lines and ``#`` comments are dropped; the value ``null`` becomes NULL, which means
    "drop values with this key".
    """
    text = F.trim(F.col("value"))
    parts = F.split(text, " *= *", 2)
    return lines.where((text != "") & ~text.startswith("#") & text.contains("=")).select(
        F.get(parts, 0).alias("key"), F.nullif(F.get(parts, 1), F.lit("null")).alias("label")
    )


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    return parse_lookup(spark.read.text(path))


def parse_word_list(lines: DataFrame) -> DataFrame:
    """Word list lines as (word): ``#`` starts a comment line, ``|`` a comment anywhere.

    A line may hold several words.
    """
    body = F.trim(F.split("value", r"\|", 2)[0])
    return lines.where((body != "") & ~body.startswith("#")).select(F.explode(F.split(body, r"\s+")).alias("word"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_word_list(spark.read.text(path))


def inline_words(words: DataFrame, limit: int = MAX_INLINE_WORDS) -> tuple[str, ...]:
    """Bring a word list to the driver as a constant, refusing lists over ``limit``."""
    rows = words.select("word").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"word list has more than {limit} words; join it as a table instead")
    return tuple(sorted(r.word for r in rows))
