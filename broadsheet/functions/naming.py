"""Parts of manifest values: file names, dates, ids, shard numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_filename(name: Column) -> Column:
    """``PREF-yyyy-MM-dd.xml`` as a struct; parts beyond the name's end are NULL."""
    parts = F.split(F.replace(name, F.lit(".xml"), F.lit("")), "-")
    return F.struct(
        F.get(parts, 0).alias("npid"),
        F.get(parts, 1).alias("year"),
        F.get(parts, 2).alias("month"),
        F.get(parts, 3).alias("day"),
    )


def pub_date(year: Column, month: Column, day: Column) -> Column:
    """Midnight UTC of the publication day; NULL if a part is missing or it is not a date."""
    return F.try_to_timestamp(F.concat(year, F.lit("-"), month, F.lit("-"), day))


def digi_date(stamp: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f`` read as a UTC instant; NULL if malformed."""
    return F.try_to_timestamp(stamp)


def prefixed_id(local_id: Column, prefix: str) -> Column:
    """Global record id; NULL stays NULL, so such rows can be rejected later."""
    return F.concat(F.lit(prefix), local_id)


def issue_address(domid: Column, prefix: str, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix.rstrip("/") + "/"), domid, F.lit(suffix))


def shard_of(key: Column, shards: int = 4) -> Column:
    """Stable shard number of a key in ``[0, shards)``."""
    if shards <= 0:
        raise ValueError(f"number of shards must be positive, got {shards}")
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(shards)).cast("int")


def signature(*fields: Column) -> Column:
    """Hash over chosen fields, used as an id for exact-copy detection."""
    parts = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    return F.md5(F.concat_ws("\x1f", *parts))
