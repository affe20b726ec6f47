"""Routing of ids on a hash ring: a 32-bit hash of the id's bytes, and even ranges of it.

The hash is the public-domain 32-bit Murmur hash (third version, seed 0) over UTF-8 bytes, in column
arithmetic. A composite id ``a!b`` takes its upper half from ``a`` and its lower half from ``b``, so that
all that begins with ``a!`` lies together. Ranges cut the signed ring evenly, in whole domains of the
upper half, so no domain is split.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from broadsheet.functions.shape import let

# ---- fixed values: constants of the published hash ------------------------------------
C1, C2 = 0xCC9E2D51, 0x1B873593
ADD = 0xE6546B64
MIX1, MIX2 = 0x85EBCA6B, 0xC2B2AE35

SEPARATOR = "!"
_MASK = (1 << 32) - 1


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_MASK))


def _times(value: Column, factor: int) -> Column:
    """Product of 32-bit numbers modulo 2**32; in halves, so that 64 bits hold what is added."""
    upper = F.shiftleft((value * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)
    return _low(value * F.lit(factor & 0xFFFF) + upper)


def _rotated(value: Column, bits: int) -> Column:
    return _low(F.shiftleft(value, bits)).bitwiseOR(F.shiftright(value, 32 - bits))


def _shifted(value: Column, bits: int) -> Column:
    return let(value, lambda v: v.bitwiseXOR(F.shiftright(v, bits)))


def _scrambled(block: Column) -> Column:
    return _times(let(_times(block, C1), lambda k: _rotated(k, 15)), C2)


def _number(hexed: Column, start: Column, count: int) -> Column:
    """``count`` bytes from a byte on, the first the lowest, as a number."""
    pairs = [F.substring(hexed, 2 * (start + i) + 1, F.lit(2)) for i in reversed(range(count))]
    return F.conv(F.concat(*pairs), 16, 10).cast("bigint")


def murmur(text: Column) -> Column:
    """The signed 32-bit hash of a text; null for a null."""

    def of(hexed: Column) -> Column:
        size = F.floor(F.length(hexed) / 2).cast("int")
        blocks = F.floor(size / 4).cast("int")
        places = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))

        def body(state: Column, i: Column) -> Column:
            turned = let(state.bitwiseXOR(_scrambled(_number(hexed, i * 4, 4))), lambda h: _rotated(h, 13))
            return _low(turned * 5 + F.lit(ADD))

        begun = F.aggregate(places, F.lit(0).cast("bigint"), body)
        rest, left = blocks * 4, size % 4
        tail = F.lit(0).cast("bigint")
        for count in (1, 2, 3):
            tail = F.when(left == count, _scrambled(_number(hexed, rest, count))).otherwise(tail)
        mixed = _shifted(begun.bitwiseXOR(tail).bitwiseXOR(size.cast("bigint")), 16)
        mixed = _shifted(_times(mixed, MIX1), 13)
        return let(_shifted(_times(mixed, MIX2), 16), lambda h: F.when(h > F.lit(_MASK >> 1), h - F.lit(1 << 32)).otherwise(h).cast("int"))

    return F.when(text.isNotNull(), let(F.hex(F.encode(text, "UTF-8")), of))


def ring_hash(key: Column) -> Column:
    """Place of an id on the ring, signed; of a composite id, upper half by its first part, lower by the rest."""

    def of(text: Column) -> Column:
        at = F.instr(text, SEPARATOR)
        upper = murmur(F.substring(text, F.lit(1), at - 1)).bitwiseAND(F.lit(-(1 << 16)))
        lower = murmur(F.substring(text, at + 1, F.length(text))).bitwiseAND(F.lit((1 << 16) - 1))
        # A separator at either end is part of a plain id.
        return F.when((at > 1) & (at < F.length(text)), upper.bitwiseOR(lower)).otherwise(murmur(text))

    return let(key.cast("string"), of)


def ring_shard(key: Column, shards: int = 4) -> Column:
    """The range in ``[0, shards)`` that holds an id, from the ring's lowest place on."""
    if not 0 < shards <= 1 << 16:
        raise ValueError(f"number of shards must be from 1 to {1 << 16}, got {shards}")
    domain = F.shiftright(ring_hash(key).cast("bigint") + F.lit(1 << 31), 16)
    return F.shiftright(domain * shards, 16).cast("int")


def ring_ranges(shards: int) -> list[tuple[int, int]]:
    """First and last signed place of each shard's range."""
    first = [-(1 << 31) + (-(-i * (1 << 16) // shards) << 16) for i in range(shards + 1)]
    return [(a, b - 1) for a, b in zip(first, first[1:])]
