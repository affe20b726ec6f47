"""A query's text analysed by the chain of the field that it asks.

The result is the query's words in order, each with its place and the terms that may stand there:
one, or several where the chain has synonyms. Folding, elision, stop words and stems thereby mean the
same to a query as to the text.
"""

from __future__ import annotations

import re
from typing import NamedTuple, Sequence

from pyspark.sql import Column, SparkSession, functions as F

from broadsheet.functions.shape import let
from broadsheet.operators.analysis import PLAIN, Analyser
from broadsheet.operators.filters import check_terms


class Slot(NamedTuple):
    """A word of a query: its place, from 0, and the terms that may stand there."""

    place: int
    terms: tuple[str, ...]


def analysed(spark: SparkSession, words: Sequence[str], analyser: Analyser = PLAIN) -> list[Slot]:
    """The slots of a query in order, repeated words included. Too many terms are an error.

    The chain is applied to one row; a query of plain words needs no job for that.
    """
    words = [w for w in words if w]
    if analyser == PLAIN and all(re.fullmatch("[a-z0-9]+", w) for w in words):
        slots = [Slot(i, (w,)) for i, w in enumerate(words)]
    else:
        row = spark.range(1).select(analyser.terms(F.lit(" ".join(words))).alias("t")).first()
        by_place: dict[int, list[str]] = {}
        for t in row["t"] or ():
            by_place.setdefault(t["pos"], []).append(t["term"])
        first = min(by_place, default=0)
        slots = [Slot(pos - first, tuple(dict.fromkeys(terms))) for pos, terms in sorted(by_place.items())]
    check_terms([t for s in slots for t in s.terms])
    return slots


def distinct_slots(slots: Sequence[Slot]) -> list[tuple[str, ...]]:
    """What a query asks for, each once: a word that is repeated counts as one."""
    return list(dict.fromkeys(s.terms for s in slots))


def all_terms(slots: Sequence[Slot]) -> list[str]:
    return list(dict.fromkeys(t for s in slots for t in s.terms))


def _moved(positions: Column, place: int) -> Column:
    return F.transform(positions, lambda x: x - F.lit(place))


def phrase_starts(positions: Sequence[Column], slots: Sequence[Slot], slop: int = 0) -> Column:
    """Places where the slots' words begin, from arrays of each slot's positions.

    Moved back by its slot's place, each word's position is a beginning. Without ``slop`` these must
    agree: the arrays are intersected. With it, a beginning counts if each slot has a position of its
    own at most ``slop`` after it, also moved back; beginnings are tried from the slot that has fewest.
    """
    moved = [_moved(p, s.place) for p, s in zip(positions, slots)]
    if slop == 0:
        out = moved[0]
        for other in moved[1:]:
            out = F.array_intersect(out, other)
        return F.array_distinct(out)
    fewest = F.array_min(F.array(*[F.struct(F.size(m).alias("size"), m.alias("moved")) for m in moved]))["moved"]
    every = F.array_distinct(F.flatten(F.array(*moved)))
    nearby = F.array_distinct(F.flatten(F.transform(fewest, lambda x: F.sequence(x - F.lit(slop), x))))
    groups: dict[tuple[str, ...], list[int]] = {}
    for i, s in enumerate(slots):
        groups.setdefault(s.terms, []).append(i)

    def fits(start: Column) -> Column:
        ok = F.lit(True)
        for members in groups.values():
            if len(members) == 1:
                ok = ok & F.exists(moved[members[0]], lambda x: x.between(start, start + slop))
                continue
            own = positions[members[0]]
            # Words that repeat take the earliest position that is left, in order of their places.
            last = F.aggregate(
                F.array(*[F.lit(slots[i].place) for i in members]),
                F.lit(-1),
                lambda taken, place: let(
                    F.array_min(F.filter(own, lambda x: (x > taken) & (x >= start + place))),
                    lambda x: F.when(x <= start + place + slop, x),
                ),
            )
            ok = ok & last.isNotNull()
        return ok

    return F.filter(F.array_intersect(every, nearby), fits)
