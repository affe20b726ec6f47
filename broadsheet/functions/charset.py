"""The escape-coded character set of older catalogue records, decoded to composed Unicode.

Its bytes come as a string of as many characters below 256 (Latin-1). Below 0x80 stands the working
set, ASCII unless an escape sequence has chosen subscripts, superscripts or the three Greek symbols;
above stands the extended Latin set, whose combining marks come before their letter. Decoding folds
over the characters with the working set and the marks that wait as its state; marks move behind their
letter in canonical order and are composed with it. Other sets, and bytes without a meaning, can't be mapped.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import Mapping

from pyspark.sql import Column, functions as F

from broadsheet.functions.shape import let

ESCAPE = "\x1b"

# ---- fixed values: letters and signs of the extended Latin set, by byte -----------------
LETTERS = {
    0xA1: "Ł", 0xA2: "Ø", 0xA3: "Đ", 0xA4: "Þ", 0xA5: "Æ", 0xA6: "Œ", 0xA7: "ʹ", 0xA8: "·", 0xA9: "♭", 0xAA: "®", 0xAB: "±",
    0xAC: "Ơ", 0xAD: "Ư", 0xAE: "ʼ", 0xB0: "ʻ", 0xB1: "ł", 0xB2: "ø", 0xB3: "đ", 0xB4: "þ", 0xB5: "æ", 0xB6: "œ", 0xB7: "ʺ",
    0xB8: "ı", 0xB9: "£", 0xBA: "ð", 0xBC: "ơ", 0xBD: "ư", 0xC0: "°", 0xC1: "ℓ", 0xC2: "℗", 0xC3: "©", 0xC4: "♯", 0xC5: "¿",
    0xC6: "¡", 0xC7: "ß", 0xC8: "€",
}
# ---- fixed values: combining marks of the extended Latin set, by byte -------------------
MARKS = {
    0xE0: 0x0309, 0xE1: 0x0300, 0xE2: 0x0301, 0xE3: 0x0302, 0xE4: 0x0303, 0xE5: 0x0304, 0xE6: 0x0306, 0xE7: 0x0307, 0xE8: 0x0308,
    0xE9: 0x030C, 0xEA: 0x030A, 0xEB: 0xFE20, 0xEC: 0xFE21, 0xED: 0x0315, 0xEE: 0x030B, 0xEF: 0x0310, 0xF0: 0x0327, 0xF1: 0x0328,
    0xF2: 0x0323, 0xF3: 0x0324, 0xF4: 0x0325, 0xF5: 0x0333, 0xF6: 0x0332, 0xF7: 0x0326, 0xF8: 0x031C, 0xF9: 0x032E, 0xFA: 0xFE22,
    0xFB: 0xFE23, 0xFE: 0x0313,
}
# ---- fixed values: control codes, and working sets that an escape sequence chooses ------
CONTROLS = {0x88: "\x98", 0x89: "\x9c", 0x8D: "‍", 0x8E: "‌"}
SETS = {
    "b": dict(zip("()+-0123456789", "₍₎₊₋₀₁₂₃₄₅₆₇₈₉")),
    "p": dict(zip("()+-0123456789", "⁽⁾⁺⁻⁰¹²³⁴⁵⁶⁷⁸⁹")),
    "g": dict(zip("abc", "αβγ")),
}
PLAIN, EXTENDED = "B", "E"


@lru_cache(maxsize=1)
def compositions() -> dict[str, str]:
    """Letter and mark to the composed letter, by Unicode's own rule, for letters with up to two marks."""
    marks = [chr(m) for m in MARKS.values()]
    letters = [c for c in map(chr, range(0x41, 0x7B)) if c.isalpha()] + [c for c in LETTERS.values() if c.isalpha()]
    out: dict[str, str] = {}
    for _ in range(2):
        found = {c + m: unicodedata.normalize("NFC", c + m) for c in letters for m in marks}
        found = {k: v for k, v in found.items() if len(v) == 1}
        out.update(found)
        letters = list(found.values())
    return out


def _map(table: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def _of_bytes(table: Mapping[int, str]) -> dict[str, str]:
    return {chr(k): v for k, v in table.items()}


def _with_marks(letter: Column, marks: Column) -> Column:
    """A letter and its marks, in canonical order, composed as far as there are composed letters."""
    state = F.struct(letter.alias("letter"), F.lit("").alias("rest"), F.lit(0).alias("last"))

    def step(s: Column, m: Column) -> Column:
        # A mark is kept from its letter by one of its own class that stands between.
        composed = F.when((s["rest"] == "") | (s["last"] < m["order"]), F.try_element_at(_map(compositions()), F.concat(s["letter"], m["mark"])))
        return let(
            composed,
            lambda c: F.when(c.isNotNull(), F.struct(c.alias("letter"), s["rest"].alias("rest"), s["last"].alias("last"))).otherwise(
                F.struct(s["letter"].alias("letter"), F.concat(s["rest"], m["mark"]).alias("rest"), m["order"].alias("last"))
            ),
        )

    return F.aggregate(F.array_sort(marks), state, step, lambda s: F.concat(s["letter"], s["rest"]))


def decode_escaped(text: Column) -> Column:
    """(text, mapped): the decoded text, and whether all of it could be mapped."""
    marks_kind = "array<struct<order:int,place:int,mark:string>>"
    orders = _map({chr(b): f"{unicodedata.combining(chr(m)):03d}{chr(m)}" for b, m in MARKS.items()})
    none = F.array().cast(marks_kind)
    start = F.struct(F.lit(PLAIN).alias("set"), none.alias("marks"), F.lit("").alias("text"), F.lit(True).alias("mapped"))

    def state(set_: Column, marks: Column, out: Column, mapped: Column) -> Column:
        return F.struct(set_.alias("set"), marks.alias("marks"), out.alias("text"), mapped.alias("mapped"))

    def step(s: Column, c: Column) -> Column:
        code = F.ascii(c)
        chosen = F.regexp_replace(c, r"^\x1b[(,)\-]?!?", "")
        right = F.regexp_like(c, F.lit(r"^\x1b[)\-]"))
        escaped = F.when(right, state(s["set"], s["marks"], s["text"], s["mapped"] & (chosen == EXTENDED))).otherwise(
            state(
                F.when(chosen == "s", F.lit(PLAIN)).otherwise(chosen), s["marks"], s["text"],
                s["mapped"] & chosen.isin(PLAIN, "s", *SETS),
            )
        )
        low = F.when((s["set"] == PLAIN) | (code <= 0x20), c)
        for name, table in SETS.items():
            low = F.when((s["set"] == name) & (code > 0x20), F.try_element_at(_map(table), c)).otherwise(low)
        high = F.try_element_at(_map({**_of_bytes(LETTERS), **_of_bytes(CONTROLS)}), c)
        letter = F.when(code < 0x80, low).otherwise(high)
        waiting = F.try_element_at(orders, c)
        mark = F.struct(F.substring(waiting, 1, 3).cast("int").alias("order"), F.size(s["marks"]).alias("place"), F.substring(waiting, 4, 1).alias("mark"))
        plain = let(
            letter,
            lambda x: state(
                s["set"], none,
                F.concat(s["text"], F.when(F.size(s["marks"]) > 0, _with_marks(F.coalesce(x, F.lit("")), s["marks"])).otherwise(F.coalesce(x, F.lit("")))),
                s["mapped"] & x.isNotNull(),
            ),
        )
        return (
            F.when(c.startswith(ESCAPE), escaped)
            .when(waiting.isNotNull(), state(s["set"], F.concat(s["marks"], F.array(mark)), s["text"], s["mapped"]))
            .otherwise(plain)
        )

    pieces = F.regexp_extract_all(text, F.lit(r"(?s)(\x1b[gbps]|\x1b[(,)\-]!?.|\x1b\$?.?|.)"), F.lit(1))
    folded = F.aggregate(
        pieces, start, step, lambda s: F.struct(s["text"].alias("text"), (s["mapped"] & (F.size(s["marks"]) == 0)).alias("mapped"))
    )
    simple = F.regexp_like(text, F.lit(r"\A[\x00-\x1a\x1c-\x7f]*\z"))
    return F.when(simple, F.struct(text.alias("text"), F.lit(True).alias("mapped"))).when(text.isNotNull(), folded)
