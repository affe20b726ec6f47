"""Expressions over a catalogue record's nested fields.

A field choice is written as in cataloguing practice: ``245abnps:130[a-z]`` means subfields a,
b, n, p, s of 245 and all lettered ones of 130. One letter gives a value per subfield; several
give one value per field, joined by spaces (so ``300aa`` joins repeated a's). A control field
may take a 0-based character range: ``008[35-37]``.

The functions give SQL expression text for ``F.expr``. One record needs several hundred nested
array functions; as text they reach the JVM in one call per column.
"""

from __future__ import annotations

import re
from typing import Mapping, NamedTuple, Sequence

LEADER = "000"
ALTERNATE_SCRIPT = "880"


class Choice(NamedTuple):
    tag: str
    codes: tuple[str, ...] = ()
    joined: bool = False
    span: tuple[int, int] | None = None


def _letters(text: str) -> tuple[str, ...]:
    """``a-gk-s`` and ``abc`` as single letters."""
    out: list[str] = []
    for first_letter, last in re.findall(r"(.)(?:-(.))?", text):
        out += [chr(c) for c in range(ord(first_letter), ord(last or first_letter) + 1)]
    return tuple(out)


def choices(spec: str) -> list[Choice]:
    out = []
    for part in spec.split(":"):
        tag, rest = part[:3], part[3:]
        bracket = re.fullmatch(r"([a-z]?)\[(.+)\]", rest)
        if bracket and re.fullmatch(r"\d+(-\d+)?", bracket[2]):
            start, _, end = bracket[2].partition("-")
            out.append(Choice(tag, tuple(bracket[1]), False, (int(start), int(end or start))))
        else:
            text = bracket[1] + bracket[2] if bracket else rest
            out.append(Choice(tag, tuple(dict.fromkeys(_letters(text))), len(text) > 1))
    return out


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dictionary(entries: Mapping[str, str], key: str) -> str:
    """Label of ``key`` in a fixed dictionary, NULL when absent; hits only search the map."""
    pairs = ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in entries.items())
    keys = ", ".join(quoted(k) for k in entries)
    return f"CASE WHEN {key} IN ({keys}) THEN try_element_at(map({pairs}), {key}) END"


def present(values_text: str) -> str:
    return f"filter({values_text}, v -> v IS NOT NULL AND v <> '')"


def _subfields(field: str, codes: Sequence[str]) -> str:
    listed = ", ".join(quoted(c) for c in codes)
    return f"transform(filter({field}.subfields, s -> s.code IN ({listed})), s -> s.value)"


def _concat(parts: Sequence[str]) -> str:
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0]


def with_tag(tag: str) -> str:
    return f"filter(fields, f -> f.tag = {quoted(tag)})"


def _linked_to(tag: str) -> str:
    """880 fields whose $6 points at ``tag``."""
    points = f"exists(f.subfields, s -> s.code = '6' AND startswith(s.value, {quoted(tag)}))"
    return f"filter(fields, f -> f.tag = {quoted(ALTERNATE_SCRIPT)} AND {points})"


def _values_of(fields: str, choice: Choice) -> str:
    """The chosen values of already selected fields, in record order."""
    if not choice.codes:
        text = f"transform({fields}, f -> f.data)"
    elif choice.joined:
        text = f"transform({fields}, f -> array_join({_subfields('f', choice.codes)}, ' '))"
    else:
        text = f"flatten(transform({fields}, f -> {_subfields('f', choice.codes)}))"
    if choice.span:
        start, end = choice.span
        text = f"transform({text}, v -> substring(v, {start + 1}, {end - start + 1}))"
    return present(text)


def values(spec: str) -> str:
    """All values of a choice as an array, in the order of the choice."""
    parts = []
    for choice in choices(spec):
        if choice.tag == LEADER:
            start, end = choice.span or (0, 23)
            parts.append(present(f"array(substring(leader, {start + 1}, {end - start + 1}))"))
        else:
            parts.append(_values_of(with_tag(choice.tag), choice))
    return _concat(parts)


def first(values_text: str) -> str:
    return f"try_element_at({values_text}, 1)"


def linked_values(spec: str) -> str:
    """Values from the alternate-script fields that are linked to the chosen tags."""
    return _concat([_values_of(_linked_to(choice.tag), choice) for choice in choices(spec)])


def combined_values(spec: str) -> str:
    """Plain and alternate-script values together, without repeats."""
    return f"array_distinct(concat({values(spec)}, {linked_values(spec)}))"


def strip_punctuation(value: str) -> str:
    """Drop closing separators such as `` /`` or `` :`` left by the cataloguing rules."""
    return f"regexp_replace({value}, '[ /:;,=]+$', '')"


def unpunctuated(spec: str) -> str:
    clean = f"transform({values(spec)}, v -> {strip_punctuation('v')})"
    return f"array_distinct({present(clean)})"


def all_text(low: int = 100, high: int = 900) -> str:
    """Every subfield of the data fields ``low <= tag < high``, joined."""
    chosen = f"filter(fields, f -> try_cast(f.tag AS int) BETWEEN {low} AND {high - 1})"
    words = f"flatten(transform({chosen}, f -> transform(f.subfields, s -> s.value)))"
    return f"array_join({present(words)}, ' ')"


def pattern_values(spec: str, pattern: str) -> str:
    """First group of ``pattern`` for each value; values that do not match are dropped."""
    return present(f"transform({values(spec)}, v -> regexp_extract(v, {quoted(pattern)}, 1))")


def sortable_title() -> str:
    """Title without its non-filing characters, lower-cased."""
    skip = "coalesce(try_cast(f.ind2 AS int), 0) + 1"
    titles = f"transform({with_tag('245')}, f -> substring(array_join({_subfields('f', 'a')}, ' '), {skip}))"
    return f"lower({strip_punctuation(first(titles))})"


def publication_year() -> str:
    """First four-digit year of 260c, else of the fixed-field date."""
    year = quoted(r"(\d{4})")
    candidates = [f"nullif(regexp_extract({first(values(spec))}, {year}, 1), '')" for spec in ("260c", "008[7-10]")]
    return f"coalesce({', '.join(candidates)})"


# ---- fixed values: words marking a link to supplementary material --------------------
SUPPLEMENTARY = "table of contents|abstract|description|sample text"


def link_urls(full_text: bool) -> str:
    """856 links to the work itself (``full_text``) or to material about it.

    Only web links (first indicator 4). Second indicator 2 is always about the work, 0 always
    the work; otherwise the link's notes ($3, $z) decide.
    """
    notes = f"lower(array_join({_subfields('f', '3z')}, ' '))"
    about = f"(f.ind2 = '2' OR (f.ind2 <> '0' AND {notes} RLIKE {quoted(SUPPLEMENTARY)}))"
    test = f"NOT {about}" if full_text else about
    links = f"filter(fields, f -> f.tag = '856' AND f.ind1 = '4' AND {test})"
    return present(f"flatten(transform({links}, f -> {_subfields('f', 'u')}))")


def _dewey_numbers() -> str:
    valid = quoted(r"^\d{3}($|[./ ])")
    return f"filter({values('082a')}, v -> v RLIKE {valid})"


def dewey_text() -> str:
    """Valid Dewey numbers with segmentation marks removed."""
    return f"array_distinct(transform({_dewey_numbers()}, v -> replace(replace(v, '/.', '.'), '/', ' ')))"


def dewey_classes() -> str:
    """Hundreds and tens classes of the valid Dewey numbers: ``332.09`` gives 300 and 330."""
    both = "array(concat(substring(v, 1, 1), '00'), concat(substring(v, 1, 2), '0'))"
    return f"array_distinct(flatten(transform({_dewey_numbers()}, v -> {both})))"
