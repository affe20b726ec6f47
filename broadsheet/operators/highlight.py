"""Highlighted snippets of a text for query terms."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, SparkSession, functions as F

from broadsheet.functions.shape import let
from broadsheet.functions.text import html_escape
from broadsheet.operators.analysis import PLAIN, Analyser
from broadsheet.operators.query_terms import all_terms, analysed

# ---- fixed values -------------------------------------------------------------------
PRE, POST = "<b>", "</b>"
SNIPPETS = 3
FRAGMENT_SIZE = 200
ALTERNATE_LENGTH = 750
JOINER = " ... "
REGEX_FRAGMENT = r"""[-\w ,/\n"']{20,200}"""
REGEX_SIZE = 70
REGEX_SLOP = 0.5
_CUT = "\ue002"  # stands where a text may be cut; taken out of the text itself
BOUNDARY_CHARS = ".,!? \t\n\r"
MAX_SCAN = 10
COLOURS = [
    "yellow", "lawgreen", "aquamarine", "magenta", "palegreen",
    "coral", "wheat", "khaki", "lime", "deepskyblue",
]

_PIECES = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def gap_fragments(text: Column, size: int = FRAGMENT_SIZE) -> Column:
    """The whole text cut at white space into pieces of at most ``size`` characters.

    A single run longer than ``size`` stays in one piece.
    """
    return F.regexp_extract_all(text, F.lit(rf"(?s)(.{{1,{size}}}(?:\s|\z)|\S+\s?)"), F.lit(1))


def regex_fragments(text: Column, pattern: str = REGEX_FRAGMENT, size: int = REGEX_SIZE, slop: float = REGEX_SLOP) -> Column:
    """The whole text in sentence-like pieces of about ``size`` characters.

    A text may be cut where a match of ``pattern`` ends. Of these places the one nearest to ``size`` is
    taken, if a piece is then within ``slop``, a share of ``size``; ties go to the shorter piece. Where there
    is none, the text is cut at the last white space within reach, or else at the limit, so that all
    text is in some piece.
    """
    least, most = int(size * (1 - slop)), int(size * (1 + slop))
    marked = F.regexp_replace(F.replace(text, F.lit(_CUT), F.lit(" ")), f"({pattern})", f"$1{_CUT}")
    # Between two places lies a stretch; those that are too long are cut at white space, or anywhere.
    room = rf"(?s)(.{{1,{most}}}\z|.{{0,{most - 1}}}\s|.{{1,{most}}})"
    stretches = F.flatten(F.transform(F.split(marked, _CUT, -1), lambda s: F.regexp_extract_all(s, F.lit(room), F.lit(1))))

    def step(state: Column, stretch: Column) -> Column:
        now = F.length(state["open"])
        longer = now + F.length(stretch)
        enough = (now >= least) & (F.abs(now - size) <= F.abs(longer - size))
        closes = (now > 0) & ((longer > most) | enough)
        return F.struct(
            F.when(closes, F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"]).alias("done"),
            F.when(closes, stretch).otherwise(F.concat(state["open"], stretch)).alias("open"),
        )

    begin = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    end = lambda s: F.when(F.length(s["open"]) > 0, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"])
    return F.aggregate(stretches, begin, step, end)


def boundary_fragments(text: Column, size: int = FRAGMENT_SIZE, max_scan: int = MAX_SCAN) -> Column:
    """Windows of ``size`` characters, each starting after a boundary character if one lies
    within ``max_scan`` characters before its start, and ending before one within as many
    characters after its end."""
    last_before = rf"(?s)^(?:.*[{BOUNDARY_CHARS}])?"
    first_after = rf"(?s)[{BOUNDARY_CHARS}].*$"
    has_boundary = f"[{BOUNDARY_CHARS}]"
    # Cut once, then look into the neighbouring windows: linear in the text's length.
    windows = F.regexp_extract_all(text, F.lit(rf"(?s)(.{{1,{size}}})"), F.lit(1))

    def widened(cut: Column) -> Column:
        def window(body: Column, i: Column) -> Column:
            before = F.coalesce(F.right(F.get(cut, i - 1), F.lit(max_scan)), F.lit(""))
            after = F.coalesce(F.left(F.get(cut, i + 1), F.lit(max_scan)), F.lit(""))
            lead = F.when(before.rlike(has_boundary), F.regexp_replace(before, last_before, "")).otherwise("")
            tail = F.when(after.rlike(has_boundary), F.regexp_replace(after, first_after, "")).otherwise("")
            return F.concat(lead, body, tail)

        return F.transform(cut, window)

    return let(windows, widened)


def _asked(terms: Sequence[str], analyser: Analyser) -> list[str]:
    """The terms that a piece may be, by the chain of the text."""
    return all_terms(analysed(SparkSession.active(), terms, analyser))


def _tags(terms: Sequence[str], pre: str, post: str, coloured: bool) -> Callable[[Column, Column], Column]:
    """How a matching piece is wrapped, by the term it matches."""

    def wrap(word: Column, shown: Column) -> Column:
        if not coloured:
            return F.concat(F.lit(pre), shown, F.lit(post))
        tag = F.lit(None).cast("string")
        for i, term in enumerate(terms):
            colour = COLOURS[i % len(COLOURS)]
            tag = F.when(word == term, f'<b style="background:{colour}">').otherwise(tag)
        return F.concat(tag, shown, F.lit("</b>"))

    return wrap


def mark(
    text: Column, terms: Sequence[str], pre: str = PRE, post: str = POST, coloured: bool = False, analyser: Analyser = PLAIN
) -> Column:
    """HTML-escaped text with each query term wrapped; ``coloured`` cycles ten tags by term.

    Query and pieces are analysed alike, so that a folded or stemmed term marks the word as it stands.
    """
    terms = _asked(terms, analyser)
    wrap = _tags(terms, pre, post, coloured)

    def show(piece: Column) -> Column:
        shown = html_escape(piece)
        if analyser == PLAIN:
            word = F.lower(piece)
            return F.when(word.isin(*terms), wrap(word, shown)).otherwise(shown)
        return let(
            F.get(F.filter(analyser.words(piece), lambda w: w.isin(*terms)), 0),
            lambda word: F.when(word.isNotNull(), wrap(word, shown)).otherwise(shown),
        )

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(1)), show), "")


def highlight(
    text: Column,
    terms: Sequence[str],
    snippets: int = SNIPPETS,
    fragments: Callable[[Column], Column] | None = gap_fragments,
    alternate: int = ALTERNATE_LENGTH,
    pre: str = PRE,
    post: str = POST,
    coloured: bool = False,
    joiner: str = JOINER,
    analyser: Analyser = PLAIN,
) -> Column:
    """The best fragments by number of matches, marked and joined.

    Equal fragments keep text order. With ``fragments`` None the text is one fragment, as for
    titles. A text without matches gives its first ``alternate`` characters, escaped.
    """
    asked = _asked(terms, analyser)
    pieces = F.array(text) if fragments is None else fragments(text)

    def scored(piece: Column, i: Column) -> Column:
        n = F.size(F.filter(analyser.words(piece), lambda t: t.isin(*asked)))
        return F.struct((-n).alias("rank"), i.alias("i"), piece.alias("piece"))

    matching = F.filter(F.transform(pieces, scored), lambda s: s["rank"] < 0)
    best = F.slice(F.array_sort(matching), 1, snippets)
    shown = F.transform(best, lambda s: mark(s["piece"], terms, pre, post, coloured, analyser))
    fallback = html_escape(F.substring(text, 1, alternate))
    return let(shown, lambda s: F.when(F.size(s) > 0, F.array_join(s, joiner)).otherwise(fallback))
