"""Text analysis: fold, lower, elide, split, stop words, synonyms, stem overrides.

The whole chain is one column expression over one row, so it adds no shuffle. Word lists are
constants of the plan; their membership tests compile to a hashed set.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.shape import let
from broadsheet.sources.lookup import MAX_INLINE_WORDS

TOKEN_BREAK = r"[^\p{L}\p{N}]+"

# ---- fixed values: accented letter to plain letter, one to one -----------------------
FOLD_FROM = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝŸàáâãäåçèéêëìíîïðñòóôõöøùúûüýÿ"
FOLD_TO = "AAAAAACEEEEIIIIDNOOOOOOUUUUYYaaaaaaceeeeiiiidnoooooouuuuyy"
# ---- fixed values: letters that become several --------------------------------------
FOLD_MANY = {
    "Æ": "AE",
    "Ĳ": "IJ",
    "Œ": "OE",
    "Þ": "TH",
    "æ": "ae",
    "ĳ": "ij",
    "œ": "oe",
    "ß": "ss",
    "þ": "th",
    "ﬀ": "ff",
    "ﬁ": "fi",
    "ﬂ": "fl",
    "ﬃ": "ffi",
    "ﬄ": "ffl",
    "ﬅ": "ft",
    "ﬆ": "st",
}
# ---- fixed values: elided articles and pronouns, by language ------------------------
CONTRACTIONS = {
    "ca": ["d", "l", "m", "n", "s", "t"],
    "fr": ["l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu"],
    "ga": ["d", "m", "b"],
    "it": [
        "c", "l", "all", "dall", "dell", "nell", "sull", "coll", "pell", "gl", "agl",
        "dagl", "degl", "negl", "sugl", "un", "m", "t", "s", "v", "d",
    ],
}
# ---- fixed values: Irish prefixes written with a hyphen -----------------------------
HYPHEN_PREFIXES = ["h", "n", "t"]
# ---- fixed values: English stop words -----------------------------------------------
STOPWORDS_EN = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
    "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
    "these", "they", "this", "to", "was", "will", "with",
]
# ---- fixed values: synonym rules; "replace" rewrites, "expand" yields all of a set ---
SYNONYM_REPLACE = {
    "pixima": ["pixma"],
}
SYNONYM_EXPAND = [
    ["gb", "gib", "gigabyte", "gigabytes"],
    ["mb", "mib", "megabyte", "megabytes"],
    ["television", "televisions", "tv", "tvs"],
]
# ---- fixed values: Dutch stem overrides ---------------------------------------------
STEMS_NL = {"fiets": "fiets", "bromfiets": "bromfiets", "ei": "eier", "kind": "kinder"}
# ---- fixed values: words that are never stemmed -------------------------------------
PROTECTED_WORDS = ["dontstems", "zwhacky"]


def fold_chars(text: Column) -> Column:
    """Accented letters and ligatures to plain letters."""
    text = F.translate(text, FOLD_FROM, FOLD_TO)
    for char, plain in FOLD_MANY.items():
        text = F.replace(text, F.lit(char), F.lit(plain))
    return text


def tokenize(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


def strip_elision(text: Column, lang: str) -> Column:
    """Drop a leading elided word (``l'``, ``d'``, …). Works on text, before splitting."""
    words = "|".join(CONTRACTIONS[lang])
    return F.regexp_replace(text, rf"(?i)(^|[^\p{{L}}\p{{N}}])(?:{words})['’]", "$1")


def strip_hyphen_prefix(text: Column) -> Column:
    """Drop Irish ``h-``, ``n-`` and ``t-`` before a word."""
    words = "|".join(HYPHEN_PREFIXES)
    return F.regexp_replace(text, rf"(?i)(^|[^\p{{L}}\p{{N}}])(?:{words})-", "$1")


def remove_stopwords(tokens: Column, words: Sequence[str]) -> Column:
    if not words:
        return tokens
    if len(words) > MAX_INLINE_WORDS:
        raise ValueError("word list too long for a constant; use remove_stopwords_join")
    return F.filter(tokens, lambda t: ~t.isin(*words))


def remove_stopwords_join(tokens: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Exploded tokens (with columns lang, term) minus a stop-word table (lang, word)."""
    listed = stopwords.select("lang", F.col("word").alias("term"))
    return tokens.join(listed, ["lang", "term"], "left_anti")


def synonym_table(
    replace: Mapping[str, Sequence[str]] = SYNONYM_REPLACE, expand: Sequence[Sequence[str]] = SYNONYM_EXPAND
) -> dict[str, list[str]]:
    """Both rule kinds as token → all its replacements."""
    table = {k: list(v) for k, v in replace.items()}
    for group in expand:
        table.update({word: list(group) for word in group})
    return table


def expand_synonyms(token: Column, table: Mapping[str, Sequence[str]]) -> Column:
    """Replacements of one token as an array; a token without a rule stays as it is."""
    if not table:
        return F.array(token)
    pairs = [c for k, v in table.items() for c in (F.lit(k), F.array(*[F.lit(x) for x in v]))]
    return F.when(token.isin(*table), F.try_element_at(F.create_map(*pairs), token)).otherwise(F.array(token))


def stem_override(token: Column, stems: Mapping[str, str], protected: Sequence[str] = ()) -> Column:
    """Dictionary stem of a token; protected words keep their form."""
    if not stems:
        return token
    pairs = [F.lit(x) for kv in stems.items() for x in kv]
    rewritable = token.isin(*stems)
    if protected:
        rewritable = rewritable & ~token.isin(*protected)
    return F.when(rewritable, F.try_element_at(F.create_map(*pairs), token)).otherwise(token)


@dataclass(frozen=True)
class Analyser:
    """One configured chain. ``terms`` keeps each token's original position."""

    fold: bool = False
    elision: str | None = None
    hyphen_prefix: bool = False
    stopwords: Sequence[str] = ()
    synonyms: Mapping[str, Sequence[str]] = field(default_factory=dict)
    stems: Mapping[str, str] = field(default_factory=dict)
    protected: Sequence[str] = ()

    def tokens(self, text: Column) -> Column:
        """Array of tokens before stop words are removed."""
        if self.fold:
            text = fold_chars(text)
        if self.elision:
            text = strip_elision(text, self.elision)
        if self.hyphen_prefix:
            text = strip_hyphen_prefix(text)
        return tokenize(text)

    def terms(self, text: Column) -> Column:
        """Array of (pos, term): stop words leave gaps, synonyms share a position."""
        placed = F.transform(self.tokens(text), lambda t, i: F.struct((i + 1).alias("pos"), t.alias("term")))
        if self.stopwords:
            placed = F.filter(placed, lambda p: ~p["term"].isin(*self.stopwords))
        if self.synonyms:
            placed = F.flatten(
                F.transform(
                    placed,
                    lambda p: F.transform(
                        expand_synonyms(p["term"], self.synonyms),
                        lambda s: F.struct(p["pos"].alias("pos"), s.alias("term")),
                    ),
                )
            )
        if self.stems:
            placed = F.transform(
                placed,
                lambda p: F.struct(
                    p["pos"].alias("pos"), stem_override(p["term"], self.stems, self.protected).alias("term")
                ),
            )
        return placed

    def words(self, text: Column) -> Column:
        """Array of terms without positions."""
        if not (self.stopwords or self.synonyms or self.stems):
            return self.tokens(text)
        return F.transform(self.terms(text), lambda p: p["term"])


PLAIN = Analyser()


def detect_language(
    df: DataFrame, text: str, stopwords: Mapping[str, Sequence[str]], fallback: str = "en"
) -> DataFrame:
    """Add ``language``: the one whose stop words occur most; ties go to the lower code.

    Counting happens inside each row against hashed sets, so no tokens are shuffled.
    """
    langs = sorted(stopwords)
    if sum(len(stopwords[lang]) for lang in langs) > MAX_INLINE_WORDS:
        raise ValueError("stop-word lists too long for constants")
    counted = df.withColumn("_tokens", tokenize(F.col(text)))

    def rank_of(lang: str) -> Column:
        found = F.size(F.filter("_tokens", lambda t: t.isin(*stopwords[lang])))
        return F.struct((-found).alias("rank"), F.lit(lang).alias("lang"))

    hits = [rank_of(lang) for lang in langs]
    best = F.array_min(F.array(*hits))
    counted = counted.withColumn("_best", best)
    found = F.when(F.col("_best.rank") < 0, F.col("_best.lang"))
    return counted.withColumn("language", F.coalesce(found, F.lit(fallback))).drop("_tokens", "_best")


def exploded_terms(
    df: DataFrame, key: str, fields: Sequence[str], analyser: Analyser = PLAIN, lengths: bool = False
) -> DataFrame:
    """(key, field, pos, term): one row per analysed token of each field.

    ``lengths`` adds ``dl``, the field's number of tokens, to each of its rows.
    """

    def placed(f: str) -> Column:
        found = F.coalesce(analyser.terms(F.col(f)), F.array().cast("array<struct<pos:int,term:string>>"))

        def rows(tokens: Column) -> Column:
            length = [F.size(tokens).alias("dl")] if lengths else []
            return F.transform(
                tokens,
                lambda p: F.struct(F.lit(f).alias("field"), p["pos"].alias("pos"), p["term"].alias("term"), *length),
            )

        return let(found, rows)

    return df.select(F.col(key), F.inline(F.concat(*[placed(f) for f in fields])))


def exploded_vocabulary(df: DataFrame, fields: Sequence[str], analyser: Analyser = PLAIN) -> DataFrame:
    """(field, term): each row's distinct terms, so that counting rows counts documents."""

    def distinct(f: str) -> Column:
        found = F.coalesce(F.array_distinct(analyser.words(F.col(f))), F.array().cast("array<string>"))
        return F.transform(found, lambda t: F.struct(F.lit(f).alias("field"), t.alias("term")))

    return df.select(F.inline(F.concat(*[distinct(f) for f in fields])))


def term_runs(tokens: Column) -> Column:
    """(term, tf, positions) of each distinct term of an array of (pos, term), in order of terms.

    The tokens are sorted and equal neighbours folded, all within the row.
    """

    def fold(s: Column) -> Column:
        new = F.when(
            F.size(s) > 0,
            F.filter(
                F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["term"] != F.get(s, i - 1)["term"])
            ),
        ).otherwise(F.array().cast("array<int>"))

        def runs(starts: Column) -> Column:
            def one(start: Column, k: Column) -> Column:
                count = F.coalesce(F.get(starts, k + 1), F.size(s)) - start
                return F.struct(
                    F.get(s, start)["term"].alias("term"),
                    count.cast("bigint").alias("tf"),
                    F.transform(F.slice(s, start + 1, count), lambda x: x["pos"]).alias("positions"),
                )

            return F.transform(starts, one)

        return let(new, runs)

    return let(F.array_sort(F.transform(tokens, lambda t: F.struct(t["term"].alias("term"), t["pos"].alias("pos")))), fold)


def postings(
    df: DataFrame, key: str, fields: Sequence[str], analyser: Analyser = PLAIN, lengths: bool = False, only: Sequence[str] | None = None
) -> DataFrame:
    """Inverted index rows (term, field, key, tf, positions), with ``dl`` if ``lengths``.

    A document's tokens lie in one row, so its postings are made there, without a shuffle.
    ``only``: the terms whose postings are wanted; others are left out before tokens are sorted.
    """

    def placed(f: str) -> Column:
        found = F.coalesce(analyser.terms(F.col(f)), F.array().cast("array<struct<pos:int,term:string>>"))

        def rows(tokens: Column) -> Column:
            length = [F.size(tokens).alias("dl")] if lengths else []
            return F.transform(
                term_runs(tokens if only is None else F.filter(tokens, lambda p: p["term"].isin(*only))),
                lambda r: F.struct(
                    F.lit(f).alias("field"), r["term"].alias("term"), *length, r["tf"].alias("tf"), r["positions"].alias("positions")
                ),
            )

        return let(found, rows)

    return df.select(F.col(key), F.inline(F.concat(*[placed(f) for f in fields])))


def field_lengths(df: DataFrame, key: str, fields: Sequence[str], analyser: Analyser = PLAIN) -> DataFrame:
    """(key, field, dl): analysed length of each field that is present."""
    items = [
        F.struct(F.lit(f).alias("field"), F.size(analyser.words(F.col(f))).alias("dl"), F.col(f).isNotNull().alias("present"))
        for f in fields
    ]
    rows = df.select(F.col(key), F.inline(F.array(*items)))
    return rows.where("present").select(key, "field", "dl")
