"""Benchmark decontamination over a positional inverted index, with built-in functions only.

The index holds, for each word that occurs in the benchmark, its places in the training
documents: (term, document, position), written as a table. Words that no item has can't be part
of a match, so they aren't stored. Counts of the postings tell how rare a term is.

A window is ``WINDOW`` consecutive words of an item, or all words of a shorter one. It is looked
up from its rarest terms on: each posting of the rarest one, moved back by the term's offset,
is a place where the item may begin; the list of the next rarest term, moved likewise, is
intersected with it. Windows of an item with the same rarest terms share one lookup. From there

* phrases: beginnings that agree exactly are held against the lists of all words of their
  windows; stretches of at least a window that match word by word are matches;
* proximity: beginnings that agree within ``SLOP`` positions are held against the list of the third
  rarest term in the same way.

A hot term is looked up only from windows that have none rarer. All joins after the first are on
(term, document, position), so neither a long document, a common passage nor a hot item gathers
in one task; what a document is told of is counted before it is gathered.

Cases: a null text has no words; documents without words have none hit; equal texts of an item are
looked up once, under all their ids; items without an id or without words take no part; rows that
repeat an id and a text are told alike, rows that share only an id or only a text are apart; a
null document id stays null; an empty benchmark hits nothing; no documents give no rows; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.llm.work import stored

WINDOW, SLOP = 10, 2
STRETCH = 64  # words of a document whose postings are looked up together
MOST_SENT = 500_000  # documents with candidates that are sent to all tasks, some tens of bytes each
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COUNT = ""  # no word: its posting is the number of a document's words
PLACE = ["doc", "twin"]  # a document: its id and a hash of its text


def words(text: Column) -> Column:
    """Words of a text in lower case (A-Z); an empty array for a null."""
    parts = F.filter(F.split(F.translate(text, UPPER, LOWER), GAPS, -1), lambda w: w != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


@dataclass
class Index:
    """``items``: (item, ids, n); ``tokens``: (item, offset, term); ``postings``: (doc, known, twin, term, position)."""

    items: DataFrame
    tokens: DataFrame
    postings: DataFrame
    count_term: int


def build_index(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> Index:
    """The postings in ``docs`` of all words of ``items``, written to the shared folder."""
    named = lambda c: F.col(f"`{c}`")
    own = (
        items.where(named(item_id).isNotNull())
        .select(named(item_id).cast("string").alias("id"), words(named(text)).alias("words"))
        .where(F.size("words") > 0)
        .groupBy("words")
        .agg(F.collect_set("id").alias("ids"))
    )
    own = stored(own.select(F.monotonically_increasing_id().alias("item"), "ids", "words"), "items")
    spelled = own.select("item", F.posexplode("words").alias("offset", "word"))
    terms = spelled.select("word").union(docs.sparkSession.range(1).select(F.lit(COUNT).alias("word"))).distinct()
    terms = stored(terms.select("word", F.monotonically_increasing_id().alias("term")), "terms")
    tokens = stored(spelled.join(terms, "word").select("item", "offset", "term"), "item-tokens")
    places = docs.select(
        F.coalesce(named(doc_id).cast("long"), F.lit(0)).alias("doc"),
        named(doc_id).isNotNull().alias("known"),
        F.xxhash64(named(text)).alias("twin"),
        F.posexplode(F.concat(words(named(text)), F.array(F.lit(COUNT)))).alias("position", "word"),
    )
    postings = stored(places.join(terms, "word").select("doc", "known", "twin", "term", "position"), "postings")
    count_term = terms.where(F.col("word") == COUNT).first()["term"]
    return Index(own.select("item", "ids", F.size("words").alias("n")), tokens, postings, count_term)


def _lookups(index: Index, window: int) -> DataFrame:
    """(item, offset_1, term_1, ..., term_3, first, last): the rarest terms of windows, and the offsets these cover.

    Windows with the same rarest terms follow one another; those with a word that no document has
    can't occur.
    """
    counts = index.postings.where(F.col("term") != index.count_term).groupBy("term").agg(F.count("*").alias("count"))
    told = index.tokens.join(counts, "term", "left").join(index.items.select("item", "n"), "item")
    length = F.least(F.col("n"), F.lit(window))
    frame = Window.partitionBy("item").orderBy("offset").rowsBetween(0, window - 1)
    rare = told.withColumns(
        {
            "rare": F.array_sort(F.collect_list(F.when(F.col("count").isNotNull(), F.struct("count", "offset", "term"))).over(frame)),
            "length": length,
        }
    ).where((F.col("offset") <= F.col("n") - F.col("length")) & (F.size("rare") == F.col("length")))
    nth = lambda i, what: F.get("rare", F.least(F.lit(i), F.size("rare") - 1))[what]
    keys = {f"{what}_{i + 1}": nth(i, what) for i in range(3) for what in ("offset", "term")}
    return (
        rare.select("item", "offset", "length", *[c.alias(k) for k, c in keys.items()])
        .groupBy("item", *keys)
        .agg(F.min("offset").alias("first"), (F.max("offset") + F.max("length") - 1).alias("last"))
    )


def _of_terms(postings: DataFrame, lists: DataFrame, number: int) -> DataFrame:
    """Postings of the ``number``-th rarest terms. These are written first, so that their size is known."""
    wanted = lists.select(F.col(f"term_{number}").alias("term")).distinct()
    return postings.join(stored(wanted, "wanted-terms"), "term", "left_semi")


def _met(lists: DataFrame, postings: DataFrame, number: int, slop: int, lookups: DataFrame | None = None) -> DataFrame:
    """``lists`` where the document has the ``number``-th rarest term within ``slop`` of its place; ``apart``: how far at least.

    ``lookups``: a written table with all terms of ``lists``, if that isn't one.
    """
    own = _of_terms(postings, lists if lookups is None else lookups, number).select(
        *[F.col(c).alias(f"__{c}") for c in PLACE], F.col("term").alias("__term"), F.col("position").alias("__position"),
        F.floor(F.col("position") / (slop + 1)).alias("__bucket"),
    )
    due = F.col("start") + F.col(f"offset_{number}")
    spread = lists.withColumn(
        "bucket", F.explode(F.sequence(F.floor((due - slop) / (slop + 1)), F.floor((due + slop) / (slop + 1))))
    )
    same = (F.col(f"term_{number}") == F.col("__term")) & (F.col("bucket") == F.col("__bucket"))
    for c in PLACE:
        same &= F.col(c) == F.col(f"__{c}")
    off = F.abs(F.col("__position") - due)
    joined = spread.join(own, same & (off <= slop)).withColumn("off", off)
    return joined.groupBy(*lists.columns).agg(F.min("off").alias(f"apart_{number}"))


def candidates(index: Index, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Places where an item may begin: lists of the two rarest terms of its windows, intersected."""
    lookups = stored(_lookups(index, window), "lookups")
    first = _of_terms(index.postings, lookups, 1).join(lookups, F.col("term") == F.col("term_1")).select(
        *PLACE, (F.col("position") - F.col("offset_1")).alias("start"),
        "item", "offset_2", "term_2", "offset_3", "term_3", "first", "last",
    )
    return stored(_met(first, index.postings, 2, slop, lookups), "candidates")


def nearby_postings(index: Index, found: DataFrame, slop: int = SLOP) -> DataFrame:
    """The postings around candidates, written: of documents that have any, in the stretches that these cover.

    The documents are sent to all tasks if they are at most ``MOST_SENT``, which is counted; beyond that they
    are joined like any other table.
    """
    stretch = lambda position: F.floor(position / STRETCH)
    low, high = F.col("start") + F.col("first") - slop, F.col("start") + F.col("last") + slop
    listed = found.select(*PLACE, F.explode(F.sequence(stretch(low), stretch(high))).alias("stretch")).distinct()
    places = stored(listed.groupBy(*PLACE).agg(F.collect_list("stretch").alias("stretches")), "candidate-places")
    sent = F.broadcast(places) if places.count() <= MOST_SENT else places
    inside = index.postings.join(sent, PLACE).where(F.array_contains("stretches", stretch(F.col("position"))))
    return stored(inside.select(*PLACE, "term", "position").distinct(), "nearby-postings")


def phrase_matches(index: Index, found: DataFrame, window: int = WINDOW, inside: DataFrame | None = None) -> DataFrame:
    """(doc, twin, item, start, first, last): stretches of an item's offsets that occur word by word.

    ``found``: of ``candidates``; ``inside``: of ``nearby_postings``. The item's word at an offset is the
    document's at ``start`` + offset.
    """
    inside = nearby_postings(index, found) if inside is None else inside
    due = (
        found.where("apart_2 = 0")
        .select(*PLACE, "item", "start", F.explode(F.sequence("first", "last")).alias("offset"))
        .distinct()
        .join(index.tokens, ["item", "offset"])
        .withColumn("position", F.col("start") + F.col("offset"))
    )
    hit = due.join(inside, [*PLACE, "term", "position"], "left_semi")
    alignment = [*PLACE, "item", "start"]
    run = F.col("offset") - F.row_number().over(Window.partitionBy(*alignment).orderBy("offset"))
    runs = hit.withColumn("run", run).groupBy(*alignment, "run").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    return (
        runs.join(index.items.select("item", "n"), "item")
        .where(F.col("last") - F.col("first") + 1 >= F.least(F.col("n"), F.lit(window)))
        .select(*alignment, "first", "last")
    )


def proximity_matches(index: Index, found: DataFrame, slop: int = SLOP, inside: DataFrame | None = None) -> DataFrame:
    """(doc, twin, item, start, apart): windows whose three rarest terms stand within ``slop`` of their places.

    Places are counted from the rarest term's; ``apart``: the largest distance from one.
    """
    inside = nearby_postings(index, found, slop) if inside is None else inside
    third = _met(found.where(F.col("apart_2") <= slop), inside, 3, slop)
    return third.groupBy(*PLACE, "item", "start").agg(F.min(F.greatest("apart_2", "apart_3")).alias("apart"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = SLOP,
                  doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items, near_items) of each document.

    ``items``: ids, as sorted strings, of the items with windows that occur; ``n_hit``: words inside
    such windows; ``near_items``: ids of those with a window nearby.
    """
    index = build_index(docs, items, doc_id, item_id, text)
    found = candidates(index, window, slop)
    inside = nearby_postings(index, found, slop)
    phrases = stored(phrase_matches(index, found, window, inside), "phrases")
    hits = (
        phrases.select(*PLACE, F.explode(F.sequence(F.col("start") + F.col("first"), F.col("start") + F.col("last"))).alias("position"))
        .distinct()
        .groupBy(*PLACE)
        .agg(F.count("*").alias("n_hit"))
    )

    def ids(matches: DataFrame, name: str) -> DataFrame:
        told = matches.select(*PLACE, "item").distinct().join(index.items, "item")
        return told.select(*PLACE, F.explode("ids").alias("id")).groupBy(*PLACE).agg(F.array_sort(F.collect_set("id")).alias(name))

    none = F.array().cast("array<string>")
    counted = index.postings.where(F.col("term") == index.count_term)
    return (
        counted.join(hits, PLACE, "left")
        .join(ids(phrases, "items"), PLACE, "left")
        .join(ids(proximity_matches(index, found, slop, inside), "near_items"), PLACE, "left")
        .select(
            F.when(F.col("known"), F.col("doc")).alias("doc_id"),
            F.col("position").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near_items", none).alias("near_items"),
        )
    )
