"""Substring deduplication by relative Lempel-Ziv parsing against all earlier documents.

The reference of a document is every document with a smaller id. Each document is cut into
*blocks* at content-defined places: a block is a maximal run of windows of ``window`` words
that share their least anchor hash (an anchor is a run of ``anchor`` words). The same window
has the same anchor wherever it stands, so whatever repeats meets under its anchor.

* Parsing: a block whose whole word sequence begins earlier in the reference is a phrase, found
  by its hash in the index of all blocks; neighbouring phrases grow into one factor.
* Factor boundaries: where a block differs from other blocks of its anchor, a factor may begin
  or end inside it. Only there, and only for the first document with such a block, the single
  windows are looked up in the same manner.

A factor covers at least ``window`` words by construction, and all words of factors are removed.
Windows are judged on the input, so removal in one document never shields another.

Hot blocks, anchors and windows are aggregated to a smallest id before any shuffle, and joined
back with joins that can be split. Hashes: a block is known by 128 bits (anchor and content), a
window by 128 bits (anchor and words).

Cases: null or empty texts have no words; texts under ``window`` words keep all; a null id is
neither smaller nor larger than another, so such a document keeps all words and is nobody's
reference; rows that repeat an id with the same text get the same result, and rows that share
an id count as one document but are judged by their own texts; other columns are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.arrow_text import Powers, Words, gathered, mixed, range_hashes, slices
from broadsheet.llm.work import stored

WINDOW = 50
ANCHOR = 8

_SHINGLE = Powers(0xE7037ED1A0B428DB)
_BLOCK = Powers(0x8EBC6AF09C88C6E3)


def _rolled(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` consecutive values."""
    index = np.arange(max(0, len(values) - length + 1))
    return range_hashes(values, index, index + length, _SHINGLE)


def _sliding_min(values: np.ndarray, length: int) -> np.ndarray:
    """The least of each ``length`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= length:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = length - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _word_values(words: Words) -> np.ndarray:
    return words.hashes()


def _windows(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes; the places where a window begins; the anchor of each such window."""
    values = _word_values(words)
    if len(values) < window:
        return values, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _sliding_min(_rolled(values, anchor), window - anchor + 1)
    last = np.repeat(words.first[1:], words.counts())
    place = np.flatnonzero(np.arange(len(values)) + window <= last)
    return values, place, least[place]


def blocks(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """All blocks of all documents: (doc_id, row, anchor, content, start, windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                values, place, least = _windows(words, window, anchor)
                if not len(place):
                    continue
                new = np.ones(len(place), bool)
                new[1:] = (place[1:] != place[:-1] + 1) | (least[1:] != least[:-1])
                at = np.flatnonzero(new)
                count = np.diff(np.append(at, len(place)))
                begin = place[at]
                content = range_hashes(values, begin, begin + count + window - 1, _BLOCK)
                doc = np.searchsorted(words.first, begin, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(doc)),
                        part.column("row").take(pa.array(doc)),
                        pa.array(least[at].view(np.int64)),
                        pa.array(content.view(np.int64)),
                        pa.array((begin - words.first[doc]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    ["doc_id", "row", "anchor", "content", "start", "windows"],
                )

    return docs.mapInArrow(run, "doc_id long, row long, anchor long, content long, start int, windows int")


def _window_keys(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """The windows of the blocks listed with each document: (doc_id, row, anchor, words, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                values, place, least = _windows(words, window, anchor)
                lists = part.column("parts")
                sizes = np.array(lists.value_lengths(), np.int64)
                flat = lists.flatten()
                owner = np.repeat(np.arange(part.num_rows), sizes)
                begin = flat.field("start").to_numpy() + words.first[owner]
                count = flat.field("windows").to_numpy().astype(np.int64)
                start = gathered(np.arange(len(values)), begin, count)
                doc = np.repeat(owner, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(doc)),
                        part.column("row").take(pa.array(doc)),
                        pa.array(least[np.searchsorted(place, start)].view(np.int64)),
                        pa.array(mixed(range_hashes(values, start, start + window, _BLOCK)).view(np.int64)),
                        pa.array((start - words.first[doc]).astype(np.int32)),
                    ],
                    ["doc_id", "row", "anchor", "words", "start"],
                )

    return docs.mapInArrow(run, "doc_id long, row long, anchor long, words long, start int")


def duplicate_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Stretches of windows that begin in an earlier document: (doc_id, row, start, windows, source).

    ``docs``: (doc_id, row, text). ``source`` is the smallest id that holds the stretch.
    """
    found = stored(blocks(docs, window, anchor), "blocks")
    versions = found.groupBy("anchor", "content").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    # An anchor with several versions in several documents has factor boundaries inside blocks.
    split = (
        versions.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("source").alias("low"), F.max("last").alias("high"))
        .where((F.col("n") > 1) & (F.col("low") < F.col("high")))
        .select("anchor", F.lit(True).alias("bounded"))
    )
    repeats = versions.join(split, "anchor", "left").where(F.col("bounded") | (F.col("source") < F.col("last")))
    met = found.join(repeats, ["anchor", "content"])
    phrases = met.where(F.col("source") < F.col("doc_id"))
    inside = (
        met.where(F.col("bounded") & (F.col("source") == F.col("doc_id")))
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("start", "windows")).alias("parts"))
    )
    single = _window_keys(docs.join(inside, ["doc_id", "row"]), window, anchor)
    keys = stored(single, "windows")
    first = keys.groupBy("anchor", "words").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    pieces = keys.join(first.where(F.col("source") < F.col("last")).drop("last"), ["anchor", "words"])
    return phrases.select("doc_id", "row", "start", "windows", "source").unionByName(
        pieces.where(F.col("source") < F.col("doc_id")).select(
            "doc_id", "row", "start", F.lit(1).alias("windows"), "source"
        )
    )


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents without what earlier documents hold: (doc_id, n_words, n_removed, kept, factors).

    ``kept``: the kept words joined by one space; ``factors``: the removed stretches of words
    with the smallest id that holds their beginning.
    """
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    base = base.withColumn("row", F.xxhash64("doc_id", "text"))
    spans = (
        duplicate_spans(base, window, anchor)
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("start", "windows", "source")).alias("parts"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _kept(part, window)

    return base.join(spans, ["doc_id", "row"], "left").mapInArrow(
        run,
        "doc_id long, n_words long, n_removed long, kept string, "
        "factors array<struct<start: int, words: int, source: bigint>>",
    )


def _kept(part: pa.RecordBatch, window: int) -> pa.RecordBatch:
    words = Words(part.column("text"))
    lists = part.column("parts")
    sizes = np.array(lists.value_lengths().fill_null(0), np.int64)
    flat = lists.flatten()
    owner = np.repeat(np.arange(part.num_rows), sizes)
    begin = flat.field("start").to_numpy() + words.first[owner]
    end = begin + flat.field("windows").to_numpy() + window - 1
    order = np.argsort(begin, kind="stable")
    begin, end, owner = begin[order], end[order], owner[order]
    source = flat.field("source").to_numpy()[order]
    # Stretches that touch grow into one factor. Texts lie apart, so a text begins a new one.
    reach = np.maximum.accumulate(end) if len(end) else end
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] > reach[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    low, high = begin[at], reach[np.append(at[1:], len(begin))[: len(at)] - 1]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    gone = np.cumsum(change[:-1]) > 0
    total = np.concatenate(([0], np.cumsum(gone)))
    removed = total[words.first[1:]] - total[words.first[:-1]]
    stay = np.flatnonzero(~gone)
    lengths = words.ends[stay] - words.starts[stay] + 1
    bytes_ = gathered(np.append(words.data, np.uint8(32)), words.starts[stay], lengths)
    to = np.cumsum(lengths)
    bytes_[to - 1] = 32
    cut = np.concatenate(([0], to))[np.searchsorted(stay, words.first)].tolist()
    raw = bytes_.tobytes()
    kept = pa.array([raw[a : max(a, b - 1)] for a, b in zip(cut, cut[1:])], pa.binary()).cast(pa.string())
    factors = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner[at], np.arange(part.num_rows + 1)), pa.int32()),
        pa.StructArray.from_arrays(
            [
                pa.array((low - words.first[owner[at]]).astype(np.int32)),
                pa.array((high - low).astype(np.int32)),
                pa.array(source[at], pa.int64()),
            ],
            ["start", "words", "source"],
        ),
    )
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(words.counts().astype(np.int64)), pa.array(removed.astype(np.int64)), kept, factors],
        ["doc_id", "n_words", "n_removed", "kept", "factors"],
    )
