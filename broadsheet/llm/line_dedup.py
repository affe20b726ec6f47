"""Line deduplication: exact repeats, and near repeats by a segment-partition edit join.

A line is removed where the same line, or one near it, begins earlier: in a document with a
smaller id, or further up in the same document. Near are lines within the edits that the length
of the shorter one allows: one from ``NEAR_CHARS`` code points, and one more for each further
factor of ``GROWTH`` in length, without an upper limit; or within a number of edits that the caller
gives. Lines are judged on the input. Empty lines stay; those under ``NEAR_CHARS`` code points
allow no edit and are compared exactly only.

Exact: lines with equal 128-bit hashes are one line; its first place is a minimum, combined
before the shuffle. Near, over first places only, where the shorter line allows t edits:

* an indexed line of length l is cut into t + 1 segments, of which one must occur unchanged in any
  line within the distance;
* a line probes the index of lengths l - t to l, at those positions where the segment
  can stand if the edits left of it and right of it are counted (multi-match-aware selection);
* hashes of all probes, among them the index keys, are dealt out by key in compact pieces; only lines
  that meet another one by a key, of which one is indexed by it, go on, mostly a few in a hundred;
* a key's probes meet its earliest indexed line first, its hub, so that a group of copies costs as
  many pairs as it has lines. While that removes many lines, the earliest ones not yet removed are
  hubs in turn; then the keys that are left are joined in whole, for lines not yet removed only.
  Among the unchanged segments of a pair, take that after which the edits from the line's begin last
  were as many as the segments passed (``_marked_keys``): as many edits lie to its left as segments
  do, one at most in the next segment, two in the next two, and the rest of t to its right. Counts of
  characters left and right of the segment, of which an edit changes two, are held against that
  within the join, so that lines with one passage in common but not near make few pairs;
* pairs are held against counts of ``CLASSES`` classes of characters, of which an edit changes
  two by one at most, before any text is fetched;
* the rest is verified by a bit-parallel automaton over the band of 2 * t + 1 diagonals for
  many pairs side by side, or, beyond ``BAND_EDITS``, a bit-parallel column of a pair's whole line.

So every line is removed that has an earlier line near it; the one that is told as its source is
near it and earlier, but need not be the earliest such line.

Cases: a null text has no lines and stays null; an empty text is one empty line; a document
with a null id keeps all lines and is nobody's source; rows that repeat an id and a text are
judged alike and don't remove each other's lines; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.arrow_text import Powers, bounds, gathered, mixed, range_hashes, slices
from broadsheet.llm.work import discard, release, stored

EXACT_CHARS = 1  # empty lines stay
NEAR_CHARS = 40  # code points from which a line allows an edit
GROWTH = 3  # factor of length for each further edit
BAND_EDITS = 8  # up to so many edits pairs are verified side by side
PAIR = ["a_doc", "a_line", "b_doc", "b_line"]
FRUITFUL = 0.1  # hubs are tried again while they remove this share of the lines that were left
CLASSES = 32  # of characters, counted in each line
MARKED = 64  # classes of characters, counted beside a segment
RING = np.array([0, 1, 3, 7, 15, 14, 12, 8], np.uint64)  # as many bits apart as counts modulo 8 are, by the shorter way
DEALT = 13  # leading bits of a key by which it is dealt out
KEY_BYTES, LINE_BYTES = 5, 6  # of a key beyond these, and of a line's hash, that are dealt out
DEALT_KEYS = 1 << 20  # keys of a part that are sorted at once
MET_BYTES = 1 << 25  # of the keys with the same leading bits that are compared at once
PACKED_BYTES = 1 << 19  # of compressed text that is unpacked at once
PAIR_CHARS = 1 << 20  # code points of the pairs that are verified side by side

_U = np.uint64
_FIRST, _SECOND = Powers(0xAF251AF3B0F025B5), Powers(0xB564EF22EC7AECE5)


class Lines:
    """Lines of a slice of texts, as stretches of code points."""

    def __init__(self, texts: pa.Array):
        self.data, _ = bounds(texts)
        self.codes = np.frombuffer(str(memoryview(self.data), "utf-8").encode("utf-32-le"), np.uint32)
        first = np.concatenate(([0], np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
        breaks = np.flatnonzero(self.codes == 10)
        null = texts.is_null().to_numpy(zero_copy_only=False)
        here = np.searchsorted(breaks, first)
        self.count = np.where(null, 0, np.diff(here) + 1)
        self.first = np.concatenate(([0], np.cumsum(self.count)))  # a text's first line
        self.text = np.repeat(np.arange(len(texts)), self.count)
        self.number = np.arange(len(self.text)) - self.first[self.text]
        before = here[self.text] + self.number - 1  # the break before a line
        padded = np.append(breaks, len(self.codes))
        self.start = np.where(self.number == 0, first[self.text], padded[np.maximum(before, 0)] + 1)
        last = self.number == self.count[self.text] - 1
        self.end = np.where(last, first[self.text + 1], padded[np.minimum(before + 1, len(padded) - 1)])
        self.size = self.end - self.start

    def texts(self, which: np.ndarray) -> pa.Array:
        """The texts of some lines."""
        place = np.zeros(len(self.codes) + 1, np.int64)
        np.cumsum(
            1 + (self.codes >= 0x80).astype(np.int8) + (self.codes >= 0x800) + (self.codes >= 0x10000), out=place[1:]
        )
        low, size = place[self.start[which]], place[self.end[which]] - place[self.start[which]]
        ends = np.concatenate(([0], np.cumsum(size)))
        return pa.Array.from_buffers(pa.large_string(), len(which), [None, pa.py_buffer(ends), pa.py_buffer(gathered(self.data, low, size))]).cast(pa.string())

    def hashes(self, which: np.ndarray, *powers: Powers) -> np.ndarray:
        """Hashes of ordered lines, a row for each of ``powers``."""
        out = np.empty((len(powers), len(which)), np.uint64)
        for some, codes, start in self.parts(which):
            for row, power in zip(out, powers):
                row[some] = range_hashes(codes, start, start + self.size[which[some]], power)
        return out

    def hashes_any(self, which: np.ndarray) -> np.ndarray:
        """First hashes of lines in any order."""
        order = np.argsort(which, kind="stable")
        out = np.empty(len(which), np.int64)
        out[order] = self.hashes(which[order], _FIRST)[0].view(np.int64)
        return out

    def parts(self, which: np.ndarray, limit: int = 1 << 18):
        """Ordered lines in pieces: their places in ``which``, the codes they span, their starts."""
        at = 0
        while at < len(which):
            low = self.start[which[at]]
            to = max(at + 1, int(np.searchsorted(self.end[which], low + limit, "right")))
            codes = self.codes[low : self.end[which[to - 1]]].astype(np.uint64) + _U(1)
            yield np.arange(at, to), codes, self.start[which[at:to]] - low
            at = to


def allowed(size: np.ndarray, distance: int | None = None) -> np.ndarray:
    """Edits that lines of these lengths allow."""
    if distance is not None:
        return np.full(len(size), distance, np.int64)
    edits, bound = np.zeros(len(size), np.int64), NEAR_CHARS
    while bound <= size.max(initial=0):
        edits += size >= bound
        bound *= GROWTH
    return edits


def _counts(lines: Lines, which: np.ndarray) -> pa.Array:
    """How often each of ``CLASSES`` classes of characters occurs in each line, modulo 256, as bytes."""
    kind = (((lines.codes * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(CLASSES)).astype(np.int64)
    out = np.zeros((len(which), CLASSES), np.uint8)
    for at in range(0, len(out), 256):
        some = which[at : at + 256]
        size, start = lines.size[some], lines.start[some]
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + start[owner]
        out[at : at + 256] = np.bincount(owner * CLASSES + kind[place], minlength=len(size) * CLASSES).reshape(-1, CLASSES)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(CLASSES), len(out), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` compressed, as it is about to be shuffled."""
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [None if not t.is_valid else packer.compress(t.as_buffer()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(texts, pa.binary())], [*rest, "text"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in rest)
    return docs.select(*rest, "text").mapInArrow(run, f"{kinds}, text binary")


def _unpacked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices, with their texts as they were."""
    packer, at = zstandard.ZstdDecompressor(), batch.schema.get_field_index("text")
    for part in slices(batch, "text", PACKED_BYTES):
        texts = pa.array([None if not t.is_valid else packer.decompress(t.as_buffer()) for t in part.column("text")], pa.binary())
        yield from slices(part.set_column(at, "text", texts.view(pa.string())), "text")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line, size, hash_1, hash_2) of all lines but empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines = Lines(part.column("text"))
                long = np.flatnonzero(lines.size >= EXACT_CHARS)
                first, second = lines.hashes(long, _FIRST, _SECOND).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(lines.text[long])),
                        pa.array(lines.number[long].astype(np.int32)),
                        pa.array(lines.size[long].astype(np.int32)),
                        pa.array(first),
                        pa.array(second),
                    ],
                    ["doc_id", "line", "size", "hash_1", "hash_2"],
                )

    return docs.mapInArrow(run, "doc_id long, line int, size int, hash_1 long, hash_2 long")


class Ranges:
    """Hashes of many stretches of the same values."""

    def __init__(self, values: np.ndarray):
        up, self.down = _FIRST.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], dtype=np.uint64, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed(self.sum(starts, ends) + (ends - starts).astype(np.uint64))

    def sum(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of values times powers that begin at 1."""
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]


def segments(size: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the even segments of lines of given lengths; the last ones are longer."""
    count = distance + 1
    short = size // count
    longer = size - short * count  # how many segments have one more
    index = np.arange(count)
    length = short[:, None] + (index[None, :] >= (count - longer)[:, None])
    return np.cumsum(length, 1) - length, length


def _groups(longest: int, distance: int | None) -> list[tuple[int, int, int]]:
    """Numbers of edits, and the lengths of indexed lines for each, from and below."""
    if distance is not None:
        return [(distance, 0, 1 << 31)]
    out, low = [], NEAR_CHARS
    while low <= longest:
        out.append((len(out) + 1, low, low * GROWTH))
        low *= GROWTH
    return out


def _keys(
    lines: Lines, which: np.ndarray, distance: int, probe: bool, low_size: int = 0, high_size: int = 1 << 31, marked: bool = False
) -> list[np.ndarray]:
    """Index keys, or probe keys, of lines: the line's place in ``which``, the key, whether the line is indexed by it.

    Indexed are lines of lengths from ``low_size`` and below ``high_size``. If ``marked``, the segment's
    number and the marks of the text beside it follow.
    """
    out = []
    for some, codes, start in lines.parts(which):
        hashes = Ranges(codes)
        size = lines.size[which[some]]
        for shorter in range(distance + 1) if probe else (0,):
            begin, length = segments(size - shorter, distance)
            meant = (size - shorter >= low_size) & (size - shorter < high_size)
            # A segment can't stand further off than edits may lie to its left, or to its right.
            places = [
                (i, shift)
                for i in range(distance + 1)
                for shift in (range(max(-i, shorter - (distance - i)), min(i, shorter + (distance - i)) + 1) if probe else (0,))
            ]
            which_one, shift = np.array(places, np.int64).reshape(-1, 2).T
            at, long = begin[:, which_one] + shift, length[:, which_one]
            row, column = np.nonzero(meant[:, None] & (at >= 0) & (at + long <= size[:, None]) & (long > 0))
            low = start[row] + at[row, column]
            tag = (size[row] - shorter).astype(np.uint64) * _U(64) + which_one[column].astype(np.uint64)
            high = low + long[row, column]
            found = [some[row], mixed(hashes.of(low, high) + mixed(tag)), (shorter == 0) & (shift[column] == 0)]
            if marked:
                part, begins, stop = which_one[column], start[row], start[row] + size[row]
                ends = [np.minimum(low - at[row, column] + shift[column] + (begin + length)[row, np.minimum(part + k, distance)], stop) for k in (1, 2)]
                found += [part, _marks(codes, [(begins, low), (high, np.maximum(ends[0], high)), (high, np.maximum(ends[1], high)), (high, stop)])]
            out.append(found)
    if not out:
        none = np.zeros(0, np.int64)
        return [none, none.astype(np.uint64), none.astype(bool), none, np.zeros((0, 4 * MARKED // 16), np.int64)][: 5 if marked else 3]
    return [np.concatenate(x) for x in zip(*out)]


def _marks(codes: np.ndarray, stretches: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Counts of the ``MARKED`` classes of characters in stretches of codes, 16 counts of four bits of ``RING`` in a word."""
    words: list[list[np.ndarray]] = [[] for _ in stretches]
    kind = (codes % _U(MARKED)).astype(np.int64)
    for at in range(0, MARKED, 16):
        total = np.zeros((len(codes) + 1, 16), np.uint8)
        here = np.flatnonzero((kind >= at) & (kind < at + 16))
        total[here + 1, kind[here] - at] = 1
        np.cumsum(total, 0, np.uint8, out=total)
        for to, (low, high) in zip(words, stretches):
            ring = RING[(total[high] - total[low]) & 7]
            to.append(np.bitwise_or.reduce(ring << (4 * np.arange(16)).astype(np.uint64), 1).view(np.int64))
    return np.stack([x for to in words for x in to], 1)


def _first_lines(part: pa.RecordBatch) -> tuple[Lines, np.ndarray, np.ndarray]:
    """Lines of a batch, those that are listed in ``wanted``, and the rows of the list."""
    lines = Lines(part.column("text"))
    lists = part.column("wanted")
    sizes = np.array(lists.value_lengths(), np.int64)
    flat = lists.flatten()
    owner = np.repeat(np.arange(part.num_rows), sizes)
    number = flat.field("line").to_numpy()
    row = np.flatnonzero(number < lines.count[owner])  # else another row of the same id is meant
    which = lines.first[owner[row]] + number[row]
    same = lines.hashes_any(which) == flat.field("hash_1").to_numpy()[row]
    return lines, which[same], row[same]


def _line_table(chosen: DataFrame) -> DataFrame:
    """(doc, line, size, counts, text) of the lines listed with each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _unpacked(batch):
                lines, which, _ = _first_lines(part)
                which = np.sort(which)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(lines.text[which])),
                        pa.array(lines.number[which].astype(np.int32)),
                        pa.array(lines.size[which].astype(np.int32)),
                        _counts(lines, which),
                        lines.texts(which),
                    ],
                    ["doc", "line", "size", "counts", "text"],
                )

    return chosen.mapInArrow(run, "doc long, line int, size int, counts binary, text string")


def _probes(
    of: Ranges, start: np.ndarray, size: np.ndarray, distance: int, low_size: int, high_size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probe keys of lines, at the same segments as those of ``_keys``: the line's row, the key, whether it is indexed by it."""
    count = distance + 1
    shorter, part, shift = np.array(
        [
            (less, i, by)
            for less in range(count)
            for i in range(count)
            for by in range(max(-i, less - (distance - i)), min(i, less + (distance - i)) + 1)
        ],
        np.int64,
    ).T
    base = size[:, None] - shorter
    short = base // count
    even = count - (base - short * count)  # segments before those that have one more
    long = short + (part >= even)
    at = part * short + np.maximum(part - even, 0) + shift
    inside = (base >= low_size) & (base < high_size) & (at >= 0) & (long > 0) & (at + long <= size[:, None])
    row, own = np.broadcast_to(np.arange(len(size))[:, None], inside.shape)[inside], (shorter == 0) & (shift == 0)
    low = (start[:, None] + at)[inside]
    tag = (base * 64 + part)[inside].astype(np.uint64)
    return row, mixed(of.sum(low, low + long[inside]) + tag * _U(0x9E3779B97F4A7C15)), np.broadcast_to(own, inside.shape)[inside]


def _dealt(key: np.ndarray, line: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    """(dealt, size, part) of keys with line hashes: a row for all keys with the same leading bits."""
    key = key >> _U(64 - DEALT - 8 * KEY_BYTES + 1) << _U(1) | own.astype(np.uint64)
    order = np.argsort(key)
    key, line = key[order], line[order]
    which, begin = np.unique(key >> _U(8 * KEY_BYTES), return_index=True)
    ends = np.append(begin[1:], len(key))
    # The keys' bytes of a row come before those of its lines.
    low = lambda x, n: np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :n].tobytes()
    keys, lines = low(key, KEY_BYTES), low(line, LINE_BYTES)
    parts = [keys[KEY_BYTES * a : KEY_BYTES * b] + lines[LINE_BYTES * a : LINE_BYTES * b] for a, b in zip(begin.tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays(
        [pa.array(which.astype(np.int32)), pa.array((ends - begin).astype(np.int32)), pa.array(parts, pa.binary())], ["dealt", "size", "part"]
    )


def _met(parts: list[tuple[int, bytes]]) -> np.ndarray:
    """Lines of the parts that share a key with another line, of which one at least is indexed by it."""

    def wide(pieces: list[bytes], n: int) -> np.ndarray:
        out = np.zeros((sum(map(len, pieces)) // n, 8), np.uint8)
        out[:, :n] = np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, n)
        return out.view(np.uint64)[:, 0]

    key = wide([part[: KEY_BYTES * size] for size, part in parts], KEY_BYTES)
    line = wide([part[KEY_BYTES * size :] for size, part in parts], LINE_BYTES)
    order = np.argsort(key)
    key, line = key[order], line[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] >> _U(1) != key[:-1] >> _U(1)
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(key)))
    begin, size = begin[size > 1], size[size > 1]
    if not len(begin):
        return line[:0]
    place = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    key, line, begin = key[place], line[place], np.cumsum(size) - size
    meets = np.bitwise_or.reduceat(key, begin) & _U(1) == 1
    meets &= np.minimum.reduceat(line, begin) != np.maximum.reduceat(line, begin)
    return np.unique(line[np.repeat(meets, size)])


def _meet(batches: Iterator[pa.RecordBatch], limit: int = MET_BYTES) -> Iterator[pa.RecordBatch]:
    """(met) of ``_dealt`` rows in order. Beyond ``limit`` bytes with the same leading bits all their lines go on."""

    def every(parts: list[tuple[int, bytes]]) -> np.ndarray:
        out = np.zeros((sum(size for size, _ in parts), 8), np.uint8)
        out[:, :LINE_BYTES] = np.frombuffer(b"".join(part[KEY_BYTES * size :] for size, part in parts), np.uint8).reshape(-1, LINE_BYTES)
        return np.unique(out.view(np.uint64)[:, 0])

    told = lambda lines: pa.RecordBatch.from_arrays([pa.array(lines.view(np.int64))], ["met"])
    parts: list[tuple[int, bytes]] = []
    last, held, split = None, 0, False
    for batch in batches:
        for dealt, size, part in zip(*(batch.column(c).to_pylist() for c in ("dealt", "size", "part"))):
            if dealt != last:
                if parts:
                    yield told((every if split else _met)(parts))
                parts, last, held, split = [], dealt, 0, False
            elif held > limit:
                yield told(every(parts))
                parts, held, split = [], 0, True
            parts.append((size, part))
            held += len(part)
    if parts:
        yield told((every if split else _met)(parts))


def _meeting(docs: DataFrame, distance: int | None) -> DataFrame:
    """(met): the last bytes of ``hash_1`` of lines that share a key with another line."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        held = 0
        for batch in batches:
            for part in slices(batch, "text"):
                lines = Lines(part.column("text"))
                long = np.flatnonzero(lines.size >= NEAR_CHARS)
                for some, codes, start in lines.parts(long):
                    of, size = Ranges(codes), lines.size[long[some]]
                    hashes, one = np.unique(of.of(start, start + size), return_index=True)
                    start, size = start[one], size[one]
                    for edits, low, high in _groups(int(size.max(initial=0)), distance):
                        mine = np.flatnonzero((size >= low) & (size < high + edits))
                        row, key, own = _probes(of, start[mine], size[mine], edits, low, high)
                        waiting.append([key, hashes[mine[row]], own])
                        held += len(key)
                    if held >= DEALT_KEYS:
                        yield _dealt(*map(np.concatenate, zip(*waiting)))
                        waiting, held = [], 0
        if held:
            yield _dealt(*map(np.concatenate, zip(*waiting)))

    dealt = docs.select("text").mapInArrow(deal, "dealt int, size int, part binary")
    return dealt.repartition("dealt").sortWithinPartitions("dealt").mapInArrow(_meet, "met long").distinct()


def _segment_keys(table: DataFrame, distance: int | None, probe: bool) -> DataFrame:
    """(key, doc, line, own) of the lines of the table; ``own``: the line is indexed by the key, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines = Lines(part.column("text"))
                for edits, low, high in _groups(int(lines.size.max(initial=0)), distance):
                    some = np.flatnonzero((lines.size >= low) & (lines.size < high + (edits if probe else 0)))
                    owner, key, own = _keys(lines, some, edits, probe, low, high)
                    mine = pa.array(some[owner])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), part.column("doc").take(mine), part.column("line").take(mine), pa.array(own)],
                        ["key", "doc", "line", "own"],
                    )

    return table.select("doc", "line", "text").mapInArrow(run, "key long, doc long, line int, own boolean")


def _marked_keys(table: DataFrame, distance: int | None, probe: bool) -> DataFrame:
    """(key, doc, line, size, part, edits, marks): keys with the segment's number, the edits allowed and counts beside it.

    Let e(j) be the edits of segment j of a pair of lines within t edits, and f(k) their sum below k, less k.
    f begins at 0, ends below 0 and falls by one at most, so the last k where it isn't below 0 is an
    unchanged segment with k edits to its left; from there on f stays below 0, so that up to n edits lie in
    the n segments after it, and up to t - k in all. Stretches of equal length beside it that as many
    edits change have counts that differ by twice as many at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines = Lines(part.column("text"))
                for edits, low, high in _groups(int(lines.size.max(initial=0)), distance):
                    some = np.flatnonzero((lines.size >= low) & (lines.size < high + (edits if probe else 0)))
                    owner, key, _, number, marks = _keys(lines, some, edits, probe, low, high, marked=True)
                    mine = pa.array(some[owner])
                    of = np.arange(len(key) + 1, dtype=np.int32) * marks.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)), part.column("doc").take(mine), part.column("line").take(mine),
                            pa.array(lines.size[some[owner]].astype(np.int32)), pa.array(number.astype(np.int32)),
                            pa.array(np.full(len(key), edits, np.int32)), pa.ListArray.from_arrays(pa.array(of), pa.array(marks.reshape(-1))),
                        ],
                        ["key", "doc", "line", "size", "part", "edits", "marks"],
                    )

    return table.select("doc", "line", "text").mapInArrow(run, "key long, doc long, line int, size int, part int, edits int, marks array<long>")


def _joined(index: DataFrame, probes: DataFrame) -> DataFrame:
    """Pairs (one, other) of marked keys' lines that may be near, of which the later is not ``gone``."""
    i, p = index.alias("i"), probes.alias("p")
    place = lambda x: F.struct(F.col(f"{x}.doc").alias("doc"), F.col(f"{x}.line").alias("line"))
    words = MARKED // 16
    apart = lambda k: sum((F.bit_count(F.col("i.marks")[w].bitwiseXOR(F.col("p.marks")[w])) for w in range(k * words, (k + 1) * words)), F.lit(0))
    left, right = F.col("i.part"), F.col("i.edits") - F.col("i.part")
    return i.join(
        p,
        (F.col("i.key") == F.col("p.key"))
        & F.when(place("i") > place("p"), ~F.col("i.gone")).otherwise(~F.col("p.gone"))
        # Lines of one length probe each other: the later one's probe is enough.
        & ((F.col("i.size") < F.col("p.size")) | (place("i") < place("p")))
        & (place("i") != place("p"))
        & (apart(0) <= 2 * left)
        & (apart(3) <= 2 * right)
        & (apart(1) <= F.least(F.lit(2), 2 * right))
        & (apart(2) <= F.least(F.lit(4), 2 * right)),
    ).select(place("i").alias("one"), place("p").alias("other"))


def _alike(pairs: DataFrame, distance: int | None) -> DataFrame:
    """Pairs whose counts of characters allow them to be within the distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, CLASSES) for c in ("a_counts", "b_counts"))
            apart = np.abs((a - b).view(np.int8).astype(np.int64)).sum(1)  # never more than the true difference
            shorter = np.minimum(batch.column("a_size").to_numpy(), batch.column("b_size").to_numpy())
            yield batch.select(PAIR).filter(pa.array(apart <= 2 * allowed(shorter, distance)))

    return pairs.mapInArrow(run, "a_doc long, a_line int, b_doc long, b_line int")


def _verified(pairs: DataFrame, table: DataFrame, facts: DataFrame, distance: int | None) -> DataFrame:
    """Links among pairs (one, other) of places: (a_doc, a_line, b_doc, b_line, distance), a the earlier.

    ``facts``: (doc, line, size, counts) of all lines that occur in pairs.
    """
    of = lambda x: facts.select(
        F.struct("doc", "line").alias(x), F.struct(F.col("doc").alias("doc"), F.col("line").alias("line"), "size", "counts").alias(f"{x}_line")
    )
    known = pairs.where("one <> other").join(of("one"), "one").join(of("other"), "other")
    first, last = F.least("one_line", "other_line"), F.greatest("one_line", "other_line")
    names = lambda x, s: [s[c].alias(f"{x}_{c}") for c in ("doc", "line", "size", "counts")]
    # Rows that repeat an id and a text have their lines twice in the table.
    alike = stored(_alike(known.select(*names("a", first), *names("b", last)), distance).distinct(), "line-pairs")
    wanted = stored(alike.select("a_doc", "a_line").union(alike.select("b_doc", "b_line")).distinct().toDF("doc", "line"), "wanted-lines")
    texts = table.select("doc", "line", "text").join(wanted, ["doc", "line"]).dropDuplicates(["doc", "line"])
    text = lambda x: texts.toDF(f"{x}_doc", f"{x}_line", f"{x}_text")
    both = alike.join(text("a"), ["a_doc", "a_line"]).join(text("b"), ["b_doc", "b_line"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in batch.column(c).to_pylist()] for c in ("a_text", "b_text"))
            size = np.array([len(x) for x in a], np.int64)
            limit = allowed(np.minimum(size, np.array([len(x) for x in b], np.int64)), distance)
            found = np.zeros(len(a), np.int64)
            for edits in np.unique(limit).tolist():
                order = np.flatnonzero(limit == edits)
                order = order[np.argsort(size[order], kind="stable")].tolist()
                at = 0
                while at < len(order) and edits > BAND_EDITS:
                    found[order[at]] = long_distance(a[order[at]], b[order[at]], edits)
                    at += 1
                while at < len(order):
                    to = at + 1
                    while to < len(order) and (to + 1 - at) * (len(a[order[to]]) + 8) <= PAIR_CHARS:
                        to += 1
                    some = order[at:to]
                    found[some] = banded_distance([a[i] for i in some], [b[i] for i in some], edits)
                    at = to
            told = batch.select(PAIR).append_column("distance", pa.array(found.astype(np.int32)))
            yield told.filter(pa.array(found <= limit))

    out = stored(both.mapInArrow(run, "a_doc long, a_line int, b_doc long, b_line int, distance int"), "line-links")
    discard(table.sparkSession, alike, wanted)
    return out


def banded_distance(a: list[np.ndarray], b: list[np.ndarray], limit: int) -> np.ndarray:
    """Edit distances of pairs of code point arrays, ``limit + 1`` where it is exceeded.

    Bit k of a state word stands for the diagonal k - limit: row = column + k - limit. A word
    per number of edits holds the diagonals reached with as many.
    """
    count, width = len(a), 2 * limit + 1
    size_a, size_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    longest = int(max(size_a.max(initial=0), size_b.max(initial=0)))
    left = np.zeros((count, longest + width), np.uint32)  # rows outside a line hold 0, which no code of b + 1 equals
    right = np.zeros((count, longest), np.uint32)
    for i in range(count):
        left[i, limit : limit + len(a[i])] = a[i] + 1
        right[i, : len(b[i])] = b[i] + 1
    full = np.uint32((1 << width) - 1)
    states = [np.full(count, np.uint32(1) << np.uint32(limit), np.uint32)]
    for d in range(1, limit + 1):
        states.append(states[-1] | (states[-1] << np.uint32(1)) & full)
    out = np.full(count, limit + 1, np.int64)

    def settle(column: int) -> None:
        done = np.flatnonzero(size_b == column)
        at = size_a[done] - size_b[done] + limit
        ok = (at >= 0) & (at < width)
        for d in range(limit, -1, -1):
            hit = ok & ((states[d][done] >> np.clip(at, 0, width - 1).astype(np.uint32)) & np.uint32(1) == 1)
            out[done[hit]] = d

    settle(0)
    for column in range(int(size_b.max(initial=0))):
        same = np.zeros(count, np.uint32)
        code = right[:, column]
        for k in range(width):
            same |= ((left[:, column + k] == code) & (code > 0)).astype(np.uint32) << np.uint32(k)
        new = [states[0] & same]
        for d in range(1, limit + 1):
            step = states[d] & same | states[d - 1] | states[d - 1] >> np.uint32(1)
            new.append((step | new[d - 1] << np.uint32(1)) & full)
        states = new
        settle(column + 1)
    return out


def long_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two code point arrays, ``limit + 1`` where it is exceeded."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    counts = np.bincount(a & 255, minlength=256) - np.bincount(b & 255, minlength=256)
    if np.abs(counts).sum() > 2 * limit:  # an edit changes two counts by one at most
        return limit + 1
    for step in (1, -1):  # the same at the beginning, then at the end
        a, b = a[::step], b[::step]
        n = min(len(a), len(b))
        other = np.flatnonzero(a[:n] != b[:n])
        n = int(other[0]) if len(other) else n
        a, b = a[n:][::step], b[n:][::step]
    if not len(a) or not len(b):
        return min(len(a) + len(b), limit + 1)
    where: dict[int, int] = {}
    for i, c in enumerate(a.tolist()):
        where[c] = where.get(c, 0) | 1 << i
    full, last, found = (1 << len(a)) - 1, len(a) - 1, len(a)
    up, down = full, 0
    for left, c in zip(range(len(b) - 1, -1, -1), b.tolist()):
        same = where.get(c, 0)
        steep = same | down
        flat = ((same & up) + up ^ up | same) & full
        more, less = down | full & ~(flat | up), up & flat
        found += (more >> last & 1) - (less >> last & 1)
        if found - left > limit:
            return limit + 1
        more, less = (more << 1 | 1) & full, less << 1 & full
        up, down = less | full & ~(steep | more), more & steep
    return min(found, limit + 1)


def _waiting(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs (one, other) of which the later line isn't removed by the links."""
    gone = links.select(F.struct(F.col("b_doc").alias("doc"), F.col("b_line").alias("line")).alias("later")).distinct()
    return pairs.withColumn("later", F.greatest("one", "other")).join(gone, "later", "left_anti").drop("later")


def _hub_links(pairs: DataFrame, table: DataFrame, facts: DataFrame, distance: int | None) -> DataFrame:
    """Links among pairs (one: a hub, other), written. Each line meets the earliest of its hubs first.

    That removes most lines of a group of copies, so the hubs of their other keys needn't be compared.
    """
    pairs = stored(pairs.distinct(), "hub-pairs")
    first = _verified(pairs.groupBy("other").agg(F.min("one").alias("one")), table, facts, distance)
    rest = _verified(_waiting(pairs, first), table, facts, distance)
    out = stored(first.unionByName(rest).distinct(), "line-links")
    discard(table.sparkSession, pairs, first, rest)
    return out


def near_lines(packed: DataFrame, firsts: DataFrame, distance: int | None = None) -> DataFrame:
    """Links between different lines: (a_doc, a_line, b_doc, b_line, distance), a the earlier.

    Every line with an earlier one near it is the later one of a link; not all such links are told.
    ``packed``: documents of ``_packed``; ``firsts``: (doc_id, line, hash_1) of the lines to compare. Without
    ``distance``, the edits that the shorter line's length allows.
    """
    spark = packed.sparkSession
    listed = firsts.groupBy("doc_id").agg(F.collect_list(F.struct("line", "hash_1")).alias("wanted"))
    table = stored(_line_table(packed.join(listed, "doc_id")), "line-table", "zstd")
    release(spark)  # of the shuffled texts
    place, hub = F.struct("doc", "line"), F.col("hub")
    hubs = _segment_keys(table, distance, False).groupBy("key").agg(F.min(place).alias("hub"), (F.count("*") > 1).alias("more"))
    hubs = stored(hubs, "line-hubs", "zstd")
    met = _segment_keys(table, distance, True).join(hubs, "key").where(F.col("more") | (hub != place))
    met = stored(met, "line-probes", "zstd")
    discard(spark, hubs)
    release(spark)  # of the shuffled probes
    involved = met.select("doc", "line").union(met.select("hub.doc", "hub.line")).distinct()
    facts = stored(table.select("doc", "line", "size", "counts").join(involved, ["doc", "line"], "left_semi"), "line-facts")
    links = _hub_links(met.select(hub.alias("one"), place.alias("other")).where("one <> other"), table, facts, distance)

    # Keys with several indexed lines: those lines but the hub, and all that probe them.
    rest = stored(met.where("more and own").where(place != hub).select("key", "doc", "line").distinct(), "line-index", "zstd")
    asking = stored(met.where("more").select("key", "doc", "line").distinct(), "line-probes", "zstd")
    discard(spark, met)
    removed = lambda told: told.select(F.col("b_doc").alias("doc"), F.col("b_line").alias("line")).distinct()
    left, new = asking.select("doc", "line").distinct().count(), removed(links).count()
    while left and new >= FRUITFUL * left:
        gone = removed(links)
        hubs = stored(rest.join(gone, ["doc", "line"], "left_anti").groupBy("key").agg(F.min(place).alias("hub")), "line-hubs")
        pairs = asking.join(hubs, "key").select(hub.alias("one"), place.alias("other")).where("one <> other")
        # Of use are lines that aren't removed yet: probes, or hubs with an earlier probe.
        more = _hub_links(_waiting(pairs, links), table, facts, distance)
        left, new = left - new, removed(more).count()
        fewer = stored(rest.join(hubs, "key", "left").where(hub.isNull() | (hub != place)).drop("hub"), "line-index")
        both = stored(links.unionByName(more), "line-links")
        discard(spark, rest, hubs, links, more)
        rest, links = fewer, both

    gone = removed(links).withColumn("gone", F.lit(True))
    asks = asking.join(gone, ["doc", "line"], "left").select("key", "doc", "line", F.coalesce("gone", F.lit(False)).alias("gone"))
    keys = asks.groupBy("key").agg((F.count("*") > 1).alias("several"), F.bool_or(~F.col("gone")).alias("waits")).where("several and waits")
    keys = stored(keys.join(rest.select("key").distinct(), "key", "left_semi").select("key"), "line-keys")
    asks = stored(asks.join(keys, "key", "left_semi"), "line-probes")
    few = table.select("doc", "line", "text").join(asks.select("doc", "line").distinct(), ["doc", "line"], "left_semi")
    few = stored(few.dropDuplicates(["doc", "line"]), "line-few", "zstd")
    release(spark)
    same = ["key", "doc", "line"]
    pairs = _joined(
        _marked_keys(few, distance, False).join(rest.join(asks, same), same), _marked_keys(few, distance, True).join(asks, same)
    )
    last = _verified(pairs.distinct(), table, facts, distance)
    told = stored(links.unionByName(last), "line-links")
    discard(spark, table, rest, asking, keys, asks, few, facts, links, last)
    return told


def repeated_lines(docs: DataFrame, distance: int | None = None) -> DataFrame:
    """Lines to remove: (doc_id, line, hash_1, source_doc, source_line, distance)."""
    lines = stored(_lines(docs.where("doc_id is not null")), "lines", "zstd")
    classes = lines.groupBy("hash_1", "hash_2").agg(
        F.min(F.struct("doc_id", "line")).alias("first"), F.max(F.struct("doc_id", "line")).alias("last"), F.first("size").alias("size"),
    )
    classes = stored(classes, "line-classes", "zstd")
    firsts = classes.where(F.col("size") >= NEAR_CHARS).select("first.doc_id", "first.line", "hash_1")
    met = stored(_meeting(docs.where("doc_id is not null"), distance), "lines-met", "zstd")
    release(docs.sparkSession)  # of the keys that were dealt out
    firsts = firsts.join(met, F.col("hash_1").bitwiseAND((1 << 8 * LINE_BYTES) - 1) == F.col("met"), "left_semi")
    near = near_lines(_packed(docs), firsts, distance)
    earliest = near.groupBy("b_doc", "b_line").agg(
        F.min(F.struct(F.col("a_doc").alias("doc_id"), F.col("a_line").alias("line"), "distance")).alias("near")
    )
    told = classes.join(
        earliest.select(F.struct(F.col("b_doc").alias("doc_id"), F.col("b_line").alias("line")).alias("first"), "near"),
        "first",
        "left",
    ).where(F.col("near").isNotNull() | (F.col("first") < F.col("last")))
    own = F.struct("doc_id", "line")
    source = F.when(F.col("near").isNotNull(), F.col("near")).otherwise(
        F.struct(F.col("first.doc_id"), F.col("first.line"), F.lit(0).alias("distance"))
    )
    gone = (
        lines.join(told.drop("size", "last"), ["hash_1", "hash_2"])
        .where(F.col("near").isNotNull() | (own > F.col("first")))
        .select("doc_id", "line", "hash_1", source.alias("s"))
        .select(
            "doc_id", "line", "hash_1",
            F.col("s.doc_id").alias("source_doc"), F.col("s.line").alias("source_line"), F.col("s.distance"),
        )
    )
    out = stored(gone, "repeated-lines")
    discard(docs.sparkSession, lines, classes, met, near)
    release(docs.sparkSession)
    return out


def dedup_lines(
    docs: DataFrame, distance: int | None = None, keep: Sequence[str] = (), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ``keep``, n_lines, n_removed, kept, removed) of each document; ``kept``: its other lines."""
    base = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        F.struct(F.lit(True).alias("__own"), *[F.col(f"`{c}`") for c in keep]).alias("rest"),
    )
    gone = (
        repeated_lines(base.drop("rest"), distance)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("line", "hash_1", "source_doc", "source_line", "distance")).alias("wanted"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _unpacked(batch):
                yield _without(part)

    found = _packed(base).join(gone, "doc_id", "left").mapInArrow(
        run,
        f"doc_id long, rest {base.schema['rest'].dataType.simpleString()}, n_lines long, n_removed long, kept string, "
        "removed array<struct<line: int, source_doc: bigint, source_line: int, distance: int>>",
    )
    return found.select("doc_id", *[F.col("rest").getField(c).alias(c) for c in keep], "n_lines", "n_removed", "kept", "removed")


def _without(part: pa.RecordBatch) -> pa.RecordBatch:
    empty = pa.scalar([], part.column("wanted").type)
    part = part.set_column(part.schema.get_field_index("wanted"), "wanted", part.column("wanted").fill_null(empty))
    lines, which, row = _first_lines(part)
    order = np.argsort(which, kind="stable")
    which, row = which[order], row[order]
    new = np.ones(len(which), bool)
    new[1:] = which[1:] != which[:-1]
    which, row = which[new], row[new]
    gone = np.zeros(len(lines.text), bool)
    gone[which] = True
    last = lines.number == lines.count[lines.text] - 1
    size = lines.size + ~last  # with the break that follows
    codes = lines.codes[np.repeat(~gone, size)]
    to = np.concatenate(([0], np.cumsum(np.where(gone, 0, size))))[lines.first]
    rest = np.concatenate(([0], np.cumsum(~gone)))[lines.first]
    ends = lines.first[1:] - 1
    loose = np.zeros(len(part), bool)  # the break behind the last line that stays
    some = lines.count > 0
    loose[some] = gone[ends[some]] & (np.diff(rest)[some] > 0)
    null = part.column("text").is_null().to_pylist()
    raw = memoryview(codes).cast("B")
    kept = [None if none else str(raw[4 * a : 4 * b], "utf-32-le") for a, b, none in zip(to[:-1].tolist(), (to[1:] - loose).tolist(), null)]
    flat = part.column("wanted").flatten().take(pa.array(row))
    names = ["line", "source_doc", "source_line", "distance"]
    removed = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(which, lines.first), pa.int32()),
        pa.StructArray.from_arrays([flat.field(n) for n in names], names),
    )
    count = np.concatenate(([0], np.cumsum(gone)))
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            part.column("rest"),
            pa.array(lines.count.astype(np.int64)),
            pa.array((count[lines.first[1:]] - count[lines.first[:-1]]).astype(np.int64)),
            pa.array(kept, pa.string()),
            removed,
        ],
        ["doc_id", "rest", "n_lines", "n_removed", "kept", "removed"],
    )
