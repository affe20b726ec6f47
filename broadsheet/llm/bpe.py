"""Byte-level BPE encoding and decoding with given merge ranks.

Each match of the split pattern is a piece. Over the byte positions of a piece stands a
segment tree whose leaves hold the rank of the pair that begins there, and whose root
therefore holds the leftmost pair of least rank. A merge changes three leaves (the pair
itself, the one before it and the one that vanishes), so it costs a logarithmic number of node
updates. Short pieces of a slice are merged in lockstep, one tree per row of a matrix; long
pieces have a tree of their own. Each distinct piece of a slice is encoded once.

Results: a null or empty text has no ids; ids that are null or unknown decode to nothing;
repeated rows give repeated rows. Rank files are read on the driver and sent with the tasks
(their size is that of the vocabulary).
"""

from __future__ import annotations

import base64
import unicodedata
import uuid
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.arrow_text import bounds, gathered, piece_hashes, slices

_NONE = np.int64(1) << 62
_LOCKSTEP = 64  # bytes of the longest piece that is merged in lockstep
_CACHED = 150_000  # distinct pieces whose ids a Python worker remembers

# White space of the split pattern, and its contractions.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS_1 = "stmd"
CONTRACTIONS_2 = ("re", "ve", "ll")

_OTHER, _LETTER, _NUMBER, _WHITE = 0, 1, 2, 3


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = np.zeros(0x110000, np.uint8)
    first = {"L": _LETTER, "N": _NUMBER}
    for code in range(0x110000):
        kinds[code] = first.get(unicodedata.category(chr(code))[0], _OTHER)
    kinds[WHITE_SPACE] = _WHITE
    return kinds


def split_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a piece of the split pattern begins, over all texts of a slice.

    Runs of letters, numbers, other characters and white space are the pieces, except that the
    last white space before a run is a piece of its own, or the run's prefix if it is a space,
    and that an apostrophe without prefix takes a contraction's letters along.
    """
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    place = np.zeros(n + 1, np.int64)
    np.cumsum(1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000), out=place[1:])
    kind = _classes()[codes]
    text_start = np.zeros(n + 1, bool)
    text_start[np.searchsorted(place, offsets)] = True
    begin = text_start[:-1].copy()
    begin[0] = True
    begin[1:] |= kind[1:] != kind[:-1]
    white = kind == _WHITE
    run_end = np.ones(n, bool)  # the last character of a run
    run_end[:-1] = begin[1:]
    # White space before a run of the same text gives up its last character.
    gives = np.flatnonzero(white & run_end)
    gives = gives[(gives + 1 < n) & ~text_start[gives + 1]]
    starts = begin.copy()
    starts[gives] = True
    prefix = gives[codes[gives] == 0x20]
    starts[prefix + 1] = False
    # Contractions: a lone apostrophe that begins a piece, before letters of the same text.
    quote = np.flatnonzero((codes == 0x27) & begin & run_end & starts)
    quote = quote[(quote + 1 < n) & ~text_start[quote + 1]]
    quote = quote[kind[quote + 1] == _LETTER]
    if len(quote):
        one = codes[quote + 1]
        ends = np.zeros(len(quote), np.int64)
        for c in CONTRACTIONS_1:
            ends[one == ord(c)] = 1
        inside = quote + 2 < n
        two = codes[np.minimum(quote + 2, n - 1)]
        inside &= ~text_start[np.minimum(quote + 2, n - 1)]
        for a, b in CONTRACTIONS_2:
            ends[inside & (one == ord(a)) & (two == ord(b))] = 2
        taken = quote[ends > 0]
        after = taken + 1 + ends[ends > 0]
        starts[taken + 1] = False
        starts[after[(after < n) & (kind[np.minimum(after, n - 1)] == _LETTER)]] = True
    return place[:-1][starts]


class Merges:
    """The ranks in the forms that the merge loops use."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.size = max(self.tokens) + 1
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.forget()

    def forget(self) -> None:
        """Drop the remembered pieces: their numbers by hash, and by number where their ids lie."""
        self.known: dict[int, int] = {}
        self.stock = np.zeros(1 << 16, np.int32)
        self.place = np.zeros(1 << 14, np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, ``_NONE`` where they don't merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def lockstep(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces given as rows of bytes; ids by row and position, -1 where none begins."""
        count, width = rows.shape
        ids = self.byte_ids[rows]
        place = np.arange(width)
        live = place[None, :] < lengths[:, None]
        nxt = np.tile(place + 1, (count, 1))
        prv = np.tile(place - 1, (count, 1))
        leaf = np.full((count, width), _NONE)
        has_pair = place[None, :-1] + 1 < lengths[:, None]
        ranks = self.rank_of(ids[:, :-1], ids[:, 1:])
        leaf[:, :-1] = np.where(has_pair & (ranks < _NONE), ranks * width + place[:-1], _NONE)
        tree = np.full((count, 2 * width), _NONE)
        tree[:, width:] = leaf
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        # From here on, flat positions: row * width + place, and row * 2 * width + node.
        ids, live, nxt, prv, tree = ids.ravel(), live.ravel(), nxt.ravel(), prv.ravel(), tree.ravel()
        depth = width.bit_length() - 1
        row = np.flatnonzero(tree[1 :: 2 * width] < _NONE)
        while len(row):
            base, root = row * width, row * (2 * width)
            top = tree[root + 1]
            rank, i = top >> depth, top & (width - 1)
            at = base + i
            j = nxt[at]
            k = nxt[base + j]
            ids[at] = rank
            live[base + j] = False
            nxt[at] = k
            tree[root + width + j] = _NONE
            inner = np.flatnonzero(k < lengths[row])
            next_at = base[inner] + k[inner]
            prv[next_at] = i[inner]
            leaf = np.full(len(row), _NONE)
            leaf[inner] = self._leaf(rank[inner], ids[next_at], i[inner], depth)
            tree[root + width + i] = leaf
            h = prv[at]
            had = np.flatnonzero(h >= 0)
            h = h[had]
            tree[root[had] + width + h] = self._leaf(ids[base[had] + h], rank[had], h, depth)
            node = np.concatenate((i, j, h)) + width
            roots = np.concatenate((root, root, root[had]))
            for _ in range(depth):
                node >>= 1
                children = roots + 2 * node
                tree[roots + node] = np.minimum(tree[children], tree[children + 1])
            row = row[tree[root + 1] < _NONE]
        return ids.reshape(count, width), live.reshape(count, width)

    def _leaf(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
        rank = self.rank_of(left, right)
        return np.where(rank < _NONE, (rank << depth) + place, _NONE)

    def alone(self, piece: bytes) -> list[int]:
        """Ids of one long piece, by a segment tree of its own."""
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        none = int(_NONE)
        ids = [int(self.byte_ids[b]) for b in piece]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        live = [True] * n
        pairs, size = self.pairs, self.size
        leaf = lambda i, j: none if (r := pairs.get(ids[i] * size + ids[j])) is None else r * width + i
        tree = [none] * (2 * width)
        tree[width : width + n - 1] = [leaf(i, i + 1) for i in range(n - 1)]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(place: int, value: int) -> None:
            node = place + width
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    return
                tree[node] = least
                node >>= 1

        while tree[1] < none:
            rank, i = divmod(tree[1], width)
            j = nxt[i]
            k = nxt[j]
            ids[i] = rank
            live[j] = False
            nxt[i] = k
            put(j, none)
            if k < n:
                prv[k] = i
                put(i, leaf(i, k))
            else:
                put(i, none)
            if prv[i] >= 0:
                put(prv[i], leaf(prv[i], i))
        return [x for x, keep in zip(ids, live) if keep]

    def encode_pieces(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece one after another, and how many ids each piece has."""
        sizes = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # pieces, their ids
        width = 2
        while width <= _LOCKSTEP:
            which = np.flatnonzero((lengths <= width) & (lengths > (width // 2 if width > 2 else 0)))
            for low in range(0, len(which), 1 + (1 << 18) // width):
                some = which[low : low + 1 + (1 << 18) // width]
                index = np.minimum(starts[some][:, None] + np.arange(width), len(data) - 1)
                ids, live = self.lockstep(data[index], lengths[some])
                sizes[some] = live.sum(1)
                parts.append((some, ids[live]))
            width *= 2
        for one in np.flatnonzero(lengths > _LOCKSTEP):
            ids = self.alone(data[starts[one] : starts[one] + lengths[one]].tobytes())
            sizes[one] = len(ids)
            parts.append((np.array([one]), np.array(ids, np.int64)))
        at = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.int32)
        for some, ids in parts:
            own = sizes[some]
            out[np.repeat(at[some] - (np.cumsum(own) - own), own) + np.arange(len(ids))] = ids
        return out, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offsets between texts."""
        data, offsets = bounds(texts)
        starts = split_pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        kinds, first, index = np.unique(piece_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > _CACHED:
            self.forget()
        keys = kinds.tolist()
        number = np.array([self.known.get(key, -1) for key in keys], np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            at = first[new]
            ids, sizes = self.encode_pieces(data, starts[at], ends[at] - starts[at])
            had = len(self.known)
            number[new] = np.arange(had, had + len(new))
            self.known.update(zip(kinds[new].tolist(), range(had, had + len(new))))
            used = int(self.place[had])
            self.stock = _with_room(self.stock, used + len(ids))
            self.stock[used : used + len(ids)] = ids
            self.place = _with_room(self.place, had + len(new) + 1)
            self.place[had + 1 : had + len(new) + 1] = used + np.cumsum(sizes)
        number = number[index.ravel()]
        sizes = self.place[number + 1] - self.place[number]
        ids = gathered(self.stock, self.place[number], sizes)
        total = np.concatenate(([0], np.cumsum(sizes)))
        return ids, total[np.searchsorted(starts, offsets)]


def _with_room(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate((array, np.zeros(2 * size - len(array), array.dtype)))


_READY: dict[str, Merges] = {}


def _merges(key: str, ranks: dict[bytes, int]) -> Merges:
    """Kept by a Python worker between the batches and tasks that it runs."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = Merges(ranks)
    return _READY[key]


class Decoder:
    """Bytes of token ids by table lookup."""

    def __init__(self, ranks: dict[bytes, int]):
        by_rank = {rank: token for token, rank in ranks.items()}
        table = [by_rank.get(i, b"") for i in range(max(by_rank) + 2)]  # the last: any id that is not known
        self.lengths = np.array([len(t) for t in table], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.raw = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """One binary value for each stretch of ids between two offsets."""
        last = len(self.lengths) - 1
        ids = np.where((ids < 0) | (ids >= last), last, ids)
        data = gathered(self.raw, self.begins[ids], self.lengths[ids])
        ends = np.concatenate(([0], np.cumsum(self.lengths[ids])))[offsets].astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def _carried(df: DataFrame, column: str, *made: str) -> tuple[DataFrame, list[str], str]:
    """A column beside all others in one, those that are made anew left out."""
    rest = [c for c in df.columns if c.lower() not in {m.lower() for m in made}]
    carried = df.select(F.col(f"`{column}`").alias("__in"), F.struct(F.lit(0).alias("__own"), *[F.col(f"`{c}`") for c in rest]).alias("__row"))
    return carried, rest, carried.schema["__row"].dataType.simpleString()


def _encoded(docs: DataFrame, ranks_path: str, text: str, ids: str, decoded: str | None) -> DataFrame:
    ranks, key = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path)), uuid.uuid4().hex
    carried, rest, kind = _carried(docs, text, ids, *([decoded] if decoded else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(key, ranks.value)
        decoder = Decoder(ranks.value) if decoded else None
        for batch in batches:
            for part in slices(batch, "__in", 1 << 19):
                values, offsets = merges.encode(part.column("__in"))
                found = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))]
                if decoder:
                    found.append(decoder.decode(values, offsets))
                yield pa.RecordBatch.from_arrays([part.column("__row"), *found], ["__row", "__ids", "__decoded"][: 1 + len(found)])

    out = carried.mapInArrow(run, f"__row {kind}, __ids array<int>" + (", __decoded binary" if decoded else ""))
    back = [F.col("__row").getField(c).alias(c) for c in rest]
    return out.select(*back, F.col("__ids").alias(ids), *([F.col("__decoded").alias(decoded)] if decoded else []))


def encode(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of the text's token ids (array<int>); it replaces a column of that name."""
    return _encoded(docs, ranks_path, text, ids, None)


def round_trip(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the text's token ids and, in the same pass, the bytes that the ids decode to."""
    return _encoded(docs, ranks_path, text, ids, decoded)


def decode(tokens: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes that the ids stand for in place of the ids."""
    ranks = tokens.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    carried, rest, kind = _carried(tokens, ids, ids, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ranks.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                lists = part.column("__in")
                sizes = np.array(lists.value_lengths().fill_null(0), np.int64)
                flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                found = decoder.decode(flat, np.concatenate(([0], np.cumsum(sizes))))
                yield pa.RecordBatch.from_arrays([part.column("__row"), found], ["__row", "__decoded"])

    out = carried.mapInArrow(run, f"__row {kind}, __decoded binary")
    return out.select(*[F.col("__row").getField(c).alias(c) for c in rest], F.col("__decoded").alias(decoded))
