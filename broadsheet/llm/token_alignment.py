"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

A text with a space before it is encoded by tokenizer A (byte-level BPE) and B (pieces with
byte fallback). A byte offset where a token of both ends is a cut. An interval of tokens is
divided at a cut near its middle: from the middle token of A outwards, each token's end is looked
up among B's by bisection until one is found there, and both halves are divided alike. An
interval without a cut inside is a leaf: a group of A's and B's tokens over the same bytes. The
intervals of all texts of a slice are divided in step, level by level.

A link is a pair of token occurrences whose byte ranges overlap; the count of a pair of ids is the
number of documents in which it is linked. Documents are worked on in chunks of bounded bytes.
A chunk writes its documents' pairs as numbers into a list of its distinct pairs, with how many
of its documents hold each. Only these lists are shuffled: added up to counts, joined with the
counts, and sent back to their chunk, where the sums are taken. So a pair that all texts hold has
one row a chunk, and the texts are encoded once.

Cases: texts that are null or empty, or whose tokens' bytes of either side are not the bytes of
the spaced text (what a tokenizer normalises), have no tokens; strings of special tokens are plain
text; a very long text is a chunk of its own; repeated rows are documents of their own; null ids
are kept; an empty table gives no rows; columns but those to ``keep`` are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from functools import lru_cache
from typing import Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.arrow_text import bounds, gathered, slices
from broadsheet.llm.bpe import Merges
from broadsheet.llm.work import stored

CHUNK_BYTES = 1 << 19  # of text in a chunk
_B_BITS = 32  # a pair of ids is a << _B_BITS | b


class Vocabulary(NamedTuple):
    """Bytes of all tokens, one after another, and where each id's begin."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, tokens: Sequence[bytes]) -> "Vocabulary":
        size = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_tokens(model: str) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer file; added tokens are their own text."""
    spec, alphabet = json.loads(model), byte_alphabet()
    found = {i: bytes(alphabet[c] for c in token) for token, i in spec["model"]["vocab"].items() if all(c in alphabet for c in token)}
    for token in spec.get("added_tokens", ()):
        found[token["id"]] = token["content"].encode()
    return [found.get(i, b"") for i in range(max(found, default=-1) + 1)]


def piece_bytes(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class PieceCoder(Merges):
    """Ids by a byte-level tokenizer file, of each distinct piece of the split pattern once."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_str(model)
        self.coder.encode_special_tokens = True
        spec = json.loads(model)
        split = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("tokenizer A must be byte-level, with its usual split pattern and no normalizer")
        self.forget()

    def encode_pieces(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        pieces = [raw[s : s + n].decode() for s, n in zip(starts.tolist(), lengths.tolist())]
        lists = [e.ids for e in self.coder.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([i for ids in lists for i in ids], np.int32), np.array([len(ids) for ids in lists], np.int64)


@lru_cache(maxsize=2)
def _tokenizers(a_model: str, b_model: bytes):
    """Both tokenizers and their vocabularies, loaded once a Python worker."""
    import sentencepiece

    b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    pieces = [piece_bytes(b.id_to_piece(i)) for i in range(b.get_piece_size())]
    return PieceCoder(a_model), b, Vocabulary.of(byte_level_tokens(a_model)), Vocabulary.of(pieces)


@lru_cache(maxsize=1)
def _decimals(count: int) -> Vocabulary:
    """Ids in decimal, with a place for what follows each."""
    return Vocabulary.of([b"%d," % i for i in range(count)])


class Tokens(NamedTuple):
    """Tokens of several texts; ``ends`` are byte offsets in all texts together."""

    ids: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # each text's first token, and the number of tokens at the end

    @classmethod
    def of(cls, lists: list[np.ndarray], vocabulary: Vocabulary) -> "Tokens":
        ids = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        first = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
        return cls(ids, np.cumsum(vocabulary.size[ids]), first)


def shared_cuts(a: Tokens, b: Tokens) -> np.ndarray:
    """For tokens of A in order, whether a token of B ends where they end.

    Texts of both sides must have the same bytes, so the last tokens of texts are cuts. An
    interval (low, high) holds A's tokens that may still be cuts, between two known ones.
    """
    cut = np.zeros(len(a.ids), bool)
    has = a.first[1:] > a.first[:-1]
    low, high = a.first[:-1][has], a.first[1:][has] - 1
    cut[high] = True
    while len(low):
        some = low < high
        low, high = low[some], high[some]
        middle, reach = (low + high - 1) // 2, 0
        found = np.full(len(low), -1, np.int64)
        looking = np.arange(len(low))
        while len(looking):  # the middle token, then those beside it on both sides
            for place in {reach, -reach}:
                at = middle[looking] + place
                inside = (at >= low[looking]) & (at < high[looking])
                at, who = at[inside], looking[inside]
                end = a.ends[at]
                where = np.searchsorted(b.ends, end)
                same = b.ends[where] == end  # B's last end is not before any of A's
                found[who[same]] = at[same]
            reach += 1
            looking = looking[found[looking] < 0]
            looking = looking[(middle[looking] - reach >= low[looking]) | (middle[looking] + reach < high[looking])]
        split = np.flatnonzero(found >= 0)
        cut[found[split]] = True
        low, high = np.concatenate((low[split], found[split] + 1)), np.concatenate((found[split], high[split]))
    return cut


def links(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places of A's and B's tokens whose byte ranges overlap, in A's order."""
    a_start, b_start = (np.concatenate(([0], x.ends[:-1])) for x in (a, b))
    low = np.searchsorted(b.ends, a_start, "right")
    high = np.searchsorted(b_start, a.ends, "left")
    count = np.maximum(high - low, 0)
    count[a_start == a.ends] = 0  # a token without bytes overlaps nothing
    left = np.repeat(np.arange(len(a.ids)), count)
    right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + low[left]
    some = b_start[right] < b.ends[right]
    return left[some], right[some]


def _like(vocabulary: Vocabulary, ids: np.ndarray, first: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the tokens of each text have the bytes of the text."""
    size = vocabulary.size[ids]
    whole = np.concatenate(([0], np.cumsum(size)))[first]
    fits = np.diff(whole) == np.diff(offsets)
    if fits.all():
        same = gathered(vocabulary.data, vocabulary.start[ids], size) == data
        return fits & (np.diff(np.concatenate(([0], np.cumsum(~same)))[offsets]) == 0)
    for i in np.flatnonzero(fits):
        own = ids[first[i] : first[i + 1]]
        fits[i] = (gathered(vocabulary.data, vocabulary.start[own], vocabulary.size[own]) == data[offsets[i] : offsets[i + 1]]).all()
    return fits


def _of_texts(ids: np.ndarray, first: np.ndarray, kept: np.ndarray, vocabulary: Vocabulary) -> Tokens:
    """Tokens, those of some texts left out."""
    count = np.diff(first)
    return Tokens(
        own := ids[np.repeat(kept, count)],
        np.cumsum(vocabulary.size[own]),
        np.concatenate(([0], np.cumsum(np.where(kept, count, 0)))).astype(np.int64),
    )


class Chunk:
    """Tokens, groups and links of the texts of a slice."""

    def __init__(self, texts: pa.Array, a_model: str, b_model: bytes):
        a_coder, b_coder, a_words, b_words = _tokenizers(a_model, b_model)
        plain = [t or "" for t in texts.to_pylist()]
        spaced = pa.array([" " + t for t in plain], pa.large_string())
        data, offsets = bounds(spaced)
        a_ids, a_first = a_coder.encode(spaced)
        lists = [np.array(ids, np.int64) for t in plain for ids in (b_coder.encode(t, num_threads=1),)]
        b_ids = np.concatenate([*lists, np.zeros(0, np.int64)])
        b_first = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
        a_ids = a_ids.astype(np.int64)
        kept = np.array([t != "" for t in plain], bool)
        kept &= _like(a_words, a_ids, a_first, data, offsets)
        kept &= _like(b_words, b_ids, b_first, data, offsets)
        self.a, self.b = _of_texts(a_ids, a_first, kept, a_words), _of_texts(b_ids, b_first, kept, b_words)
        self.cut = shared_cuts(self.a, self.b)
        self.ids = max(len(a_words.size), len(b_words.size))

    def groups(self) -> tuple[list[bytes], np.ndarray]:
        """Groups of each text, as ``a1,a2|b1;a3|b2,b3``, and how many there are."""
        a, b = self.a, self.b
        b_cut = np.zeros(len(b.ids), bool)
        b_cut[np.searchsorted(b.ends, a.ends[self.cut])] = True
        # A group's tokens of A, then its tokens of B: each token goes behind those of the other side before it.
        before = lambda cut: np.concatenate(([0], np.cumsum(cut)))[:-1]
        a_group, b_group = before(self.cut), before(b_cut)
        b_to = np.concatenate(([0], np.flatnonzero(b_cut) + 1))
        a_to = np.concatenate(([0], np.flatnonzero(self.cut) + 1))
        a_at, b_at = np.arange(len(a.ids)) + b_to[a_group], np.arange(len(b.ids)) + a_to[b_group + 1]
        ids = np.zeros(len(a.ids) + len(b.ids), np.int64)
        after = np.full(len(ids), ord(","), np.uint8)
        ids[a_at], ids[b_at] = a.ids, b.ids
        after[a_at[self.cut]], after[b_at[b_cut]] = ord("|"), ord(";")
        said = _decimals(self.ids)
        out = gathered(said.data, said.start[ids], said.size[ids])
        to = np.cumsum(said.size[ids])
        out[to - 1] = after
        ends = np.concatenate(([0], to))[a.first + b.first].tolist()
        raw = out.tobytes()
        groups = np.concatenate(([0], np.cumsum(self.cut)))[a.first]
        return [raw[i : max(i, j - 1)] for i, j in zip(ends, ends[1:])], np.diff(groups)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, pair of ids) in order, and how many links of the text are of the pair."""
        left, right = links(self.a, self.b)
        text = np.searchsorted(self.a.first, left, "right") - 1
        pair = self.a.ids[left] << _B_BITS | self.b.ids[right]
        order = np.lexsort((pair, text))
        text, pair = text[order], pair[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
        at = np.flatnonzero(new)
        return text[at], pair[at], np.diff(np.append(at, len(text)))


CHUNK_SCHEMA = (
    "doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
    "chunk binary, pairs array<long>, documents array<int>, first array<int>, places binary, links binary"
)


def _chunks(docs: DataFrame, a_model: str, b_model: bytes, digest: bool) -> DataFrame:
    """A row for each chunk of texts: its documents, its distinct pairs, and which documents hold which.

    ``first``, ``places``, ``links``: for each document from where on, in which place of
    ``pairs``, and how often.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                chunk = Chunk(part.column("text"), a_model, b_model)
                groups, n_groups = chunk.groups()
                groups = [hashlib.sha256(g).hexdigest() if g else "" for g in groups] if digest else [g.decode() for g in groups]
                text, pair, count = chunk.pairs()
                distinct, place, held = np.unique(pair, return_inverse=True, return_counts=True)
                n = part.num_rows
                n_links = np.bincount(text, count, n).astype(np.int64)
                one = lambda values, kind: pa.array([values], kind)
                longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        one(part.column("doc_id").to_pylist(), longs),
                        one(np.diff(chunk.a.first), longs),
                        one(np.diff(chunk.b.first), longs),
                        one(n_groups, longs),
                        one(n_links, longs),
                        one(groups, pa.list_(pa.string())),
                        pa.array([uuid.uuid4().bytes]),  # written once, so it stays
                        one(distinct, longs),
                        one(held.astype(np.int32), ints),
                        one(np.searchsorted(text, np.arange(n + 1)).astype(np.int32), ints),
                        one(place.astype(np.int32).tobytes(), pa.binary()),
                        one(count.astype(np.int32).tobytes(), pa.binary()),
                    ],
                    [field.split()[0] for field in CHUNK_SCHEMA.split(", ")],
                )

    return docs.mapInArrow(run, CHUNK_SCHEMA)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, count, best): documents in which a pair is linked; whether no pair of its A id has more."""
    counted = stored(
        chunks.select(F.explode(F.arrays_zip("pairs", "documents")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.documents").alias("count")),
        "pair-counts",
    )
    a_id = F.shiftright("pair", _B_BITS)
    most = counted.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("most"))
    return counted.withColumn("a_id", a_id).join(most, "a_id").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of chunks, with the sums over their links."""
    for batch in batches:
        for i in range(batch.num_rows):
            at = lambda name: batch.column(name)[i]
            told = at("told").values
            n = len(at("pairs").values)
            count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if told is not None and len(told):
                where = told.field("place").to_numpy(zero_copy_only=False)
                count[where] = told.field("count").to_numpy(zero_copy_only=False)
                best[where] = told.field("best").to_numpy(zero_copy_only=False)
            place, held = (np.frombuffer(at(c).as_py(), np.int32) for c in ("places", "links"))
            first = at("first").values.to_numpy(zero_copy_only=False)
            total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[first])
            doc_ids = at("doc_ids").values
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids,
                    *[at(c).values for c in ("n_a", "n_b", "n_groups", "n_links")],
                    pa.array(total(best[place] * held), pa.int64()),
                    pa.array(total(count[place] * held), pa.int64()),
                    at("groups").values,
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
            )


def align(docs: DataFrame, a_path: str, b_path: str, digest: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each document.

    ``n_best``: links whose pair has the highest count of its A id; ``count_sum``: of the counts of all
    links; ``groups``: ids of each group, as ``a1,a2|b1;a3|b2,b3``, or with ``digest`` the SHA-256 of that.
    The tokenizer files are read on the driver.
    """
    with open(a_path, encoding="utf-8") as file:
        a_model = file.read()
    with open(b_path, "rb") as file:
        b_model = file.read()
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    chunks = stored(_chunks(base, a_model, b_model, digest), "token-chunks")
    counts = pair_counts(chunks)
    told = (
        chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
        .join(counts, "pair")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("place", "count", "best")).alias("told"))
    )
    resolved = chunks.join(told, "chunk", "left").drop("chunk", "documents")
    return resolved.mapInArrow(
        _resolved, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    )
