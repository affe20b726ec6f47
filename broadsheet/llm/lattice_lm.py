"""Log-probability of texts by a subword lattice over a unigram vocabulary.

Tokens are words (A-Z lower-cased) and one end per text. A word of the training texts is an arc
over the whole word, weighted by its count; besides, all segmentations of the word into pieces
of an existing subword vocabulary are paths of the lattice. The word's probability is the sum
over all paths, by forward recursion in log space:

    P(word) = (c - D) / N  +  D * V / N * (1 - s) / s * sum over segmentations of prod(s' * p(piece))

with absolute discounting D, c = 0 for unknown words, and a geometric number of pieces
(a piece goes on with probability s' = 1 - s, and ends the word with s). Piece probabilities
start from the vocabulary's own scores and are refitted to all distinct training words by
expectation maximisation, with the vocabulary's scores as prior.

How it runs: texts are tokenized once into chunks, each with its distinct words and every
text's words as numbers into them. The distinct words of chunks (not the words of texts) are
counted, scored once each, and sent back to their chunks. Tables between the steps lie in the
shared folder.

Cases: null and empty texts are the end alone; without training texts every count is zero and
only the lattice speaks; rows that repeat are scored (and, in training, counted) each; a null
id is carried along; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.llm.arrow_text import Powers, Words, bounds, gathered, mixed, slices
from broadsheet.llm.work import stored

CHUNK_BYTES = 8 << 20
DISCOUNT = 0.5
ROUNDS = 2  # of expectation maximisation
PRIOR = 1000.0  # weight of the vocabulary's scores, in pieces
BATCH_WORDS = 1 << 14
FILTER_BITS = 20
SPACE = "▁"  # fixed value: the vocabulary's mark for the beginning of a word

_U = np.uint64
_PIECE = Powers(0x9FB21C651E98DF25)


@dataclass
class Pieces:
    """Piece hashes in order, their lengths in bytes, log-probabilities, and the stop chance."""

    hashes: np.ndarray
    lengths: np.ndarray
    prior: np.ndarray
    log_p: np.ndarray
    stop: float

    def __post_init__(self):
        self.bits = np.zeros(1 << FILTER_BITS, bool)  # which leading bits a piece's hash can have
        self.bits[self.hashes >> _U(64 - FILTER_BITS)] = True


def read_pieces(path: str) -> Pieces:
    """The vocabulary of a sentencepiece model; ranks stand for scores where these are ranks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    score: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.encode()
        if raw and (raw not in score or not model.is_byte(i)):
            score[raw] = float("nan") if model.is_byte(i) else model.get_score(i)
    for value in range(256):
        score.setdefault(bytes([value]), float("nan"))
    raw = list(score)
    values = np.array([score[x] for x in raw])
    told = ~np.isnan(values)
    if np.array_equal(values[told], np.round(values[told])):  # merge ranks, not logarithms
        values[told] = -np.log(10 - values[told])
    values[~told] = values[told].min() - np.log(10)
    hashes = np.array([_hash(x) for x in raw], np.uint64)
    order = np.argsort(hashes)
    prior = np.exp(values[order] - values.max())
    prior /= prior.sum()
    return Pieces(hashes[order], np.array([len(x) for x in raw])[order], prior, np.log(prior), 0.4)


def _hash(raw: bytes) -> int:
    up, _ = _PIECE.upto(len(raw) + 1)
    return int(mixed(np.sum((np.frombuffer(raw, np.uint8).astype(np.uint64) + _U(1)) * up[: len(raw)], keepdims=True))[0])


def _arcs(pieces: Pieces, rows: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For words of one length (rows of bytes): by piece length, the piece at each place or -1."""
    count, length = rows.shape
    up, down = _PIECE.upto(length + 1)
    sums = np.zeros((count, length + 1), np.uint64)
    np.cumsum((rows.astype(np.uint64) + _U(1)) * up[:length], axis=1, dtype=np.uint64, out=sums[:, 1:])
    out = {}
    for size in np.unique(pieces.lengths[pieces.lengths <= length]).tolist():
        value = mixed((sums[:, size:] - sums[:, : length + 1 - size]) * down[: length + 1 - size])
        maybe = np.flatnonzero(pieces.bits[(value >> _U(64 - FILTER_BITS)).ravel()])
        value = value.ravel()[maybe]
        at = np.minimum(np.searchsorted(pieces.hashes, value), len(pieces.hashes) - 1)
        hit = (pieces.hashes[at] == value) & (pieces.lengths[at] == size)
        if hit.any():
            found = np.full(count * (length + 1 - size), -1, np.int32)
            found[maybe[hit]] = at[hit]
            out[size] = found.reshape(count, length + 1 - size)
    return out


def _sum(terms: list[np.ndarray]) -> np.ndarray:
    most = np.maximum.reduce(terms)
    safe = np.where(np.isfinite(most), most, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(sum(np.exp(x - safe) for x in terms))


def _forward(pieces: Pieces, rows: np.ndarray, expect: np.ndarray | None = None) -> np.ndarray:
    """Natural log of the lattice's marginal of each word; adds expected piece counts to ``expect``."""
    count, length = rows.shape
    arcs = _arcs(pieces, rows)
    go = np.log1p(-pieces.stop)
    log_p = np.append(pieces.log_p + go, -np.inf)  # -1: no piece
    alpha = np.full((length + 1, count), -np.inf)
    alpha[0] = 0
    weight = {size: log_p[at].T for size, at in arcs.items()}
    for t in range(1, length + 1):
        terms = [alpha[t - size] + weight[size][t - size] for size in arcs if size <= t]
        if terms:
            alpha[t] = _sum(terms)
    if expect is not None:
        beta = np.full((length + 1, count), -np.inf)
        beta[length] = 0
        for t in range(length - 1, -1, -1):
            terms = [weight[size][t] + beta[t + size] for size in arcs if t + size <= length]
            if terms:
                beta[t] = _sum(terms)
        for size, at in arcs.items():
            share = np.exp(alpha[: length + 1 - size] + weight[size] + beta[size:] - alpha[length])
            known = at.T >= 0
            expect += np.bincount(at.T[known], share[known], minlength=len(expect))
    return alpha[length] - go + np.log(pieces.stop)


def word_log_p(pieces: Pieces, words: pa.Array, expect: np.ndarray | None = None) -> np.ndarray:
    """Natural log of each word's lattice marginal, with the mark of a word's beginning before it."""
    data, offsets = bounds(words)
    mark = np.frombuffer(SPACE.encode(), np.uint8)
    sizes = np.diff(offsets)
    out = np.zeros(len(sizes))
    for size in np.unique(sizes).tolist():
        which = np.flatnonzero(sizes == size)
        step = max(1, BATCH_WORDS * 8 // (size + 1))
        for low in range(0, len(which), step):
            some = which[low : low + step]
            rows = np.empty((len(some), size + len(mark)), np.uint8)
            rows[:, : len(mark)] = mark
            rows[:, len(mark) :] = gathered(data, offsets[some], sizes[some]).reshape(len(some), size)
            out[some] = _forward(pieces, rows, expect)
    return out


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as their low 16 bits and then their high 16 bits, most of which are zeros."""
    return (numbers & 0xFFFF).astype(np.uint16).tobytes() + (numbers >> 16).astype(np.uint16).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    both = np.frombuffer(raw, np.uint16).reshape(2, -1).astype(np.int64)
    return both[0] | both[1] << 16


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``CHUNK_BYTES`` of text each."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            held.append(part)
            size += len(bounds(part.column("text"))[0])
            if size >= CHUNK_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if size or held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from table.to_batches()


def chunks(docs: DataFrame) -> DataFrame:
    """Chunks of documents (doc_id, held_out, text) with their distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _joined(batches):
            if part.num_rows:
                words = Words(part.column("text"), lower=True)
                _, first, index, total = np.unique(
                    words.hashes(), return_index=True, return_inverse=True, return_counts=True
                )
                order = np.argsort(-total, kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                token = place[index.ravel()]
                held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                learned = np.repeat(~held, words.counts())
                train = np.bincount(token[learned], minlength=len(order))
                first = first[order]
                sizes = words.ends[first] - words.starts[first]
                text = pa.Array.from_buffers(
                    pa.large_string(),
                    len(first),
                    [
                        None,
                        pa.py_buffer(np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)),
                        pa.py_buffer(gathered(words.data, words.starts[first], sizes)),
                    ],
                ).cast(pa.string())
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int.from_bytes(os.urandom(8), "big") >> 1]),
                        one(part.column("doc_id")),
                        one(part.column("held_out")),
                        one(pa.array(words.counts().astype(np.int32))),
                        pa.array([_packed(token)], pa.binary()),
                        one(text),
                        one(pa.array(train.astype(np.int64))),
                    ],
                    ["chunk", "doc_id", "held_out", "sizes", "tokens", "words", "train"],
                )

    return docs.mapInArrow(
        run,
        "chunk long, doc_id array<long>, held_out array<boolean>, sizes array<int>, tokens binary, "
        "words array<string>, train array<long>",
    )


def fitted(pieces: Pieces, words: DataFrame) -> Pieces:
    """Piece probabilities and stop chance refitted to distinct words (word)."""
    for _ in range(ROUNDS):
        shipped = words.sparkSession.sparkContext.broadcast(pieces)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, expect, seen = shipped.value, np.zeros(len(shipped.value.hashes)), 0
            for batch in batches:
                word_log_p(own, batch.column("word"), expect)
                seen += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, len(expect))), pa.array(np.append(float(seen), expect))], ["piece", "n"]
            )

        # As many rows as the vocabulary has pieces.
        told = words.select("word").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        expect, seen = np.zeros(len(pieces.hashes)), 0.0
        for row in told:
            if row["piece"] < 0:
                seen = row["n"]
            else:
                expect[row["piece"]] = row["n"]
        p = (expect + PRIOR * pieces.prior) / (expect.sum() + PRIOR)
        stop = (seen + 0.4 * PRIOR) / (expect.sum() + PRIOR)
        pieces = Pieces(pieces.hashes, pieces.lengths, pieces.prior, np.log(p), float(min(max(stop, 0.01), 0.99)))
    return pieces


def score(docs: DataFrame, vocabulary: str, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each document.

    Documents with ``held_out`` are not learned from.
    """
    base = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(f"`{text}`").alias("text"),
    )
    held = stored(chunks(base), "chunks")
    entries = held.select("chunk", F.posexplode(F.arrays_zip("words", "train")).alias("place", "own")).select(
        F.col("chunk").alias("of"), "place", F.col("own.words").alias("word"), F.col("own.train").alias("train")
    )
    counts = stored(entries.groupBy("word").agg(F.sum("train").alias("c")), "counts")
    seen = counts.where("c > 0")
    total, kinds = seen.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = held.agg(F.coalesce(F.sum(F.size(F.filter("held_out", lambda x: ~x))), F.lit(0)).cast("long")).first()[0]
    tokens, kinds = total + ends, kinds + (1 if ends else 0)
    pieces = docs.sparkSession.sparkContext.broadcast(fitted(read_pieces(vocabulary), seen))
    left = DISCOUNT * kinds / tokens if tokens else 1.0

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column("c").to_numpy().astype(np.float64)
            lattice = word_log_p(pieces.value, batch.column("word"))
            with np.errstate(divide="ignore"):
                whole = np.log(np.maximum(c - DISCOUNT, 0) / max(tokens, 1))
            log10 = np.logaddexp(whole, lattice + np.log(left)) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(log10)], ["word", "c", "p"])

    weighed = counts.mapInArrow(weigh, "word string, c long, p double")
    back = entries.select("of", "place", "word").join(weighed, "word").select("of", "place", "c", "p")
    whole = tokens + 0.5 * (kinds + 1)
    end = np.log10(max(ends - DISCOUNT, 0) / tokens) if ends else np.log10(left)
    end_base = np.log10((ends + 0.5) / whole)

    def total_of(texts: pa.Table, found: pa.Table) -> pa.Table:
        n = found.num_rows
        place = found.column("place").to_numpy()
        c, p = np.zeros(n), np.zeros(n)
        c[place], p[place] = found.column("c").to_numpy(), found.column("p").to_numpy()
        base = np.log10((c + 0.5) / whole)
        parts = []
        for row in range(texts.num_rows):
            own = lambda name: texts.column(name)[row].values
            sizes = own("sizes").to_numpy()
            token = _unpacked(texts.column("tokens")[row].as_py())
            text = np.repeat(np.arange(len(sizes)), sizes)
            sums = lambda values: np.bincount(text, values[token], minlength=len(sizes))
            parts.append(
                pa.table(
                    {
                        "doc_id": own("doc_id"),
                        "held_out": own("held_out"),
                        "n_tokens": pa.array(sizes.astype(np.int64) + 1),
                        "n_known": pa.array(sums((c > 0).astype(np.float64)).astype(np.int64) + (ends > 0)),
                        "train_tokens": pa.array(np.full(len(sizes), tokens, np.int64)),
                        "base_score": pa.array(sums(base) + end_base),
                        "score": pa.array(sums(p) + end),
                    }
                )
            )
        return pa.concat_tables(parts)

    return (
        held.drop("words", "train")
        .groupBy("chunk")
        .cogroup(back.groupBy("of"))
        .applyInArrow(
            total_of,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )
