"""Language of each word and document by a linear-chain conditional random field.

A word's features are hashed prefixes and suffixes, byte n-grams with word ends, and whether
the word is in the lexicon of a language. With one learned weight per feature and language,
and one per pair of neighbouring languages, the probability of all word labels of a text is a
linear-chain CRF; forward-backward gives each word's label distribution. Training maximises
the likelihood of labelled sequences, half of them stitched from stretches of several texts so
that transitions are learned for code-switched text.

Fitting uses a bounded sample: at most ``DOCS_PER_LANGUAGE`` texts a language, of at most
``SAMPLE_BYTES`` bytes, chosen by hash of id. Everything else runs over whole texts.

Forward-backward over a long text: words are cut into blocks of ``BLOCK``; the transfer
matrices of all blocks are multiplied side by side, messages pass from block to block, and
then run inside all blocks side by side. The result is that of the plain recursion.

Cases: texts that are null or without a letter are ``und`` with score 0 and no spans; words
without letters carry no evidence; without any labelled row every text is ``und``; ties go to
the alphabetically first language; repeated rows repeat their results; an empty table gives
no rows; columns beside id and text are passed by untouched where they are named in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from broadsheet.llm.arrow_text import Words, gathered, mixed, slices

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 200
SAMPLE_BYTES = 20_000
FEATURES = 1 << 15
LEXICON = 300  # words of each language's lexicon
AFFIX = 3
GRAMS = (2, 3, 4)
SEQUENCE = 64
EPOCHS = 6
BLOCK = 32
FLOOR = -20.0  # least log-potential of a label beside the best one of a word

_U = np.uint64


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # features x labels
    lexicon: np.ndarray  # sorted word hashes
    member: np.ndarray  # lexicon x labels, 1 where the word is in the language's lexicon
    lexicon_weights: np.ndarray  # labels (lexicon of) x labels
    transitions: np.ndarray


def feature_groups(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (word, hashed feature), in groups, for words given as stretches of bytes."""
    lengths = ends - starts
    sizes = lengths + 2
    begin = np.cumsum(sizes) - sizes
    padded = np.zeros(int(sizes.sum()) + max(GRAMS), np.uint64)
    inner = np.repeat(begin + 1 - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    padded[inner] = gathered(data, starts, lengths)
    padded[begin] = 1
    padded[begin + sizes - 1] = 2
    total = int(sizes.sum())
    owner = np.repeat(np.arange(len(starts)), sizes)
    left = np.repeat(begin + sizes, sizes) - np.arange(total)  # bytes to the word's end
    groups = []
    for n in GRAMS:
        value = np.full(total, _U(n))
        for k in range(n):
            value = value * _U(263) + padded[k : k + total]
        fits = left >= n
        groups.append((owner[fits], _slot(value[fits])))
    for k in range(1, AFFIX + 1):
        long = np.flatnonzero(lengths >= k)
        for tag, first in ((16, begin[long] + 1), (32, begin[long] + 1 + lengths[long] - k)):
            value = np.full(len(long), _U(tag + k))
            for i in range(k):
                value = value * _U(263) + padded[first + i]
            groups.append((long, _slot(value)))
    return groups


def _slot(value: np.ndarray) -> np.ndarray:
    return (mixed(value) & _U(FEATURES - 1)).astype(np.int64)


def _in_lexicon(lexicon: np.ndarray, member: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.zeros((len(hashes), member.shape[1]))
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return member[at] * (lexicon[at] == hashes)[:, None]


def scores(model: Model, groups, hashes: np.ndarray) -> np.ndarray:
    """Log-potential of each word (row) and label."""
    return _values(model.weights, model.lexicon_weights, groups, _in_lexicon(model.lexicon, model.member, hashes))


def lettered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a word has an ASCII letter or a character beyond ASCII."""
    mark = (data >= 0x80) | ((data | 32) >= ord("a")) & ((data | 32) <= ord("z"))
    total = np.concatenate(([0], np.cumsum(mark)))
    return total[ends] > total[starts]


def fit(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """A model of labelled texts."""
    names = sorted(set(labels))
    count = len(names)
    number = {name: i for i, name in enumerate(names)}
    words = Words(pc.utf8_lower(pa.array(texts, pa.string())))
    kinds, first, index = np.unique(words.hashes(), return_index=True, return_inverse=True)
    index = index.ravel()
    text = np.repeat(np.arange(len(texts)), words.counts())
    gold = np.array([number[x] for x in labels], np.int64)[text]
    seen = np.stack([np.bincount(index[gold == i], minlength=len(kinds)) for i in range(count)], 1)
    common = np.zeros((len(kinds), count))
    for i in range(count):
        best = np.argsort(-seen[:, i], kind="stable")[:LEXICON]
        common[best[seen[best, i] > 1], i] = 1
    used = np.flatnonzero(common.any(1))
    model = Model(
        names, np.zeros((FEATURES, count)), kinds[used], common[used], np.zeros((count, count)), np.zeros((count, count))
    )
    if count < 2:
        return model
    groups = feature_groups(words.data, words.starts[first], words.ends[first])
    member = _in_lexicon(model.lexicon, model.member, kinds)
    rng = np.random.default_rng(seed)
    plain = index[: len(index) // SEQUENCE * SEQUENCE].reshape(-1, SEQUENCE), gold[: len(index) // SEQUENCE * SEQUENCE].reshape(-1, SEQUENCE)
    state = [np.full_like(p, 1e-8) for p in (model.weights, model.lexicon_weights, model.transitions)]
    for epoch in range(EPOCHS):
        # Stitched sequences: stretches of 4 to 24 words in random order.
        cut = np.concatenate(([0], np.cumsum(rng.integers(4, 25, len(index) // 4 + 1))))
        cut = np.append(cut[cut < len(index)], len(index))
        order = rng.permutation(len(cut) - 1)
        place = gathered(np.arange(len(index)), cut[order], np.diff(cut)[order])
        place = place[: len(place) // SEQUENCE * SEQUENCE].reshape(-1, SEQUENCE)
        every = np.concatenate((plain[0], index[place])), np.concatenate((plain[1], gold[place]))
        for some in np.array_split(rng.permutation(len(every[0])), max(1, len(every[0]) // 256)):
            if not len(some):
                continue
            word, label = every[0][some], every[1][some]
            values = _values(model.weights, model.lexicon_weights, groups, member)
            slope, turns = _slopes(values[word], label, model.transitions)
            by_word = np.stack([np.bincount(word.ravel(), slope[..., i].ravel(), minlength=len(kinds)) for i in range(count)], 1)
            step = np.zeros_like(model.weights)
            for i in range(count):
                column = np.ascontiguousarray(by_word[:, i])
                for owner, feature in groups:
                    step[:, i] += np.bincount(feature, column[owner], minlength=FEATURES)
            size = word.size
            for target, memory, change in zip(
                (model.weights, model.lexicon_weights, model.transitions), state, (step, member.T @ by_word, turns)
            ):
                change = change / size - 1e-6 * target
                memory += change**2
                target += 0.2 * change / np.sqrt(memory)
    return model


def _values(weights: np.ndarray, lexicon_weights: np.ndarray, groups, member: np.ndarray) -> np.ndarray:
    out = member @ lexicon_weights
    for label in range(out.shape[1]):
        column = np.ascontiguousarray(weights[:, label])
        for owner, feature in groups:
            out[:, label] += np.bincount(owner, column[feature], minlength=len(member))
    return out


def _slopes(values: np.ndarray, gold: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the log-likelihood in the words' scores and in the transitions."""
    rows, steps, count = values.shape
    psi = np.exp(np.maximum(values - values.max(2, keepdims=True), FLOOR))
    turn = np.exp(transitions - transitions.max())
    alpha, beta = np.empty_like(psi), np.empty_like(psi)
    alpha[:, 0] = psi[:, 0] / psi[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        step = (alpha[:, t - 1] @ turn) * psi[:, t]
        alpha[:, t] = step / step.sum(1, keepdims=True)
    beta[:, -1] = 1
    for t in range(steps - 1, 0, -1):
        step = (beta[:, t] * psi[:, t]) @ turn.T
        beta[:, t - 1] = step / step.sum(1, keepdims=True)
    chance = alpha * beta
    chance /= chance.sum(2, keepdims=True)
    pair = alpha[:, :-1, :, None] * turn * (psi[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    truth = np.eye(count)[gold]
    turns = np.einsum("bti,btj->ij", truth[:, :-1], truth[:, 1:]) - pair.sum((0, 1))
    return truth - chance, turns


def marginals(values: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label distribution of each word; ``first`` has the offsets of the texts' words."""
    total, count = values.shape
    if not total:
        return np.zeros((0, count))
    psi = np.exp(np.maximum(values - values.max(1, keepdims=True), FLOOR))
    turn = np.exp(transitions - transitions.max())
    sizes = np.diff(first)
    blocks = -(-sizes // BLOCK)
    begin = np.cumsum(blocks) - blocks  # first block of each text
    text = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(text)) - begin[text]
    at = first[text] + nth * BLOCK
    length = np.minimum(BLOCK, first[text + 1] - at)
    opens = nth == 0
    index = np.minimum(at[:, None] + np.arange(BLOCK), total - 1)
    inside = np.arange(BLOCK) < length[:, None]
    local = psi[index]
    unit = lambda x: x / x.max(-1, keepdims=True)
    matrix = np.repeat(np.eye(count)[None], len(text), 0)
    for t in range(BLOCK):
        step = (matrix.reshape(-1, count) @ turn).reshape(matrix.shape)
        if t == 0:
            step[opens] = matrix[opens]
        step = step * local[:, t, None, :]
        step /= step.max((1, 2), keepdims=True)
        matrix = np.where(inside[:, t, None, None], step, matrix)
    into = np.ones((len(text), count))  # message at a block's beginning
    out = np.ones((len(text), count))  # message at its end
    most = int(blocks.max(initial=0))
    order = np.argsort(-blocks, kind="stable")
    reach = np.searchsorted(-blocks[order], -np.arange(most + 1), "left")  # texts with more than k blocks
    for k in range(most - 1):
        some = begin[order[: reach[k + 1]]] + k
        into[some + 1] = unit(np.einsum("bi,bij->bj", into[some], matrix[some]))
    for k in range(most - 1, 0, -1):
        some = begin[order[: reach[k]]] + k
        out[some - 1] = unit(np.einsum("bij,bj->bi", matrix[some], out[some]))
    alpha = np.empty_like(local)
    state = into
    for t in range(BLOCK):
        step = state @ turn
        if t == 0:
            step[opens] = 1
        state = unit(step * local[:, t])
        alpha[:, t] = state
    state = out
    for t in range(BLOCK - 1, -1, -1):
        alpha[:, t] *= state
        state = np.where(inside[:, t, None], unit((state * local[:, t]) @ turn.T), state)
    alpha /= alpha.sum(2, keepdims=True)
    return alpha[inside]


def sample(docs: DataFrame, lang: str = "lang") -> tuple[list[str], list[str]]:
    """Texts and labels of the bounded training sample of (doc_id, text, lang).

    Of a text over ``SAMPLE_BYTES`` a stretch is learned from, at a place that a hash chooses.
    """
    fits = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id", "text")
    size = F.lit(SAMPLE_BYTES // 4)  # code points, of four bytes at most
    begin = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.greatest(F.lit(1), F.length("text") - size + 1)).cast("int") + 1
    stretch = F.substring("text", begin, size)
    rows = (
        fits.select("doc_id", "text", F.col(lang).alias("lang"))
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= DOCS_PER_LANGUAGE)
        .withColumn("text", F.when(F.octet_length("text") <= SAMPLE_BYTES, F.col("text")).otherwise(stretch))
        .orderBy("lang", "n")
        .collect()
    )
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def label(docs: DataFrame, model: Model | None, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and (lang_pred, score, confidence, spans) of each text.

    ``score``: the language's mean share of the words; ``confidence``: the mean of each word's likeliest
    language, which stays high where a text switches between languages; ``spans``: runs of words of
    one language.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    carried = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(f"`{text}`").alias("text"),
        F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("told"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                yield _labelled(part, shipped.value)

    kind = carried.schema["row"].dataType.simpleString()
    out = carried.mapInArrow(
        run, f"row {kind}, lang_pred string, score double, confidence double, spans array<struct<start: int, words: int, lang: string>>"
    )
    return out.select("row.*", "lang_pred", "score", "confidence", "spans")


def _labelled(part: pa.RecordBatch, model: Model | None) -> pa.RecordBatch:
    rows = part.num_rows
    told = part.column("told").to_numpy(zero_copy_only=False).astype(bool)
    span_kind = pa.struct([("start", pa.int32()), ("words", pa.int32()), ("lang", pa.string())])
    if model is None or not model.labels or not told.any():
        empty = pa.array([[]] * rows, pa.list_(span_kind))
        return pa.RecordBatch.from_arrays(
            [part.column("row"), pa.array([UNKNOWN] * rows), pa.array(np.zeros(rows)), pa.array(np.zeros(rows)), empty],
            ["row", "lang_pred", "score", "confidence", "spans"],
        )
    lowered = pc.utf8_lower(part.column("text"))
    words = Words(pc.if_else(part.column("told"), lowered, ""))
    hashes = words.hashes()
    kinds, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = words.starts[first], words.ends[first]
    letters = lettered(words.data, starts, ends)
    values = scores(model, feature_groups(words.data, starts, ends), kinds) * letters[:, None]
    index = index.ravel()
    chance = marginals(values[index], words.first, model.transitions)
    counted = letters[index]
    owner = np.repeat(np.arange(rows), words.counts())
    share = np.stack([np.bincount(owner, chance[:, i] * counted, minlength=rows) for i in range(chance.shape[1])], 1)
    share /= np.maximum(share.sum(1, keepdims=True), 1e-300)
    best = share.argmax(1)
    some = told & (np.bincount(owner, counted, minlength=rows) > 0)
    names = np.array(model.labels, object)
    pred = np.where(some, names[best], UNKNOWN)
    score = np.where(some, np.minimum(1.0, share[np.arange(rows), best]), 0.0)
    sure = np.bincount(owner, chance.max(1, initial=0) * counted, minlength=rows) / np.maximum(np.bincount(owner, counted, minlength=rows), 1)
    confidence = np.where(some, np.minimum(1.0, sure), 0.0)
    tag = chance.argmax(1)
    new = np.ones(len(tag), bool)
    new[1:] = (tag[1:] != tag[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner[at], np.arange(rows + 1)), pa.int32()),
        pa.StructArray.from_arrays(
            [
                pa.array((at - words.first[owner[at]]).astype(np.int32)),
                pa.array(np.diff(np.append(at, len(tag))).astype(np.int32)),
                pa.array(names[tag[at]], pa.string()),
            ],
            ["start", "words", "lang"],
        ),
    )
    return pa.RecordBatch.from_arrays(
        [part.column("row"), pa.array(pred, pa.string()), pa.array(score), pa.array(confidence), spans],
        ["row", "lang_pred", "score", "confidence", "spans"],
    )


def identify(docs: DataFrame, training: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Fit on the labelled rows of ``training`` (doc_id, text, lang) and label ``docs``."""
    texts, labels = sample(training)
    return label(docs, fit(texts, labels) if texts else None, keep)
