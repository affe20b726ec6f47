"""Near-duplicate documents by SetSketch registers, banding and exact verification.

A document's set holds its distinct shingles of ``shingle`` lower-cased words (all its words
as one shingle if it has fewer). Its sketch has ``BANDS * ROWS`` registers; register i is

    clip(floor(1 - log_b(least exponential variate of rate a over all elements)), 0, q + 1)

with an own hash per register: minima on an exponential scale, truncated to 16 bits. The
element-wise maximum of two sketches is the sketch of the union (``merged``), and registers of
two sets agree about as often as the sets overlap.

1. Documents with equal sets form a class; one of them stands for it.
2. Bands of ``ROWS`` registers are bucket keys. At similarity 0.8 a pair misses all 32 bands
   with probability (1 - 0.8**5)**32, about 3 in a million.
3. Each member of a bucket is paired with the bucket's hub only: the member whose buckets are
   largest, which is the one most alike to the others. Pairs whose joint maximum-likelihood
   estimate is far below the threshold are left out; the others are verified on full sets.
4. Linked documents form components. Members of one bucket that are not yet in one component
   are compared too: by a join in small buckets, and in large ones in blocks within tasks, which
   estimate and verify and let only links out. A pair inside a component can't change it and is
   never made, so large groups of copies give about one pair a member.
5. Components of all verified links.

Cases: null texts and texts without words have empty sets and are linked with nothing; a
document with a null id has no component and is kept; rows that share an id are one vertex;
ties need no rule, as links are symmetric and components have a smallest id; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.arrow_text import Powers, Words, gathered, mixed, range_hashes, slices
from broadsheet.llm.components import components
from broadsheet.llm.work import release, stored

BANDS, ROWS = 32, 5
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
MARGIN = 0.15  # an estimate so far below the threshold rules a pair out: almost five deviations
PAIRED = 32  # members of a bucket whose pairs are joined; larger buckets are compared in blocks
BLOCK_DOCS, BLOCK_SHINGLES = 512, 400_000  # of one side of a block

_SEEDS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed(_SEEDS) | np.uint64(1)
_SHINGLE = Powers(0xC2B2AE3D27D4EB4F)


def shingle_sets(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text in ascending order, and the texts' offsets."""
    values = words.hashes()
    count = words.counts()
    per_text = np.where(count >= shingle, count - shingle + 1, (count > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(per_text)))
    text = np.repeat(np.arange(len(count)), per_text)
    start = words.first[text] + np.arange(offsets[-1]) - offsets[text]
    hashes = range_hashes(values, start, np.minimum(start + shingle, words.first[text + 1]), _SHINGLE)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(count) + 1))


def registers(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sketch of each set, one row of 16-bit registers each; an empty set has zeros."""
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    least = np.full((len(sizes), BANDS * ROWS), np.iinfo(np.uint64).max, np.uint64)
    at = 0
    while at < len(full):  # pieces that stay in the processor's cache
        to = max(at + 1, int(np.searchsorted(offsets[full + 1], offsets[full[at]] + (1 << 14), "right")))
        some = full[at:to]
        own = hashes[offsets[some[0]] : offsets[some[-1] + 1]]
        starts = offsets[some] - offsets[some[0]]
        for i in range(BANDS * ROWS):
            value = (own ^ _SEEDS[i]) * _FACTORS[i]
            value ^= value >> np.uint64(32)
            least[some, i] = np.minimum.reduceat(value, starts)
        at = to
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    variate = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    scale = np.floor(1 - np.log(variate) / np.log(BASE))
    out = np.clip(scale, 0, TOP + 1).astype(np.uint16)
    out[sizes == 0] = 0
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sketched sets."""
    return np.maximum(a, b)


def _slope(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
    """Derivative of the registers' log-likelihood in the Jaccard similarity, row by row."""
    up, down = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - up - down
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    part = (BASE - 1) / BASE

    def slope(j: np.ndarray) -> np.ndarray:
        x, y = np.clip(u - v * j, 1e-12, 1), np.clip(v - u * j, 1e-12, 1)
        p, q = -np.log1p(-x * part) / np.log(BASE), -np.log1p(-y * part) / np.log(BASE)
        dp, dq = -v / np.log(BASE) * part / (1 - x * part), -u / np.log(BASE) * part / (1 - y * part)
        return up * dp / p + down * dq / q - same * (dp + dq) / np.maximum(1 - p - q, 1e-12)

    return slope, np.minimum(u / v, v / u)


def estimated(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketched sets of known sizes, row by row."""
    slope, high = _slope(a, b, n_a, n_b)
    low = np.zeros(len(high))
    for _ in range(24):  # the log-likelihood is concave: halve towards slope zero
        mid = (low + high) / 2
        rising = slope(mid) > 0
        low, high = np.where(rising, mid, low), np.where(rising, high, mid)
    return (low + high) / 2


def estimated_at_least(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """Whether the maximum-likelihood similarity reaches ``least``: there the slope still rises."""
    slope, most = _slope(a, b, n_a, n_b)
    return (most >= least) & (slope(np.minimum(least, most * (1 - 1e-9))) >= 0)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, set_1, set_2, registers) of documents (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, offsets = shingle_sets(Words(part.column("text"), lower=True), shingle)
                once = np.zeros(len(hashes) + 1, np.uint64)
                np.cumsum(mixed(hashes), dtype=np.uint64, out=once[1:])
                sums = mixed(once[offsets[1:]] - once[offsets[:-1]])
                chain = range_hashes(hashes, offsets[:-1], offsets[1:], _SHINGLE)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(offsets)),
                        pa.array(sums.view(np.int64)),
                        pa.array(chain.view(np.int64)),
                        pa.array([x.tobytes() for x in registers(hashes, offsets)], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_1", "set_2", "registers"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_1 long, set_2 long, registers binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BANDS * ROWS)


def band_keys(values: np.ndarray) -> np.ndarray:
    """The bucket key of each band (column) of each sketch (row)."""
    values = values.astype(np.uint64).reshape(len(values), BANDS, ROWS)
    key = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :].repeat(len(values), 0)
    for r in range(ROWS):
        key = mixed(key + values[:, :, r])
    return key.view(np.int64)


def _bands(sets: DataFrame) -> DataFrame:
    """A bucket key for each band of each set: (key, doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = band_keys(_matrix(batch.column("registers")))
            doc = np.repeat(np.arange(batch.num_rows), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel()), batch.column("doc_id").take(pa.array(doc))], ["key", "doc_id"]
            )

    return sets.select("doc_id", "registers").mapInArrow(run, "key long, doc_id long")


def _likely(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is at least ``least``."""
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("registers").alias(f"registers_{x}"), F.col("n_shingles").alias(f"n_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                size = lambda x: part.column(f"n_{x}").to_numpy().astype(np.float64)
                a, b = _matrix(part.column("registers_a")), _matrix(part.column("registers_b"))
                yield part.select(["a", "b"]).filter(pa.array(estimated_at_least(a, b, size("a"), size("b"), least)))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets meet the threshold."""

    def keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, offsets = shingle_sets(Words(column, lower=True), shingle)
        size = np.diff(offsets)
        row = np.repeat(np.arange(len(size)), size)
        return hashes, row, size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_b", 1 << 20):
                hash_a, row_a, size_a = keys(part.column("text_a"))
                hash_b, row_b, size_b = keys(part.column("text_b"))
                hashes, rows = np.concatenate((hash_a, hash_b)), np.concatenate((row_a, row_b))
                order = np.lexsort((hashes, rows))
                hashes, rows = hashes[order], rows[order]
                twice = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
                shared = np.bincount(rows[1:][twice], minlength=part.num_rows)
                linked = (shared > 0) & (100 * shared >= percent * (size_a + size_b - shared))
                yield part.select(["a", "b"]).filter(pa.array(linked))

    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long")


def _in_blocks(members: DataFrame, sets: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) inside large buckets, between members of different components.

    A bucket's members are dealt to parts; each pair of parts is compared in one task, and
    only links leave it. A pair that shares several bands is compared in the first of them.
    """
    parts = F.ceil(F.greatest(F.col("members") / BLOCK_DOCS, F.col("weight") / BLOCK_SHINGLES)).cast("int")
    dealt = members.select("key", "doc_id", "component", parts.alias("parts")).withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    )
    sides = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "key", "doc_id", "component", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    )
    full = sides.join(texts, "doc_id").join(sets.select("doc_id", "registers"), "doc_id")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        doc = group.column("doc_id").to_numpy()
        component = group.column("component").to_numpy()
        part = group.column("part").to_numpy()
        sketch = _matrix(group.column("registers"))
        hashes, offsets = shingle_sets(Words(group.column("text"), lower=True), shingle)
        size = np.diff(offsets).astype(np.float64)
        keys = band_keys(sketch)
        band = int(np.argmax(keys[0] == group.column("key")[0].as_py()))
        inside = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x in range(len(doc)):
            may = (component != component[x]) & (doc > doc[x])
            may &= 100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x])
            if not inside:
                may &= part != part[x]
            y = np.flatnonzero(may)
            y = y[~(keys[y, :band] == keys[x, :band]).any(1)]
            if not len(y):
                continue
            one = np.broadcast_to(sketch[x], (len(y), sketch.shape[1]))
            y = y[estimated_at_least(sketch[y], one, size[y], np.full(len(y), size[x]), percent / 100 - MARGIN)]
            if not len(y):
                continue
            own = hashes[offsets[x] : offsets[x + 1]]
            other = gathered(hashes, offsets[y], offsets[y + 1] - offsets[y])
            hit = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            shared = np.bincount(np.repeat(np.arange(len(y)), offsets[y + 1] - offsets[y]), hit, minlength=len(y))
            y = y[100 * shared >= percent * (size[y] + size[x] - shared)]
            out_a.append(np.full(len(y), doc[x]))
            out_b.append(doc[y])
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return full.groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each document."""
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    every = stored(sketches(base, shingle), "sketches")
    some = every.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("set_1", "set_2").agg(F.min("doc_id").alias("head"))
    sets = stored(
        some.select("doc_id", "n_shingles", "registers").join(
            classes.select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi"
        ),
        "sets",
    )
    bands = _bands(sets)
    buckets = bands.groupBy("key").agg(F.count("*").alias("members"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = stored(
        bands.join(buckets.where("low < high").select("key", "members"), "key").distinct(), "buckets"
    )
    # The hub of a bucket is the member whose buckets hold most documents.
    weight = shared.groupBy("doc_id").agg(F.sum("members").alias("weight"))
    ranked = shared.join(weight, "doc_id").select("key", "doc_id", F.struct("weight", -F.col("doc_id")).alias("rank"))
    hubs = ranked.groupBy("key").agg(F.max("rank").alias("hub")).select("key", (-F.col("hub.col2")).alias("hub"))
    ends = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    stars = shared.join(hubs, "key").where("doc_id <> hub").select(*ends("doc_id", "hub")).distinct()
    texts = stored(base.join(shared.select("doc_id").distinct(), "doc_id", "left_semi"), "texts")
    release(base.sparkSession)  # of the shuffled bands and texts
    least = percent / 100 - MARGIN
    links = stored(_verified(_likely(stars, sets, least), texts, shingle, percent), "links")
    release(base.sparkSession)  # of the shuffled sketches and texts
    label = components(links)
    # Pairs of one bucket that are still in different components.
    placed = shared.join(label.withColumnRenamed("vertex", "doc_id"), "doc_id", "left").join(
        sets.select("doc_id", "n_shingles"), "doc_id"
    ).select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"), F.col("n_shingles").alias("n"))
    placed = stored(placed, "placed")
    mixed_ = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"), F.sum("n").alias("weight")
    ).where("low < high")
    open_ = placed.join(mixed_.drop("low", "high"), "key")
    few = open_.where(F.col("members") <= PAIRED)
    left, right = few.alias("l"), few.alias("r")
    more = (
        left.join(
            right,
            (F.col("l.key") == F.col("r.key"))
            & (F.col("l.doc_id") < F.col("r.doc_id"))
            & (F.col("l.component") != F.col("r.component"))
            & (100 * F.least("l.n", "r.n") >= percent * F.greatest("l.n", "r.n")),
        )
        .select(F.col("l.doc_id").alias("a"), F.col("r.doc_id").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    again = _verified(_likely(more, sets, least), texts, shingle, percent)
    again = stored(
        again.unionByName(_in_blocks(open_.where(F.col("members") > PAIRED), sets, texts, shingle, percent)), "links"
    )
    if not again.isEmpty():
        label = components(links.union(again))
    heads = classes.join(label.withColumnRenamed("vertex", "head"), "head", "left").select(
        "set_1", "set_2", F.coalesce("component", "head").alias("component_id")
    )
    found = every.drop("registers").join(heads, ["set_1", "set_2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
