"""Document fingerprints by one-permutation MinHash, with built-in functions only.

Shingles of ``SHINGLE`` words are hashed once to 64 bits. The leading bits choose one of
``BINS`` bins, of which each keeps its least hash. An empty bin takes the value of another,
full bin: the one that comes first in a random order of all bins that belongs to the empty bin
(optimal densification). Of each value the low ``BITS`` bits are stored, sixteen values to a
long. Two fingerprints agree at a place with probability J + (1 - J) / 2**BITS, which
``likeness`` inverts.

Cases: a null text is an empty one; a text without words has the empty fingerprint, which is
like another empty one (1) and unlike the rest (0); a text under ``SHINGLE`` words is one
shingle; equal texts have equal fingerprints; repeated ids are ordered by text; a null id comes
after all others; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions.shape import let

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 4
PER_LONG = 64 // BITS
NEIGHBOURS = 8192  # documents of a bucket within which neighbours are found

_SHIFT = 64 - BIN_BITS
_REST = (1 << _SHIFT) - 1
_NIBBLE = (1 << BITS) - 1


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _bin(value: Column) -> Column:
    return F.shiftright(value, _SHIFT)


def shingles(text: Column) -> Column:
    """Hashes of the text's shingles; empty without words."""

    def of_words(words: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(words) - SHINGLE),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]),
        )
        one = F.array(F.xxhash64(F.array_join(words, " ")))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(words) >= SHINGLE, each).when(F.size(words) > 0, one).otherwise(none)

    return let(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""), of_words)


def fingerprint(text: Column) -> Column:
    """The packed fingerprint (array<long>) of a text; an empty array without words."""
    # One mark per bin, larger than any hash of the bin: where it is the least, the bin is empty.
    marks = F.array(*[F.lit(_signed(((b << _SHIFT) | _REST))) for b in range(BINS)])
    full = lambda x: x.bitwiseAND(F.lit(_REST)) != F.lit(_REST)

    def of_bins(least: Column) -> Column:
        # The first full bin in the empty bin's order of all bins. Its value is hashed with the empty
        # bin's number, so that many copies of one value don't agree or differ all at once.
        def from_another(b: Column, donors: Column) -> Column:
            order = F.transform(
                donors, lambda x, i: F.xxhash64(b, _bin(x)).bitwiseAND(F.lit(~(BINS - 1))).bitwiseOR(i.cast("bigint"))
            )
            chosen = F.get(donors, F.array_min(order).bitwiseAND(F.lit(BINS - 1)).cast("int"))
            return F.xxhash64(b, chosen).bitwiseAND(F.lit(_NIBBLE))

        low = let(
            F.filter(least, full),
            lambda donors: F.transform(
                least,
                lambda x: F.when(full(x), x.bitwiseAND(F.lit(_NIBBLE))).otherwise(from_another(_bin(x), donors)),
            ),
        )
        return let(low, packed)

    def packed(low: Column) -> Column:
        def one(k: int) -> Column:
            out = F.get(low, k * PER_LONG)
            for j in range(1, PER_LONG):
                out = out.bitwiseOR(F.shiftleft(F.get(low, k * PER_LONG + j), BITS * j))
            return out

        return F.array(*[one(k) for k in range(BINS // PER_LONG)])

    def of_hashes(hashes: Column) -> Column:
        in_order = F.sort_array(F.concat(hashes, marks))
        least = let(in_order, lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))
        return F.when(F.size(hashes) > 0, let(least, of_bins)).otherwise(F.array().cast("array<bigint>"))

    return let(shingles(text), of_hashes)


def hexed(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Similarity estimated from two packed fingerprints, corrected for chance agreement."""
    ones = _signed(sum(1 << (BITS * j) for j in range(PER_LONG)))

    def unlike(x: Column, y: Column) -> Column:
        def marked(z: Column) -> Column:
            for shift in (1, 2):  # any differing bit of a value marks its lowest bit
                z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
            return z.bitwiseAND(F.lit(ones))

        return F.bit_count(marked(x.bitwiseXOR(y)))

    differ = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << BITS)
    agree = 1.0 - differ / F.lit(float(BINS))
    value = F.greatest(F.lit(0.0), (agree - chance) / (1.0 - chance))
    empty = (F.size(a) == 0).cast("int") + (F.size(b) == 0).cast("int")
    return F.when(empty == 2, 1.0).when(empty == 1, 0.0).otherwise(value)


def _bucketed(docs: DataFrame) -> DataFrame:
    """``docs`` with a bucket number that grows with the id: quantiles, and equal widths within.

    The quantiles are at most 256 numbers.
    """
    rows, low, high = docs.agg(F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    if not rows:
        return docs.withColumn("bucket", F.lit(-1).cast("long"))
    parts = max(1, min(256, rows // NEIGHBOURS))
    inner = max(1, rows // NEIGHBOURS // parts)
    marks = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 100_000)).first()[0]
    edges = sorted({low, *[m for m in marks if low < m]}) + [high + 1]
    edge = F.array(*[F.lit(e).cast("long") for e in edges])
    coarse = F.size(F.filter(edge, lambda e: e <= F.col("doc_id"))) - 1
    number = let(
        coarse,
        lambda c: c.cast("long") * inner
        + F.floor(
            (F.col("doc_id") - F.get(edge, c)).cast("double") * inner / (F.get(edge, c + 1) - F.get(edge, c)).cast("double")
        ),
    )
    return docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(number).cast("long"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, print) with the text and print of the next document by descending id.

    The last document is followed by the first. A document's successor is in its bucket, or
    begins the next bucket that has documents; only the beginnings of buckets move between them.
    """
    placed = _bucketed(docs)
    head = placed.groupBy("bucket").agg(F.max(F.struct("doc_id", "text")).alias("head"))
    numbers = placed.select("bucket").distinct()
    downward = Window.orderBy(F.col("bucket").desc())  # over bucket numbers only
    follows = numbers.select(
        "bucket",
        F.coalesce(
            F.lead("bucket").over(downward), F.max("bucket").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        ).alias("next_bucket"),
    )
    heads = follows.join(
        head.select(F.col("bucket").alias("next_bucket"), F.col("head.text").alias("head_text")), "next_bucket"
    ).select("bucket", "head_text", fingerprint(F.col("head_text")).alias("head_print"))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    near = placed.withColumn("print", fingerprint(F.col("text"))).select(
        "*", F.lead(F.struct("text", "print")).over(order).alias("next")
    )
    return near.join(heads, "bucket", "left").select(
        "doc_id",
        "text",
        "print",
        F.when(F.col("next").isNull(), F.col("head_text")).otherwise(F.col("next.text")).alias("next_text"),
        F.when(F.col("next").isNull(), F.col("head_print")).otherwise(F.col("next.print")).alias("next_print"),
    )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, packed fingerprint) of each document."""
    return docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).withColumn("print", fingerprint(F.col("text")))


def edited_halves(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside its text with the second half taken from the next document.

    (doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next)
    """
    base = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    pairs = with_next(base).withColumn("n", F.length("text"))
    half = F.floor(F.col("n") / 2).cast("int")
    edited = pairs.withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.col("n") - half), F.substring("next_text", F.lit(1), half))
    ).withColumn("edited_print", fingerprint(F.col("edited")))
    return edited.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        "edited",
        hexed(F.col("print")).alias("fingerprint"),
        hexed(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
