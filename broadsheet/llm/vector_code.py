"""Vector codes: parts of vectors are replaced by their nearest codebook entries, found in a GNAT.

Vectors are integers: floor(4096 * x) of each component. They are cut into ``PARTS`` equal
parts, each with a codebook of at most ``ENTRIES`` entries, which begins as that part of the
rows with the smallest ids. A round assigns every part to its nearest entry (squared
distance, ties to the smaller index) and replaces each entry by the floor of its parts' mean;
unused entries stay. Distances and means are exact integers.

A codebook is searched through a geometric near-neighbour access tree: a node holds a few
split points, chosen far from each other, and the other entries as children of their nearest
split point. For each split point and each child the node stores the range of distances
between them. The distances of a query to the split points bound, by the triangle inequality,
its distance to all of a child, which is left out only if the bound lies strictly above the best
distance so far. Bounds are widened by more than rounding can make; which entry is nearest is
decided by integers alone, so ties are kept.

Tasks add up their parts by entry and return one row per entry and place, so a round shuffles
and collects as many numbers as the codebooks hold, whatever the number of rows.

Cases: vectors that are null, empty or hold a null or non-finite component are dropped; vectors
are padded with zeros to the longest one, rounded up to whole parts; rows without an id are coded
and come last in the order of ids; rows that repeat an id are rows of their own, in the order of
their vectors; fewer rows than entries make smaller codebooks; an empty table gives no rows;
components beyond 64 bits are cut to their ends, as are errors; null labels are one label; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.topk_search import quantized, usable
from broadsheet.llm.work import stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
SPLITS = 4  # split points of a node
LEAF = 3  # entries that are compared without a node
SLACK = 1e-9  # widening of bounds, relative to the distances; rounding makes less than 1e-14
HOT = 1000  # a label with more than a HOT-th of the rows is hot: there are fewer than HOT
INT64 = (1 << 63) - 1

Book = list[list[int]]  # entries of one part


@dataclass
class Node:
    """Split points, their children and ``near[i][j] <= distance(split i, entry of child j) <= far[i][j]``."""

    splits: list[int]
    children: list["Node"] = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    apart = points - entry
    return (apart * apart).sum(1)


def _distance(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


def gnat(book: np.ndarray, places: Sequence[int] | None = None) -> Node:
    """The tree over the entries (rows of ``book``) at ``places``."""
    places = list(range(len(book))) if places is None else list(places)
    if len(places) <= LEAF:
        return Node(places)
    splits = [places[0]]
    apart = squared(book[places], book[splits[0]])
    while len(splits) < SPLITS:
        splits.append(places[int(np.argmax(apart))] if apart.max() > 0 else next(p for p in places if p not in splits))
        apart = np.minimum(apart, squared(book[places], book[splits[-1]]))
        apart[[places.index(s) for s in splits]] = -1
    rest = [p for p in places if p not in splits]
    square = np.array([squared(book[rest], book[s]) for s in splits])
    owner = square.argmin(0)
    groups = [np.flatnonzero(owner == j) for j in range(len(splits)) if (owner == j).any()]
    distance = _distance(square)
    return Node(
        splits,
        [gnat(book, [rest[i] for i in group]) for group in groups],
        np.array([[distance[i][group].min() for group in groups] for i in range(len(splits))]),
        np.array([[distance[i][group].max() for group in groups] for i in range(len(splits))]),
    )


class Search:
    """Nearest entries of many points; ``counted`` distances were taken."""

    def __init__(self, book: np.ndarray):
        self.book, self.root, self.counted = book, gnat(book), 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row."""
        entry = np.full(len(points), -1, np.int64)
        best = np.zeros(len(points), points.dtype)
        self._visit(self.root, points, np.arange(len(points)), entry, best)
        return entry, best

    def _visit(self, node: Node, points: np.ndarray, rows: np.ndarray, entry: np.ndarray, best: np.ndarray) -> None:
        if not len(rows):
            return
        here = points[rows]
        distances = []
        for place in node.splits:
            square = squared(here, self.book[place])
            self.counted += len(rows)
            nearer = (entry[rows] < 0) | (square < best[rows]) | ((square == best[rows]) & (place < entry[rows]))
            entry[rows[nearer]], best[rows[nearer]] = place, square[nearer]
            distances.append(_distance(square))
        for j, child in enumerate(node.children):
            bound = np.full(len(rows), -np.inf)
            for i, distance in enumerate(distances):
                near, far = node.near[i, j], node.far[i, j]
                slack = SLACK * (1 + distance + far)
                bound = np.maximum(bound, np.maximum(near - distance, distance - far) - slack)
            may = bound <= _distance(best[rows]) * (1 + SLACK)
            self._visit(child, points, rows[may], entry, best)


def _matrix(lists: pa.Array, width: int, wide: bool) -> np.ndarray:
    """Rows of a list column, padded with zeros; exact integers of any size if ``wide``."""
    sizes = np.array(lists.value_lengths(), np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    return out.astype(object) if wide else out


def _assigned(books: list[Book], width: int, wide: bool, lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, points, entry, squared distance) of a batch."""
    points = _matrix(lists, width, wide)
    step = width // len(books)
    for part, book in enumerate(books):
        here = points[:, part * step : (part + 1) * step]
        entry, square = Search(np.array(book, object if wide else np.int64).reshape(len(book), step)).nearest(here)
        yield part, here, entry, square


def _next_books(rows: DataFrame, books: list[Book], width: int, wide: bool) -> list[Book]:
    """The codebooks with each entry moved to the floor of its parts' mean."""
    step = width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(books), ENTRIES, step), object)
        count = np.zeros((len(books), ENTRIES), np.int64)
        for batch in batches:
            for part, points, entry, _ in _assigned(books, width, wide, batch.column("v")):
                for e in np.unique(entry).tolist():
                    mine = points[entry == e]
                    count[part, e] += len(mine)
                    # In halves of 32 bits, so that sums stay exact.
                    total[part, e] += sum((((mine >> s) & 0xFFFFFFFF if s == 0 else mine >> s).sum(0).astype(object) << s) for s in (0, 32))
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(entry.astype(np.int32)),
                pa.array(count[part, entry]),
                pa.array([[int(x) for x in total[p, e]] for p, e in zip(part, entry)], pa.list_(pa.decimal128(38, 0))),
            ],
            ["part", "entry", "n", "total"],
        )

    sums = (
        rows.select("v")
        .mapInArrow(run, "part int, entry int, n long, total array<decimal(38,0)>")
        .select("part", "entry", "n", F.posexplode("total").alias("place", "total"))
        .groupBy("part", "entry", "place")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    out = [[list(entry) for entry in book] for book in books]
    for r in sums.collect():  # as many rows as the codebooks have numbers
        out[r["part"]][r["entry"]][r["place"]] = int(r["total"]) // r["n"]
    return out


def with_label_sum(rows: DataFrame, label: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over rows of an equal label; nulls are one label.

    Labels with more than a ``HOT``-th of the rows are fewer than ``HOT`` and are sent to all tasks,
    so no task gets more rows of one label than that.
    """
    sums = rows.groupBy(F.col(label).alias("__label")).agg(
        F.least(F.sum(F.col(value).cast("decimal(38,0)")), F.lit(INT64).cast("decimal(38,0)")).cast("long").alias(name),
        F.count("*").alias("__n"),
    )
    sums = stored(sums, "label-sums")
    limit = rows.count() / HOT
    is_hot = F.col("__n") > limit
    hot, cold = sums.where(is_hot).drop("__n"), sums.where(~is_hot).drop("__n")
    same = F.col(label).eqNullSafe(F.col("__label"))
    one = rows.join(F.broadcast(hot), same).drop("__label")
    rest = rows.join(F.broadcast(hot.select("__label")), same, "left_anti")
    return one.unionByName(rest.join(cold, same).drop("__label"))


def codebooks(rows: DataFrame, width: int, wide: bool, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> list[Book]:
    """The codebook of each part after ``rounds``. ``rows``: (vec_id, v), v at most ``width`` long."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    step = width // parts
    full = [list(r["v"]) + [0] * (width - len(r["v"])) for r in first]
    books = [[v[p * step : (p + 1) * step] for v in full] for p in range(parts)]
    for _ in range(rounds):
        books = _next_books(rows, books, width, wide)
    return books


def fingerprint(books: list[Book]) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def encode(vectors: DataFrame, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE,
           vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of each usable vector.

    ``code``: array<int>, an entry's index for each part; ``error``: squared distance to the entries.
    """
    named = lambda c: F.col(f"`{c}`")
    rows = stored(
        vectors.where(usable(named(vector))).select(
            named(vec_id).cast("long").alias("vec_id"), named(label).alias("label"), quantized(named(vector), scale).alias("v")
        ),
        "vectors",
    )
    least, most = F.min(F.array_min("v")), F.max(F.array_max("v"))
    size, low, high = rows.agg(F.max(F.size("v")), least, most).first()
    width = -(-(size or 1) // parts) * parts
    reach = max(-(low or 0), high or 0)
    wide = width // parts * (2 * reach + 2) ** 2 > INT64
    books = codebooks(rows, width, wide, rounds, parts) if size else [[] for _ in range(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_assigned(books, width, wide, batch.column("v")))
            code = np.stack([entry for _, _, entry, _ in found], 1).astype(np.int32)
            error = sum(square.astype(object) for _, _, _, square in found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.FixedSizeListArray.from_arrays(pa.array(code.ravel()), len(books)).cast(pa.list_(pa.int32())),
                    pa.array([min(int(x), INT64) for x in error], pa.int64()),
                ],
                ["vec_id", "label", "code", "error"],
            )

    kind = rows.schema["label"].dataType.simpleString()
    told = stored(rows.mapInArrow(run, f"vec_id long, label {kind}, code array<int>, error long"), "codes")
    return with_label_sum(told, "label", "error", "label_error").withColumn("codebooks_sha256", F.lit(fingerprint(books)))


def hexed(code) -> "F.Column":
    """Two hexadecimal digits for each index."""
    return F.array_join(F.transform(code, lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
