from __future__ import annotations

import random

import pyarrow as pa
import pytest

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from broadsheet.llm import bpe  # noqa: E402
from broadsheet.llm.queries import op8_bpe_round_trip  # noqa: E402
from tests.test_registered import DATA  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(bpe.read_ranks(PATH))


def encoded(merges, texts):
    ids, offsets = merges.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_odd_texts_as_the_library_does(merges, library):
    texts = ["", None, "it's we'll 're x''s  'S  ' s", "  \n\n a", "a" * 3000, " " * 300, "\n'd", "日本 12３½²", "🙂 x　 y",
             "\x1c\x85b", "ab" * 500 + "!!?" * 50, "don't've'", "<|endoftext|>", "x" * 65 + "'ll"]
    assert encoded(merges, texts) == [library.encode_ordinary(t or "") for t in texts]


def test_random_texts_as_the_library_does(merges, library):
    draw = random.Random(3)
    texts = ["".join(draw.choices(list(" \n\t'slltrevdmAB12é½!?. 日🙂"), k=draw.randint(0, 60))) for _ in range(2000)]
    assert encoded(merges, texts) == [library.encode_ordinary(t) for t in texts]


def test_one_tree_for_long_and_many_trees_for_short_pieces_agree(merges):
    draw = random.Random(4)
    pieces = ["".join(draw.choices("theraion", k=n)).encode() for n in (2, 3, 7, 16, 33, 64)]
    import numpy as np

    for piece in pieces:
        width = 1 << (len(piece) - 1).bit_length()
        rows = np.frombuffer(piece.ljust(width, b"\0"), np.uint8)[None]
        ids, live = merges.lockstep(rows, np.array([len(piece)]))
        assert ids[live].tolist() == merges.alone(piece)


def test_cases(spark):
    docs = spark.createDataFrame(
        [(1, "tea and trade", 7), (1, "tea and trade", 7), (2, None, 8), (None, "", 9)], "doc_id long, text string, IDS int"
    )
    out = bpe.encode(docs, PATH)
    assert out.columns == ["doc_id", "text", "ids"]
    rows = sorted(out.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    assert rows[0]["ids"] == rows[1]["ids"] != [] and rows[2]["ids"] == rows[3]["ids"] == []
    back = bpe.decode(out, PATH).collect()
    assert {(r["text"] or "").encode() for r in back} == {bytes(r["decoded"]) for r in back}
    both = {(r["text"] or "", tuple(r["ids"]), bytes(r["decoded"])) for r in bpe.round_trip(docs, PATH).collect()}
    assert both == {(r["text"] or "", tuple(r["ids"]), (r["text"] or "").encode()) for r in rows}
    odd = spark.createDataFrame([([None, -4, 10**6],), (None,)], "ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(odd, PATH).collect()] == [b"", b""]
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_query(spark, library):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for row in op8_bpe_round_trip(spark, DATA).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
