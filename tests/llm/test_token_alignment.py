from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from broadsheet.llm import token_alignment as ta
from broadsheet.llm.queries import op11_token_alignment
from tests.llm.helpers import frame, prose
from tests.test_registered import DATA

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.alphabet = ta.byte_alphabet()

    def tokens(self, text):
        spaced = (" " + (text or "")).encode()
        a = self.a.encode(" " + (text or ""), add_special_tokens=False)
        b = self.b.encode(text or "")
        a_bytes = [bytes(self.alphabet[c] for c in t) for t in a.tokens]
        b_bytes = [ta.piece_bytes(self.b.id_to_piece(i)) for i in b]
        if not text or b"".join(a_bytes) != spaced or b"".join(b_bytes) != spaced:
            return [], []
        return self.spans(a.ids, a_bytes), self.spans(b, b_bytes)

    @staticmethod
    def spans(ids, tokens):
        out, at = [], 0
        for i, t in zip(ids, tokens):
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    def result(self, rows):
        all_tokens = [self.tokens(t) for _, t in rows]
        linked = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in all_tokens]
        count = Counter(p for one in linked for p in set(one))
        most = Counter()
        for (a, _), n in count.items():
            most[a] = max(most[a], n)
        out = []
        for (i, _), (a, b), own in zip(rows, all_tokens, linked):
            cuts = sorted({x[2] for x in a} & {y[2] for y in b})
            said = [
                ",".join(str(x[0]) for x in a if low < x[2] <= high) + "|" + ",".join(str(y[0]) for y in b if low < y[2] <= high)
                for low, high in zip([0, *cuts], cuts)
            ]
            best = sum(count[p] == most[p[0]] for p in own)
            out.append((i, len(a), len(b), len(cuts), len(own), best, sum(count[p] for p in own), ";".join(said)))
        return out


def rows():
    draw = random.Random(8)
    out = [(i, " ".join(prose(i, draw.randint(1, 60)))) for i in range(30)]
    out += [(40, None), (41, ""), (42, " "), (43, "a\n\n  b\t c "), (44, "Größe — naïve 東京 😀 ��"), (45, "x" * 3000), (46, "<|endoftext|> <s> </s> <unk> <0x41>")]
    out += [(47, "▁under"), (48, "it's they'll we'Re 12345 $%& \x00\x01"), out[3], (3, out[4][1]), (None, out[5][1]), (49, "  two spaces"), (50, "ﬁ ½ é")]
    return out


def got(df):
    return [tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()]


@pytest.mark.parametrize("chunk", [1 << 20, 600])
def test_against_plain_version(spark, monkeypatch, chunk):
    monkeypatch.setattr(ta, "CHUNK_BYTES", chunk)
    told, want = got(ta.align(frame(spark, rows()), A, B)), Plain().result(rows())
    assert sorted(told, key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 30 and any(r[3] < min(r[1], r[2]) for r in want)


def test_digest_and_no_rows(spark):
    some = [(1, "an owl's tale"), (2, None)]
    want = {r[0]: hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "" for r in Plain().result(some)}
    assert {r[0]: r[7] for r in got(ta.align(frame(spark, some), A, B, digest=True))} == want
    assert got(ta.align(frame(spark, []), A, B)) == []


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_the_shared_ends(seed):
    rng = np.random.default_rng(seed)
    sizes_a, sizes_b, first_a, first_b, at = [], [], [0], [0], 0
    for _ in range(rng.integers(0, 6)):
        n = int(rng.integers(1, 60))
        for sizes, first, share in ((sizes_a, first_a, 0.4), (sizes_b, first_b, rng.random())):
            ends = np.append(np.flatnonzero(rng.random(n - 1) < share) + 1, n)
            sizes += np.diff(np.concatenate(([0], ends))).tolist()
            first.append(first[-1] + len(ends))
    a, b = (
        ta.Tokens(np.zeros(len(s), np.int64), np.cumsum(np.array(s, np.int64)), np.array(f))
        for s, f in ((sizes_a, first_a), (sizes_b, first_b))
    )
    assert (ta.shared_cuts(a, b) == np.isin(a.ends, b.ends)).all()


def test_query_against_plain_version(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() if len(r["text"] or "") < 3000]
    plain = Plain()
    told = {r["doc_id"]: r for r in op11_token_alignment(spark, DATA).collect()}
    for i, text in docs[:80]:
        _, n_a, n_b, n_groups, n_links, *_, groups = plain.result([(i, text)])[0]
        r = told[i]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (n_a, n_b, n_groups, n_links)
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
