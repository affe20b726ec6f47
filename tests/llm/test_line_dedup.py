from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from broadsheet.llm import line_dedup as ld
from broadsheet.llm.queries import op2_line_dedup
from tests.llm.helpers import frame, prose
from tests.test_registered import DATA


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain(rows, limit):
    first = {}
    for i, text in rows:
        if i is not None and text is not None:
            for k, line in enumerate(text.split("\n")):
                first[line] = min(first.get(line, (i, k)), (i, k))
    near = {}
    long = [x for x in first if len(x) >= ld.NEAR_CHARS]
    for a in long:
        for b in long:
            if first[a] < first[b] and abs(len(a) - len(b)) <= limit and distance(a, b) <= limit:
                near[b] = min(near.get(b, first[a]), first[a])
    out = []
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = [
            x for k, x in enumerate(lines)
            if i is None or len(x) < ld.EXACT_CHARS or (first[x] == (i, k) and x not in near)
        ]
        out.append((i, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=str), near


def got(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_removed"], r["kept"]) for r in df.collect()), key=str)


def corpus():
    draw = random.Random(8)
    lines = [" ".join(prose(i, 12)) for i in range(12)] + ["short", "", "exactly twenty chars", "a line that is just under forty letters"]
    for line in lines[:12]:
        for edits in (1, 1, 2, 3):
            x = list(line)
            for _ in range(edits):
                k = draw.randrange(len(x))
                x[k : k + 1] = draw.choice([[], ["é"], [x[k], "z"]])
            lines.append("".join(x))
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randint(1, 8)))) for i in range(40)]
    return rows + [(50, None), (51, ""), (None, lines[0]), (52, "\n\n"), (53, "ab" * 40000 + "\n" + lines[3]), (54, "ab" * 40000 + "c"), (7, rows[7][1])]


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_against_plain_version(spark, limit):
    rows = corpus()
    want, near = plain([(i, t if t is None or len(t) < 5000 else t) for i, t in rows if i not in (53, 54)], limit)
    assert near
    assert got(ld.dedup_lines(frame(spark, [r for r in rows if r[0] not in (53, 54)]), limit)) == want


def test_very_long_lines_and_sources(spark):
    out = {r["doc_id"]: r for r in ld.dedup_lines(frame(spark, corpus())).collect() if r["doc_id"] in (53, 54)}
    assert out[54]["n_removed"] == 1 and out[54]["kept"] == ""
    assert tuple(out[54]["removed"][0]) == (0, 53, 0, 1)


def test_banded_automaton_against_the_table():
    draw = random.Random(9)
    a, b = [], []
    for _ in range(400):
        x = "".join(draw.choices("abc", k=draw.randint(0, 12)))
        y = list(x)
        for _ in range(draw.randint(0, 4)):
            k = draw.randint(0, len(y))
            y[k : k + draw.randint(0, 1)] = draw.choice(["", "a", "b"])
        a.append(x)
        b.append("".join(y))
    codes = lambda texts: [np.array([ord(c) for c in t], np.uint32) for t in texts]
    for limit in (0, 1, 2, 3, 5):
        want = [min(limit + 1, distance(x, y)) for x, y in zip(a, b)]
        assert ld.banded_distance(codes(a), codes(b), limit).tolist() == want


def test_lines_of_texts():
    lines = ld.Lines(pa.array(["a\nbé\n", None, "", "\n\n", "x"]))
    text = "".join(map(chr, lines.codes))
    assert [text[s:e] for s, e in zip(lines.start, lines.end)] == ["a", "bé", "", "", "", "", "", "x"]
    assert lines.count.tolist() == [3, 0, 1, 3, 1]


def test_empty_table_and_kept_columns(spark):
    assert ld.dedup_lines(frame(spark, [])).count() == 0
    out = ld.dedup_lines(frame(spark, [(1, "a")]), keep=("start", "row"))
    assert out.columns == ["doc_id", "start", "row", "n_lines", "n_removed", "kept", "removed"]


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    first = {}
    for i, text in sorted(rows):
        for k, line in enumerate(text.split("\n")):
            first.setdefault(line, (i, k))
    for r in op2_line_dedup(spark, DATA).collect():
        lines = dict(rows)[r["doc_id"]].split("\n")
        gone = {x["line"]: x for x in r["removed"]}
        for k, line in enumerate(lines):
            if len(line) >= ld.EXACT_CHARS and first[line] != (r["doc_id"], k):
                assert k in gone
            elif k in gone:
                x = gone[k]
                other = dict(rows)[x["source_doc"]].split("\n")[x["source_line"]]
                assert (x["source_doc"], x["source_line"]) < (r["doc_id"], k)
                assert 0 < distance(line, other) == x["distance"] <= limit(line, other)
        assert r["kept"] == "\n".join(x for k, x in enumerate(lines) if k not in gone)


def limit(a: str, b: str) -> int:
    return int(ld.allowed(np.array([min(len(a), len(b))]))[0])


def near_earlier(rows):
    """For each one-line document the earlier ones near it, by distances of all pairs."""
    out = {}
    for k, (j, b) in enumerate(rows):
        for i, a in rows[:k]:
            most = limit(a, b)
            if a != b and abs(len(a) - len(b)) <= most:
                d = ld.long_distance(*[np.array([ord(c) for c in t], np.uint32) for t in (a, b)], most)
                if d <= most:
                    out.setdefault(j, {})[i] = d
    return out


def near_corpus():
    """Lines of many lengths and copies with up to a few more edits than their length allows."""
    draw = random.Random(11)
    rows = []
    for i, n in enumerate([45, 79, 80, 81, 119, 120, 121, 160, 200, 400, 405, 640, 1300, 6000]):
        line = " ".join(prose(100 + i, n))[:n].ljust(n, "x")
        rows.append((100 * i, line))
        for j in range(1, 12):
            x = list(line)
            for _ in range(max(1, limit(line, line) + draw.choice([-1, 0, 0, 1]) if j % 2 else draw.randint(1, 1 + limit(line, line)))):
                k = draw.randrange(len(x))
                x[k : k + 1] = draw.choice([[], ["é"], [x[k], "z"]])
            rows.append((100 * i + j, "".join(x)))
    return rows + [(5000, "ab" * 1000), (5001, "ab" * 998)]


def agrees(rows, out):
    want, first = near_earlier(rows), {}
    for i, text in rows:
        if text in first and i not in want:
            assert out[i] == [(0, first[text], 0, 0)]
        elif i in want:
            ((line, source, source_line, d),) = out[i]
            assert line == source_line == 0 and want[i].get(source, 0 if dict(rows)[source] == text else None) == d
        else:
            assert out[i] == []
        first.setdefault(text, i)
    return want


def removed(spark, rows, **other):
    return {r["doc_id"]: [tuple(x) for x in r["removed"]] for r in ld.dedup_lines(frame(spark, rows), **other).collect()}


def test_edits_grow_with_the_length(spark):
    assert [int(x) for x in ld.allowed(np.array([39, 40, 41, 40 * ld.GROWTH - 1, 40 * ld.GROWTH, 40 * ld.GROWTH**9]))] == [0, 1, 1, 1, 2, 10]
    rows = near_corpus()
    want = agrees(rows, removed(spark, rows))
    assert max(d for near in want.values() for d in near.values()) > 3


@pytest.mark.parametrize("fruitful", [0.1, 0.0001, 2.0])
def test_families_that_share_a_segment(spark, monkeypatch, fruitful):
    """Families of near copies behind one common half, earlier and later, short and long."""
    monkeypatch.setattr(ld, "FRUITFUL", fruitful)
    draw = random.Random(12)
    half = "this line begins with what many others also begin with " * 2
    rows = []
    for family in range(6):
        end = "".join(draw.choices("abcdefgh ", k=110))
        for _ in range(7):
            x = list(end)
            for _ in range(draw.randint(0, 3)):
                x[draw.randrange(len(x))] = draw.choice("xyz")
            rows.append(half + "".join(x))
    rows += [half + f"page {i} of {j}" for i in range(12) for j in (7, 80)]
    draw.shuffle(rows)
    rows = list(enumerate(rows))
    agrees(rows, removed(spark, rows))


def test_near_copies_cost_pairs_in_proportion(spark, monkeypatch):
    """Pairs that are verified among B near copies of a line are a small multiple of B."""
    counted = []
    verify = ld._verified
    monkeypatch.setattr(ld, "_verified", lambda pairs, *rest: (counted.append(pairs.count()), verify(pairs, *rest))[1])
    line = " ".join(prose(77, 200))[:400]
    for copies in (100, 200):
        draw = random.Random(copies)
        rows = [(0, line)]
        for i in range(1, copies):
            x = list(line)
            x[draw.randrange(len(x))] = f"{i % 10}"
            rows.append((i, "".join(x)))
        counted.clear()
        out = removed(spark, rows)
        assert sum(len(x) == 1 for x in out.values()) >= copies - 2
        assert sum(counted) <= 4 * copies


def test_long_distance_against_the_table():
    draw = random.Random(10)
    for _ in range(400):
        x = "".join(draw.choices("abc", k=draw.randint(0, 90)))
        y = list(x)
        for _ in range(draw.randint(0, 9)):
            k = draw.randint(0, len(y))
            y[k : k + draw.randint(0, 1)] = draw.choice(["", "a", "b"])
        limit = draw.randint(0, 8)
        a, b = (np.array([ord(c) for c in t], np.uint32) for t in (x, "".join(y)))
        assert ld.long_distance(a, b, limit) == min(limit + 1, distance(x, "".join(y)))


def test_short_lines_are_compared_exactly(spark):
    out = {r["doc_id"]: r["kept"] for r in ld.dedup_lines(frame(spark, [(1, "a\n\nshort"), (2, "short\n\nb\na")])).collect()}
    assert out == {1: "a\n\nshort", 2: "\nb"}


def one_word_more(copies, seed):
    """A line, and copies of it with one word more than it, that differ by more edits than are allowed."""
    draw = random.Random(seed)
    words = prose(78, 200)[:90]
    rows = [(0, " ".join(words))]
    while len(rows) < copies:
        at = draw.randrange(len(words))
        more = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=5))
        rows.append((len(rows), " ".join([*words[:at], more, *words[at:]])))
    return rows


def test_lines_that_share_passages_make_few_pairs(spark, monkeypatch):
    """Lines not near one another that share most of their segments are told apart before they make pairs."""
    counted = []
    verify = ld._verified
    monkeypatch.setattr(ld, "_verified", lambda pairs, *rest: (counted.append(pairs.count()), verify(pairs, *rest))[1])
    rows = one_word_more(300, 5)
    agrees(rows, removed(spark, rows))
    assert sum(counted) <= 25 * len(rows)  # 63040 pairs if only the parity of all characters is compared


def test_marks_are_no_further_apart_than_edits_allow():
    """Of pairs within the distance, a segment is unchanged at which the counts beside it pass."""
    draw = random.Random(13)
    tried = 0
    for n in range(600):
        t = n % 4 + 1
        x = "".join(draw.choices("ab" if n % 3 else "abcdefgh", k=draw.randint(t + 1, 40)))
        y = list(x)
        for _ in range(draw.randint(1, t)):
            k = draw.randrange(len(y) + 1)
            y[k : k + draw.randint(0, 1)] = draw.choice(["", "a", "b", "c"])
        x, y = sorted([x, "".join(y)], key=len)
        if x == y or distance(x, y) > t or len(x) <= t:
            continue
        tried += 1
        sides = []
        for text, probe in ((x, False), (y, True)):
            lines = ld.Lines(pa.array([text]))
            _, key, _, part, marks = ld._keys(lines, np.array([0]), t, probe, marked=True)
            sides.append(list(zip(key.tolist(), part.tolist(), marks.view(np.uint64).tolist())))
        apart = lambda a, b, k: sum((u ^ v).bit_count() for u, v in zip(a[4 * k : 4 * k + 4], b[4 * k : 4 * k + 4]))
        assert any(
            key == other and apart(a, b, 0) <= 2 * i and apart(a, b, 3) <= 2 * (t - i) and apart(a, b, 1) <= min(2, 2 * (t - i)) and apart(a, b, 2) <= min(4, 2 * (t - i))
            for key, i, a in sides[0] for other, _, b in sides[1]
        ), (x, y, t)
    assert tried > 200


def test_only_lines_that_meet_another_are_compared(spark, monkeypatch):
    """Texts and index keys are made of lines that share a segment with another line, not of all."""
    listed = []
    chosen = ld._line_table
    monkeypatch.setattr(ld, "_line_table", lambda docs: (listed.extend(r["n"] for r in docs.selectExpr("size(wanted) AS n").collect()), chosen(docs))[1])
    draw = random.Random(14)
    rows = [(i, "".join(draw.choices("abcdefghijklmnop", k=draw.randint(40, 400)))) for i in range(300)]
    rows += [(1000 + i, text[:20] + "é" + text[20:]) for i, text in rows[:20]]
    assert len(agrees(rows, removed(spark, rows))) == 20
    assert sum(listed) == 40


@pytest.mark.parametrize("limit", [None, 1, 2, 3, 9])
def test_lines_within_the_distance_meet(spark, limit):
    """Lines near one another are told as meeting, whatever the edits; dealt keys are those of the index and the probes."""
    rows = corpus()[:40] if limit else near_corpus()
    texts = sorted({x for _, t in rows for x in t.split("\n") if len(x) >= ld.NEAR_CHARS})
    lines = ld.Lines(pa.array(texts))
    which = np.arange(len(texts))
    hashes = lines.hashes(which, ld._FIRST)[0] & np.uint64((1 << 8 * ld.LINE_BYTES) - 1)
    want = set()
    keys = {}
    for edits, low, high in ld._groups(int(lines.size.max()), limit):
        for probe in (False, True):
            some = np.flatnonzero((lines.size >= low) & (lines.size < high + (edits if probe else 0)))
            owner, key, _ = ld._keys(lines, some, edits, probe, low, high)
            for o, k in zip(some[owner].tolist(), key.tolist()):
                keys.setdefault((edits, k), ([], []))[probe].append(o)
    for index, probes in keys.values():
        if index and len({*index, *probes}) > 1:
            want |= {int(hashes[o]) for o in (*index, *probes)}
    assert want and {r["met"] for r in ld._meeting(frame(spark, rows), limit).collect()} == want


def test_keys_beyond_the_limit_let_all_their_lines_on():
    draw = np.random.default_rng(15)
    key, line = draw.integers(0, 1 << 63, 400).astype(np.uint64), draw.integers(0, 1 << 40, 400).astype(np.uint64)
    key[200:] = key[:200]
    own = np.arange(400) % 4 == 0
    at = [slice(k, k + 50) for k in range(0, 400, 50)]
    dealt = pa.Table.from_batches([ld._dealt(key[a], line[a], own[a]) for a in at]).sort_by("dealt").to_batches()
    met = lambda limit: {x for b in ld._meet(iter(dealt), limit) for x in b.column("met").to_pylist()}
    pairs = [k for k in range(200) if own[k] or own[k + 200]]
    want = {int(line[k]) for i in pairs for k in (i, i + 200)}
    assert met(1 << 20) == want
    assert met(1) >= want


def test_kept_texts_of_all_ends(spark):
    """Removed lines first, last, in the middle or all, empty lines beside them, and texts beyond ASCII."""
    rows = [(0, "a\nbé"), (1, "a\nx1\nbé"), (2, "x2\na\n\nbé"), (3, "a\nbé"), (4, "bé\n"), (5, "\na"), (6, "x😀\nbé\nx3"), (7, None), (8, ""), (9, "a\n\nbé")]
    assert got(ld.dedup_lines(frame(spark, rows))) == plain(rows, 1)[0]
