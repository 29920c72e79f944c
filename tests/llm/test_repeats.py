"""Repeated passages against a plain search in all windows."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freightlake.llm import repeats

DRAWS = random.Random(3)


def expected(texts, length):
    """Merged spans of each text, from counts of all windows."""
    raw = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        spans = [
            (i, i + length)
            for i in range(len(t) - length + 1)
            if counts[t[i : i + length]] > 1
        ]
        out.append(repeats.merged(spans))
    return out


def assert_same(make, texts, length, parts=4):
    frame = make(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    got = repeats.remove_repeats(frame, length=length).collect()
    want = expected(texts, length)
    assert len(got) == len(texts)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        spans = [(s.start, s.end) for s in r.spans]
        assert spans == want[r.doc_id], (r.doc_id, raw[:80])
        edges = [0, *(e for s in spans for e in s), len(raw)]
        assert bytes(r.kept) == b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
        assert r.n_bytes == len(raw)


def words(count, vocabulary=400):
    return " ".join(f"w{DRAWS.randrange(vocabulary)}" for _ in range(count))


def test_families_of_edited_texts(make):
    length = 40
    passage = [words(18) for _ in range(3)]
    base = words(60)
    texts = ["", None, "short", "é" * 30, "a" * 200, "ab" * 90 + "c" + "ab" * 60, base, base]
    for _ in range(60):
        cut = sorted(DRAWS.sample(range(len(base)), 2))
        texts.append(words(5) + base[cut[0] : cut[1]] + words(4))
        changed = list(base)
        for place in DRAWS.sample(range(len(base)), 3):
            changed[place] = "Z"
        texts.append("".join(changed))
    texts += [words(8) + DRAWS.choice(passage) + words(8) for _ in range(80)]
    texts += [words(40) for _ in range(10)]
    assert_same(make, texts, length)


@pytest.mark.parametrize("length", [8, 17])
def test_small_alphabets(make, length):
    for size in (2, 3):
        texts = [
            "".join(DRAWS.choice("abc"[:size]) for _ in range(DRAWS.randrange(60)))
            for _ in range(25)
        ]
        assert_same(make, texts, length)


def test_production_length_and_blocks(make, spark, sf_dir, monkeypatch):
    some = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    shared = words(120)
    texts = [*some, shared[:399], shared[:400] + "x", "y" + shared[:401], words(3000)]
    texts += [texts[-1][7000:9000] + words(10), "same " * 700, "same " * 500]
    assert_same(make, texts, 400)


def test_long_texts_in_parts(monkeypatch):
    text = words(4000).encode()
    shape = repeats.Shape(40)
    whole = repeats.anchors([b"x" * 10, text], shape)
    monkeypatch.setattr(repeats, "BLOCK", 1000)
    parts = repeats.anchors([b"x" * 10, text], shape)

    def by_window(found):
        return {
            p: (a, c)
            for t, a, low, high, c, _ in zip(*(x.tolist() for x in found))
            for p in range(low, high + 1)
        }

    assert by_window(whole) == by_window(parts)
    assert sorted(by_window(whole)) == list(range(len(text) - 39))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=20), max_size=30))
def test_multikey_quicksort(strings):
    rows = [(s, i) for i, s in enumerate(strings)]
    got = [r[0] for r in repeats.multikey_quicksort(rows, 0)]
    assert got == sorted(strings)


@given(st.binary(max_size=9), st.binary(max_size=9), st.binary(max_size=9))
def test_common_prefix(head, a, b):
    left, right = head + a, head + b
    want = next((i for i, (x, y) in enumerate(zip(left, right)) if x != y), min(len(left), len(right)))
    assert repeats.common_prefix(left, right) == want


def test_neighbours_bound_what_they_did_not_see():
    rows = sorted((1, bytes(DRAWS.choices(b"ab", k=6)), bytes(DRAWS.choices(b"ab", k=6))) for _ in range(40))
    told = list(repeats.compare_neighbours(rows[5:20], rows[4], rows[20], 8, 1))
    for own, (bound, found) in zip(rows[5:20], told):
        pairs = {
            (repeats.common_prefix(own[1], o[1]), repeats.common_prefix(own[2], o[2]))
            for o in rows
            if o is not own
        }
        for first, second in pairs:
            if first + second >= 8:
                assert first <= bound or (first, second) in found


def test_nothing_and_few(make):
    none = make([], "doc_id long, text string")
    assert repeats.remove_repeats(none).collect() == []
    assert_same(make, [None, "", "x"], 400, 1)
    with pytest.raises(ValueError):
        repeats.Shape(7)
    assert np.array_equal(repeats.anchors([], repeats.Shape(8))[0], np.empty(0))


@pytest.mark.parametrize("reach", [1, 2])
def test_windows_that_neighbours_leave_open(make, monkeypatch, reach):
    """Few neighbours, many partners: the hash comparison has to find the rest."""
    monkeypatch.setattr(repeats, "REACH", reach)
    left, right = words(12), words(12)
    texts = []
    for a in range(0, len(left), 9):
        for b in range(0, len(right), 11):
            texts.append(f"{a}L{b}" + left[a:] + "|" + right[:b] + f"R{a}.{b}")
    DRAWS.shuffle(texts)
    assert_same(make, texts, 24)
