"""Passages of 51 words that repeat, with fewer bytes than a window of bytes has."""

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from test_repeats import expected  # noqa: E402

from freightlake.llm import common, queries, repeats  # noqa: E402

DRAWS = random.Random(31)


def some_words(count, size=6):
    return ["".join(DRAWS.choices("abcdefghij", k=DRAWS.randrange(2, size))) for _ in range(count)]


def without_windows(texts, size):
    """Words of each text that no repeated window of ``size`` words covers."""
    split = {k: t.split() for k, t in texts.items()}
    seen = Counter(tuple(w[i : i + size]) for w in split.values() for i in range(len(w) - size + 1))
    out = {}
    for k, w in split.items():
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out[k] = [x for i, x in enumerate(w) if i not in gone]
    return out


def test_passages_of_51_words_go_and_of_50_stay(make, spark):
    passages = [some_words(n) for n in (51, 51, 60, 50, 50)]
    assert all(len(" ".join(p)) < 400 for p in passages)
    texts = {}
    for at, passage in enumerate(passages):
        for copy in range(3):
            before, after = some_words(DRAWS.randrange(80)), some_words(70)
            gap = "\n" if copy == 2 else " "
            texts[10 * at + copy] = " ".join(before) + " " + gap.join(passage) + " é " + " ".join(after)
    texts |= {90: "", 91: "x " * 40, 92: " ".join(some_words(300))}
    want = without_windows(texts, 51)
    assert all(len(want[k]) <= len(texts[k].split()) - 51 for k in (0, 11, 22))
    frame = make(list(texts.items()), "doc_id long, text string").repartition(3)
    got = corpus_pipeline.passage_dedup(spark, frame, "").collect()
    assert {r.doc_id: r.text.split() for r in got} == want


def test_query_equals_all_windows(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in common.documents(spark, sf_dir).collect()}
    spans = dict(zip(texts, expected(list(texts.values()), 400)))
    rows = queries.op4_suffix_dedup(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        edges = [0, *(e for s in spans[r.doc_id] for e in s), len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(raw), len(raw) - len(kept), len(spans[r.doc_id]))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_units_alone_and_odd_rows(make):
    passage = " ".join(some_words(8))
    rows = [(1, f"a {passage} b"), (2, f"c  {passage}\n"), (2, f"c  {passage}\n"), (None, None), (3, "")]
    rows += [(4, passage.replace(" ", "\t")), (None, passage)]
    frame = make([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, key int, coded string")
    got = repeats.remove_repeats(frame, length=None, words=8).collect()
    assert sorted((str(r.doc_id), bytes(r.kept), len(r.spans), len(r.passages)) for r in got) == sorted(
        [("1", b"a  b", 0, 1), ("2", b"\n", 0, 1), ("2", b"\n", 0, 1), ("None", b"", 0, 0)]
        + [("3", b"", 0, 0), ("4", b"", 0, 1), ("None", b"", 0, 1)]
    )
    apart = repeats.remove_repeats(frame, length=9, words=8, cut_passages=False)
    alone = repeats.remove_repeats(frame, length=9)
    key = lambda r: (str(r.doc_id), r.n_bytes, str(r.spans), bytes(r.kept))
    assert sorted(map(key, apart.collect())) == sorted(map(key, alone.collect()))
    with pytest.raises(ValueError):
        repeats.remove_repeats(frame, length=None)
    assert repeats.remove_repeats(frame.limit(0), length=None, words=8).collect() == []
