"""Weighted samples against the exact similarity, neighbours against a plain loop."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from freightlake.llm import fingerprints


def bag(text):
    words = ["^", *text.split(), "$"]
    return Counter(zip(words, words[1:]))


def jaccard(a, b):
    a, b = bag(a), bag(b)
    return sum((a & b).values()) / sum((a | b).values())


def test_collisions_estimate_generalised_jaccard():
    draws = np.random.default_rng(5)
    sampler = fingerprints.Sampler(1024, 3)
    for share in (0.2, 0.5, 0.9):
        base = [f"w{i}" for i in draws.integers(0, 12, 90)]
        other = list(base)
        for i in range(int(90 * (1 - share))):
            other[i] = f"w{draws.integers(0, 12)}"
        left, right = " ".join(base), " ".join(other)
        signed = sampler.signatures([left.encode(), right.encode()])
        got = fingerprints.likeness(signed[:1], signed[1:])[0]
        assert got == pytest.approx(jaccard(left, right), abs=0.06)


def test_signature_does_not_depend_on_company():
    sampler = fingerprints.Sampler(16, 3)
    texts = [b"", b"a", b"a b a b a b", b"x " * 70_000, b"long " + b"y z " * 90_000]
    together = sampler.signatures(texts)
    for i, t in enumerate(texts):
        assert (sampler.signatures([t]) == together[i : i + 1]).all()


def expected(rows, sampler):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for at, (key, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = (sampler.signatures([t.encode()]) for t in (text, changed, after))
        out.append(
            (
                key,
                len(text),
                hashlib.sha256(changed.encode()).hexdigest(),
                *[fingerprints.hexadecimal(x)[0] for x in (a, b)],
                float((a == b).mean()),
                float((a == c).mean()),
            )
        )
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("blocks", [1, 3, 50])
def test_neighbours(make, spark, sf_dir, blocks):
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in some]
    rows += [(1000, ""), (1005, None), (1006, "äöü ß €"), (1007, "x"), (None, "no id")]
    frame = make([(a, b, "z") for a, b in rows], "doc_id long, text string, block string")
    got = fingerprints.with_neighbours(frame.repartition(4), blocks=blocks)
    sampler = fingerprints.Sampler(fingerprints.SAMPLES, fingerprints.SEED)
    found = sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert found == expected(rows, sampler)


def test_small_batches_repeated_rows_and_plain_fingerprints(make, spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        frame = make([(1, "a b")] * 5 + [(2, "c d e f")] * 4, "doc_id long, text string")
        got = fingerprints.with_neighbours(frame).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 9
    alike = Counter((r.doc_id, r.near_next) for r in got)
    assert alike == {(2, 1.0): 3, (2, 0.0): 1, (1, 1.0): 4, (1, 0.0): 1}
    plain = {r.fingerprint for r in fingerprints.fingerprint(frame).collect()}
    assert plain == {r.fingerprint for r in got}


def test_lone_and_no_documents(make):
    lone = fingerprints.with_neighbours(make([(4, "ab cd")], "doc_id long, text string"))
    row = lone.collect()[0]
    assert row.near_next == 1.0 and row.n_chars == 5
    none = make([], "doc_id long, text string")
    assert fingerprints.with_neighbours(none).collect() == []
    assert fingerprints.fingerprint(none).collect() == []


@pytest.mark.parametrize("words", [20_000, 200_000])
def test_long_texts_of_different_words(words):
    sampler = fingerprints.Sampler(256, 3)
    common, left, right = (
        " ".join(f"{name}{i}" for i in range(words // 2)) for name in ("c", "l", "r")
    )
    texts = [f"{common} {left}", f"{common} {right}", f"{left} {right}"]
    signed = sampler.signatures([t.encode() for t in texts])
    for a, b in ((0, 1), (0, 2), (1, 2)):
        got = fingerprints.likeness(signed[a : a + 1], signed[b : b + 1])[0]
        assert got == pytest.approx(jaccard(texts[a], texts[b]), abs=0.1)
    apart = sampler.signatures([left.encode(), right.encode()])
    assert fingerprints.likeness(apart[:1], apart[1:])[0] < 0.02


def test_draws_have_their_laws():
    hashes = np.random.default_rng(3).integers(0, 1 << 64, 40_000, np.uint64)
    r, b, a = fingerprints.Sampler(4, 1).draws(hashes)
    # Gamma of shape 2, uniform, and the least of a term of weight one is exponential.
    assert abs(r.mean() - 2) < 0.03 and abs(r.var() - 2) < 0.1
    assert abs(b.mean() - 0.5) < 0.005 and abs(b.var() - 1 / 12) < 0.003
    assert abs(np.exp(a).mean() - 1) < 0.02 and abs(np.exp(a).var() - 1) < 0.06
    assert abs(np.corrcoef(r[:, 0], r[:, 1])[0, 1]) < 0.02
    assert abs(np.corrcoef(r.ravel(), b.ravel())[0, 1]) < 0.02
