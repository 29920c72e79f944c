"""The chain against all labellings, the classifier on rows it never saw."""

import itertools
import math
import zlib

import numpy as np

from freightlake.llm import quality

DRAWS = np.random.default_rng(7)


def by_enumeration(unary, transitions):
    marginal, pairs, total = np.zeros(len(unary)), np.zeros((2, 2)), 0.0
    for labels in itertools.product((0, 1), repeat=len(unary)):
        score = sum(u for u, y in zip(unary, labels) if y)
        score += sum(transitions[a, b] for a, b in zip(labels, labels[1:]))
        weight = math.exp(score)
        total += weight
        marginal += weight * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += weight
    return marginal / total, pairs / total, math.log(total)


def test_forward_backward_equals_enumeration():
    counts = np.array([3, 0, 1, 5, 3])
    unary, transitions = DRAWS.normal(size=12) * 2, DRAWS.normal(size=(2, 2))
    marginal, pairs, logz = quality.forward_backward(unary, transitions, counts)
    all_pairs, at = np.zeros((2, 2)), 0
    for chain, size in enumerate(counts):
        if size:
            want = by_enumeration(unary[at : at + size], transitions)
            assert np.allclose(marginal[at : at + size], want[0])
            assert math.isclose(logz[chain], want[2])
            all_pairs += want[1]
        at += size
    assert np.allclose(pairs, all_pairs)
    none = quality.forward_backward(np.empty(0), transitions, np.array([0, 0]))
    assert none[0].size == 0 and none[2].tolist() == [0, 0]


def test_long_chains_keep_their_numbers():
    unary = np.tile([4.0, -3.0, 0.5], 20_000)
    marginal, _, _ = quality.forward_backward(unary, np.eye(2), np.array([len(unary)]))
    assert np.isfinite(marginal).all() and 0 < marginal.min() < marginal.max() < 1


def test_neighbours_stay_in_their_text():
    texts = [b"one\n\nTWO!!", b"", b" \n", b"three"]
    lines = quality.read_lines(texts)
    assert lines.counts.tolist() == [2, 0, 0, 1] and lines.lengths.tolist() == [3, 5, 5]
    own = lines.features[:, : quality.OWN]
    before = lines.features[:, quality.OWN : 2 * quality.OWN]
    after = lines.features[:, 2 * quality.OWN : 3 * quality.OWN]
    assert (before[1] == own[0]).all() and (after[0] == own[1]).all()
    assert (before[2] == own[2]).all() and (after[2] == own[2]).all()


def test_held_out_accuracy(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.classify(documents, labels)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    found = scored.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.9 * len(found)
    again = {r.doc_id: r.score for r in quality.classify(documents, labels).collect()}
    assert again == {r.doc_id: r.score for r in rows}


def test_labels_and_held_out_rows_are_not_read(make, spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    first = make([(r.doc_id, r.quality) for r in labels], "doc_id long, quality int")
    turned = [
        (r.doc_id, 1 - r.quality if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 else r.quality)
        for r in labels
    ]
    second = make(turned, "doc_id long, quality int")
    a, b = (
        {r.doc_id: r.score for r in quality.classify(documents, x).collect()}
        for x in (first, second)
    )
    assert a == b


def test_odd_rows(make):
    rows = [(None, "a line."), (1, None), (1, ""), (2, "x" * 50_000 + "\n" * 5), (3, "#|#|")]
    frame = make([(a, b, "s") for a, b in rows], "doc_id long, text string, score string")
    none = make([], "doc_id long, quality int")
    got = quality.classify(frame, none).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5}
    assert quality.classify(frame.limit(0), none).collect() == []
    odd = make([(2, 1), (3, 0), (3, None), (5, 1), (None, 0), (2, 1)], "doc_id long, quality int")
    assert len(quality.classify(frame, odd).collect()) == 5
