"""The hidden Markov model against sums over all state sequences and plain counts."""

import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from freightlake.llm import common, language_model, queries
from freightlake.llm.language_model import Model


def drawn(states, classes, seed=1):
    draws = np.random.default_rng(seed)
    start, steps = draws.dirichlet(np.ones(states)), draws.dirichlet(np.ones(states), states)
    return Model(start, steps, draws.dirichlet(np.ones(classes), states).T), draws


def paths(model, sequence):
    for path in product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]] * model.emission[sequence[0], path[0]]
        for a, b, c in zip(path, path[1:], sequence[1:]):
            p *= model.steps[a, b] * model.emission[c, b]
        yield path, p


def test_likelihood_is_the_sum_over_all_paths():
    model, draws = drawn(3, 5)
    sequences = [draws.integers(0, 5, n).astype(np.uint16) for n in (1, 6, 2, 6, 4)]
    want = [math.log10(sum(p for _, p in paths(model, s))) for s in sequences]
    assert np.allclose(language_model.forward(model, sequences), want)
    long = draws.integers(0, 5, 5003).astype(np.uint16)
    plain = language_model.forward(model, [long])[0]
    for lanes in (1, 2, 7, 64, 5003, 9000):
        assert math.isclose(language_model.forward_long(model, long, lanes), plain)
    assert math.isclose(language_model.forward_state(model, long)[0], plain)


def test_expected_counts_are_sums_over_all_paths():
    model, draws = drawn(2, 4, 3)
    sequences = [draws.integers(0, 4, n).astype(np.uint16) for n in (5, 1, 7, 7, 3)]
    start, steps, emitted = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for s in sequences:
        found = list(paths(model, s))
        total = sum(p for _, p in found)
        for path, p in found:
            start[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                steps[a, b] += p / total
            for c, state in zip(s, path):
                emitted[c, state] += p / total
    got = language_model.expected_counts(model, sequences)
    assert all(np.allclose(a, b) for a, b in zip(got, (start, steps, emitted)))
    assert math.isclose(got[3], language_model.forward(model, sequences).sum())


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in common.documents(spark, sf_dir).collect()]
    return docs, queries.op12_language_model(spark, sf_dir).collect()


def plain_base(docs, out):
    counts = Counter()
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t in docs]
    for own, held in zip(tokens, out):
        if not held:
            counts.update(own)
    total, distinct = sum(counts.values()), len(counts)
    scale = total + 0.5 * (distinct + 1)
    return total, [
        (len(own), sum(counts[t] > 0 for t in own), sum(math.log10((counts[t] + 0.5) / scale) for t in own))
        for own in tokens
    ]


def test_counts_and_base_scores(scored):
    docs, rows = scored
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs]
    total, want = plain_base(docs, held)
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(docs) == len(rows)
    for (doc, _), out, (n, known, base) in zip(docs, held, want):
        r = got[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)


def test_states_tell_held_out_texts_better_than_counts(scored):
    _, rows = scored
    held = [r for r in rows if r.held_out]
    base, score = sum(r.base_score for r in held), sum(r.score for r in held)
    assert len(held) > 20 and score > base + 0.03 * abs(base)


def test_baum_welch_raises_likelihood(spark, sf_dir):
    rows = common.documents(spark, sf_dir).select(F.lit(False).alias("held_out"), "doc_id", "text")
    rows = common.blank(rows, "text")
    counts = common.stored_once(language_model.word_counts(rows.select("text")), "counts")
    words = language_model.vocabulary(counts, 200, 400)
    texts = common.stored_once(language_model.coded(rows, words), "coded")
    model, logs = Model.first(words.share(), 4), []
    for _ in range(5):
        model, log = language_model.one_round(texts, model, words.share())
        logs.append(log)
    assert all(b > a for a, b in zip(logs, logs[1:]))
    for shares in (model.start, *model.steps, *model.emission.T):
        assert math.isclose(shares.sum(), 1.0)
    # Rounds over partitions give what one round over all runs gives.
    runs = [r for t in texts.collect() for r in language_model._runs(bytes(t.classes))]
    whole = language_model.expected_counts(model, runs)
    again, log = language_model.one_round(texts.repartition(7), model, words.share())
    want = model.updated(*whole[:3], words.share())
    assert math.isclose(log, whole[3]) and np.allclose(again.emission, want.emission)
    assert np.allclose(again.steps, want.steps) and np.allclose(again.start, want.start)


def test_words_of_a_class_share_it(spark, make):
    text = "a a a b b cat bat rat rat dog x" + " w" * 9
    counts = language_model.word_counts(make([(text,)], "text string"))
    words = language_model.vocabulary(counts, 2, 4)
    rows = make([(1, False, text + " new")], "doc_id long, held_out boolean, text string")
    got = language_model.coded(rows, words).first()
    classes = np.frombuffer(bytes(got.classes), "<u2")
    assert got.n_tokens == len(classes) == len(text.split()) + 2
    assert set(words.place) == {b"w", b"a", b"b", b"rat"} and words.frequent == 1
    assert {bytes(r.word): r.n for r in got.rare} == {
        b"cat": 1, b"bat": 1, b"dog": 1, b"x": 1, b"new": 1, b"\n": 1
    }
    assert words.shape_tokens.sum() == len(text.split()) + 1 - 9


@pytest.mark.parametrize("limits", [{}, {"frequent": 3, "known": 5}])
def test_odd_rows(make, limits):
    long = " ".join(f"w{i % 977}" for i in range(9000)) + " " + "z" * 200_000
    docs = [(1, None), (2, ""), (None, "A b"), (4, "a B a\tb\x0b"), (4, "a B a\tb\x0b"), (5, long)]
    docs += [(6, "é É ẞ"), (7, "zz yy"), (11, "unseen words only"), (12, long + " tail")]
    frame = make([(i, t, 1, 0.5, "x") for i, t in docs], "doc_id long, text string, row int, base double, rare string")
    held = [i is None or i in (11, 12) for i, _ in docs]
    out = F.when(F.col("doc_id").isNotNull(), F.col("doc_id").isin(11, 12))
    rows = language_model.score(frame, out, rounds=2, **limits).collect()
    total, want = plain_base(docs, held)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows)
    assert got == sorted(
        (str(i), h, n, k, round(b, 6)) for (i, _), h, (n, k, b) in zip(docs, held, want)
    )
    assert all(r.train_tokens == total and r.score < 0 and math.isfinite(r.score) for r in rows)
    fours = {r.score for r in rows if r.doc_id == 4}
    assert len(fours) == 1
    assert language_model.score(frame.limit(0), out, **limits).collect() == []
    none = language_model.score(frame, F.lit(True), rounds=2, **limits).collect()
    assert all(r.base_score == 0 and math.isfinite(r.score) and r.n_known == 0 for r in none)
