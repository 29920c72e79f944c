"""Every stage against the operator's own rows or a plain loop, on what it was given."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from test_near_duplicates import components, fingerprint  # noqa: E402
from test_packing import check_layout  # noqa: E402
from test_word_passages import without_windows  # noqa: E402

from freightlake.llm import common, near_duplicates, quality, quality_rules, repeats  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input of every stage, and the last result."""
    docs = common.documents(spark, sf_dir)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(common.stored_once(stage(spark, out[-1], sf_dir), name))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_classifier_stage(stages, spark, sf_dir):
    labels = common.table(spark, sf_dir, "labels")
    judged = quality.classify(stages[0], labels).collect()
    assert set(texts(stages[1])) == {r.doc_id for r in judged if r.predicted}
    assert stages[1].columns == stages[0].columns
    assert texts(stages[1]).items() <= texts(stages[0]).items()


def test_rules_stage(stages, spark, sf_dir):
    labels = common.table(spark, sf_dir, "labels")
    judged = quality_rules.apply_rules(stages[1], labels).collect()
    assert set(texts(stages[2])) == {r.doc_id for r in judged if r.kept}
    assert stages[2].schema == stages[1].schema


def test_near_duplicate_stage(stages):
    before = texts(stages[2])
    of = components({k: fingerprint(t) for k, t in before.items()})
    assert texts(stages[3]) == {k: before[k] for k in set(of.values())}
    assert stages[3].columns == stages[0].columns


def test_passage_stage(stages):
    before = texts(stages[3])
    want = without_windows(before, 51)
    after = stages[4].collect()
    assert {r.doc_id: r.text.split() for r in after} == want
    assert any(len(want[k]) < len(t.split()) for k, t in before.items())
    assert all(r.n_chars == len(r.text) for r in after)
    assert stages[4].columns == stages[0].columns


def test_packing_stage(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(texts(stages[4]))
    check_layout(rows, 4096)


def test_run_is_all_stages(stages, spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    again = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "length", "ids_crc32")
    first = stages[5].select("doc_id", "piece", "length", "ids_crc32")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect()))


def test_keeping_rows_with_odd_columns(make):
    rows = [(1, "a b c d", 1, "p"), (1, "a b c d", 2, "q"), (1, "other words here", 3, "r")]
    rows += [(None, "a b c d", 4, "s"), (None, "x y", 5, "t"), (None, "x y", 5, "t")]
    rows += [(3, None, 6, "u"), (2, "", 7, "v"), (9, "quite alone, this", 8, "w")]
    frame = make(rows, "doc_id long, text string, bits int, root string")
    kept = near_duplicates.keep_one(frame)
    assert kept.columns == frame.columns
    got = sorted((str(r.doc_id), r.text) for r in kept.collect())
    want = [("1", "a b c d"), ("1", "other words here"), ("2", ""), ("9", "quite alone, this")]
    assert got == sorted([*want, ("None", "x y")])
    assert near_duplicates.keep_one(frame.limit(0)).collect() == []
    labels = make([], "doc_id long, quality int")
    assert quality.keep_good(frame, labels).count() == len(rows)
    assert quality_rules.keep_passing(frame, labels).count() == 0
    cut = repeats.without_repeats(make([(1, "é" * 10, 10), (2, "xé" + "é" * 9, 11)], "kept int, text string, n_chars int"), length=9)
    assert sorted((r.kept, r.text, r.n_chars) for r in cut.collect()) == [(1, "", 0), (2, "x", 1)]
