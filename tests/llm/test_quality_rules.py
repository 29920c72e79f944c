"""Counts, ratios and verdicts against plain loops."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from freightlake.llm import quality_rules as rules

HARD = [
    "",
    " \t\n\x0b",
    "a a a a a",
    "x y z x y z\n x y z ",
    "same line\nsame line\n\n\nsame line \nsame line",
    "é ü no cut\x85here | # <b> $%&*",
    "one two",
    " ".join(f"w{i}" for i in range(49)),
    " ".join(f"w{i}" for i in range(50)),
    " ".join(["p q r"] * 13 + [f"u{i}" for i in range(39)]),
    " ".join(["p q r"] * 13 + [f"u{i}" for i in range(38)]),
    "tok " * 30_000,
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(repeated), failed


def grams(text, buckets):
    words = [np.array([h], np.uint64) for h in rules.word_hashes([(text or "").encode().split()])]
    out = [int((w * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32))[0]) % buckets for w in words]
    return out + [int((rules._mix(a, b) >> np.uint64(32))[0]) % buckets for a, b in zip(words, words[1:])]


def test_against_loops(spark, sf_dir, make):
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(70).collect()
    texts = {r.doc_id: r.text for r in some} | dict(enumerate(HARD, 9000)) | {9500: None}
    good = [k for k in texts if k % 3 == 0]
    labels = make(
        [(k, int(k in good)) for k in texts] * 2 + [(1, None), (None, 1), (10**6, 1)],
        "doc_id long, quality int",
    )
    frame = make([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in rules.apply_rules(frame, labels, buckets=64, prior=50.0).collect()}
    raw, trusted = np.zeros(64), np.zeros(64)
    counts = {}
    for key, text in texts.items():
        counts[key] = np.bincount(grams(text, 64), minlength=64) if (text or "").split() else np.zeros(64)
        raw += counts[key]
        trusted += counts[key] * (key in good)
    assert len(got) == len(texts)
    for key, text in texts.items():
        row, want = got[key], plain(text)
        assert tuple(row)[1:7] == want, (key, text[:40] if text else text)
        own = counts[key]
        other, others = trusted - own * (key in good), raw - own
        share = other.sum() / others.sum()
        weights = np.log((other + 50 * share) / (others + 50) / share)
        score = (own * weights).sum() / max(own.sum(), 1)
        assert math.isclose(row.score, score, abs_tol=1e-9)
        assert row.kept == (not want[5] and row.score >= rules.THRESHOLD)


def test_nothing_trusted_and_no_rows(make):
    labels = make([], "doc_id long, quality int")
    frame = make([(1, "a b " * 40), (1, HARD[8]), (None, HARD[8])], "doc_id long, text string")
    got = rules.apply_rules(frame, labels).collect()
    assert sorted((r.kept, round(r.score, 12)) for r in got) == [(False, 0), (True, 0), (True, 0)]
    assert rules.apply_rules(frame.limit(0), labels).collect() == []


def test_junk_goes_and_clean_stays(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = rules.apply_rules(documents, labels).join(labels, "doc_id").where("not base_failed")
    rows = judged.select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    assert sum(good) >= 0.98 * len(good)


def test_trusted_side_counts_every_trusted_document(spark):
    count = 20_600
    rows = spark.range(count + 400).selectExpr(
        "id AS doc_id", f"CASE WHEN id < {count} THEN 'good text' ELSE 'bad other' END AS text"
    )
    labels = spark.range(count).selectExpr("id AS doc_id", "1 AS quality")
    raw, trusted = np.zeros(64), np.zeros(64)
    for b in grams("good text", 64):
        raw[b] += count
        trusted[b] += count
    for b in grams("bad other", 64):
        raw[b] += 400
    for most in (1 << 20, 10):
        flagged = rules.flagged(rows, labels, "doc_id", "trusted", most)
        got = rules.counted(flagged.select("text", "trusted"), 64)
        assert (got.raw == raw).all() and (got.trusted == trusted).all()


def test_shuffled_ids_and_clashing_names(make):
    rows = [(i, HARD[8] if i % 2 else "u v " * 30, i, "x") for i in range(60)] + [(None, HARD[8], 1, "y")]
    frame = make(rows, "doc_id long, text string, trusted int, trusted_id string")
    labels = make([(i, 1) for i in range(1, 40, 2)], "doc_id long, quality int")
    few, many = (rules.keep_passing(frame, labels, most_ids=n) for n in (100, 3))
    assert few.schema == frame.schema == many.schema
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) and few.count() == 31


def kept_shares(documents, labels, all_labels):
    """Share kept of good documents whose label is given, and of those withheld."""
    judged = rules.apply_rules(documents, labels).join(all_labels.where("quality = 1"), "doc_id")
    given = labels.select("doc_id", F.lit(True).alias("given"))
    rows = judged.join(given, "doc_id", "left").select("given", "kept").collect()
    parts = [[r.kept for r in rows if bool(r.given) == g] for g in (True, False)]
    return [sum(p) / len(p) for p in parts]


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_verdict_does_not_hang_on_a_label_or_the_size(spark, size):
    documents = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet")
    half = labels.where("doc_id % 2 = 0")
    given, withheld = kept_shares(documents, half, labels)
    assert given > 0.85 and abs(given - withheld) < 0.05, (given, withheld)
    judged = rules.apply_rules(documents, labels).join(labels, "doc_id", "left")
    rows = judged.select("quality", "kept").collect()
    shares = {
        q: sum(r.kept for r in rows if r.quality == q) / sum(r.quality == q for r in rows)
        for q in (0, 1, None)
    }
    labelled = [r.kept for r in rows if r.quality is not None]
    assert shares[0] < 0.04 and shares[1] > 0.94
    assert abs(shares[None] - sum(labelled) / len(labelled)) < 0.05


def test_a_corpus_around_the_same_documents_changes_few_verdicts(spark):
    small, large = (spark.read.parquet(f"/root/testdata/{s}/documents.parquet") for s in ("sf0.01", "sf0.1"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    more = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    shift = 10**9
    both = small.unionByName(large.withColumn("doc_id", F.col("doc_id") + shift))
    all_labels = labels.unionByName(more.withColumn("doc_id", F.col("doc_id") + shift))
    alone = {r.doc_id: r.kept for r in rules.apply_rules(small, labels).collect()}
    among = rules.apply_rules(both, all_labels).where(f"doc_id < {shift}").collect()
    changed = sum(alone[r.doc_id] != r.kept for r in among)
    assert changed <= 0.05 * len(among), changed
