"""Alignment against the longest common subsequence, statements in noisy texts."""

import random
import re
from functools import lru_cache

from hypothesis import given, settings
from hypothesis import strategies as st

from freightlake.llm import licenses

DRAWS = random.Random(2)
LISTED = tuple((n, t) for n, some in licenses.TEMPLATES.items() for t in some)
ALL = licenses.templates_of(LISTED, licenses.COVERAGE)


def longest_common(a, b):
    @lru_cache(None)
    def size(i, j):
        if i == len(a) or j == len(b):
            return 0
        if a[i] == b[j]:
            return 1 + size(i + 1, j + 1)
        return max(size(i + 1, j), size(i, j + 1))

    return size(0, 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=12), st.lists(st.sampled_from("abcdefgh"), max_size=12))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x < y and z < w for (x, z), (y, w) in zip(pairs, pairs[1:]))
    assert len(pairs) <= longest_common(tuple(a), tuple(b))
    if set(a) & set(b):
        assert pairs


@given(st.permutations(range(10)))
def test_increasing_is_longest(order):
    pairs = list(enumerate(order))
    got = licenses.increasing(pairs)
    best = longest_common(tuple(order), tuple(sorted(order)))
    assert len(got) == best and all(a[1] < b[1] for a, b in zip(got, got[1:]))


def test_words_changed_in_a_notice_lower_its_coverage():
    words = licenses.words_of(licenses.TEMPLATES["MIT"][1])[0]
    for changed in range(0, len(words), 7):
        other = list(words)
        for place in DRAWS.sample(range(len(words)), changed):
            other[place] = f"zz{place}"
        pairs = licenses.align(other, words)
        assert len(pairs) == longest_common(tuple(other), tuple(words)) == len(words) - changed


def test_a_text_without_marks_cannot_reach_the_coverage():
    for t in ALL:
        rest = [w for w in t.words if w not in t.marks]
        assert len(rest) < t.least


def noise(count):
    return " ".join(DRAWS.choice(("the", "of", "under", "this")) + str(i) for i in range(count))


def test_every_template_is_found_in_place():
    for name, text in LISTED:
        whole = f"{noise(30)}.\n{text.upper()}\n{noise(40)}"
        found = licenses.find(whole, ALL)
        assert [f[0] for f in found] == [name], (name, found)
        assert whole[found[0][1] : found[0][2]] == text.upper().rstrip(".")
        assert found[0][5] == 1.0


def test_repeated_statements_and_near_names():
    text = "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0. " * 3
    assert [f[0] for f in licenses.find(text, ALL)] == ["CC-BY-4.0", "CC-BY-NC-4.0"] * 3
    gpl = "This work is licensed under the GNU General Public License, version 2."
    assert [f[0] for f in licenses.find(gpl, ALL)] == ["GPL-2.0"]
    assert licenses.find("a license to use the word under", ALL) == []
    assert licenses.find("license " * 20_000, ALL) == []


def test_frames(make, spark, sf_dir):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License.")]
    rows += [(None, "Licensed under the Apache License, Version 2.0"), (2, None), (3, "")]
    frame = make([(a, b, "x") for a, b in rows], "doc_id long, text string, license string")
    got = licenses.scan(frame).collect()
    assert sorted((str(r.doc_id), r.license) for r in got) == [
        ("1", "MIT"),
        ("1", "MIT"),
        ("None", "Apache-2.0"),
    ]
    assert licenses.scan(frame.limit(0)).collect() == []
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id for r in licenses.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    lines = ("Released under the MIT License", "Licensed under the Apache License, Version 2.0")
    assert found >= {d.doc_id for d in documents if any(x in (d.text or "") for x in lines)}


def test_each_notice_against_its_neighbours():
    texts = {name: licenses.TEMPLATES[name][-1] for name in ("GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "AGPL-3.0")}
    for name, text in texts.items():
        found = licenses.find(f"{noise(20)} {text}. {noise(20)}", ALL)
        assert [f[0] for f in found] == [name], found
        # Without its version a notice is none of them.
        bare = re.sub(r"version [0-9.]+", "version", text)
        assert licenses.find(bare, ALL) == []
    for clause in "23":
        found = licenses.find(f"Released under the BSD {clause}-Clause License", ALL)
        assert [f[0] for f in found] == [f"BSD-{clause}-Clause"]
    assert licenses.find("Released under the BSD 4-Clause License", ALL) == []


def test_inserted_words_do_not_lower_coverage():
    words = licenses.TEMPLATES["MIT"][1].split()
    for count in (5, 12, 20, 30):
        for seed in range(6):
            draws = random.Random(seed)
            other = list(words)
            place = draws.randrange(1, len(words))
            if seed % 2:
                other[place:place] = [f"zz{i}" for i in range(count)]
            else:
                for i in range(count):
                    other.insert(draws.randrange(1, len(other)), f"zz{i}")
            text = " ".join(other)
            whole = f"{noise(25)} {text} {noise(25)}"
            found = licenses.find(whole, ALL)
            assert [(f[0], f[5]) for f in found] == [("MIT", 1.0)], (count, seed, found)
            assert whole[found[0][1] : found[0][2]] == text


def test_too_many_words_between_are_no_statement():
    words = licenses.TEMPLATES["MIT"][1].split()
    thin = " ".join(f"{w} x{i} y{i}" for i, w in enumerate(words))
    assert licenses.find(thin, ALL) == []
