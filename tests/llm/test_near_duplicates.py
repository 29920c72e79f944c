"""Fingerprints, trees, links and components against plain loops."""

import random
import re

import pytest
import xxhash

from freightlake.llm import near_duplicates as near
from freightlake.llm.components import connected_components

DRAWS = random.Random(11)


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    shingles = shingles or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << bit
        for bit in range(64)
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def components(marks, radius=3):
    """Smallest id reachable, for a dictionary from id to fingerprint."""
    parent = {k: k for k in marks}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = list(marks)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (marks[a] ^ marks[b]).bit_count() <= radius and root(a) != root(b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in marks}


def flipped(bits, count):
    for place in DRAWS.sample(range(64), count):
        bits ^= 1 << place
    return bits


def test_tree_finds_all_within_the_radius():
    centre = [DRAWS.getrandbits(64) for _ in range(8)]
    marks = [flipped(DRAWS.choice(centre), DRAWS.randrange(6)) for _ in range(300)]
    tree = near.Tree()
    for m in marks:
        tree.add(m)
    for m in marks[:60]:
        want = [i for i, x in enumerate(marks) if (x ^ m).bit_count() <= 3]
        assert sorted(tree.within(m, 3)) == want


def test_links_lose_no_component(make):
    centre = [0, (1 << 64) - 1] + [DRAWS.getrandbits(64) for _ in range(30)]
    marks = {flipped(DRAWS.choice(centre), DRAWS.randrange(7)) for _ in range(700)}
    marks |= {DRAWS.getrandbits(64) for _ in range(300)}
    signed = [(m - (1 << 64) if m >> 63 else m,) for m in marks]
    links = near.near_links(make(signed, "bits long").repartition(5)).collect()
    want = components({m: m for m in marks})
    parent = {m: m for m in marks}

    def root(m):
        while parent[m] != m:
            m = parent[m]
        return m

    for u, v in links:
        u, v = u % (1 << 64), v % (1 << 64)
        parent[root(u)] = root(v)
    groups, expected = {}, {}
    for m in marks:
        groups.setdefault(root(m), set()).add(m)
        expected.setdefault(want[m], set()).add(m)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    with pytest.raises(ValueError):
        near.near_links(make(signed, "bits long"), 4)


def test_components_of_chains_stars_and_repeats(make):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)]
    links += [(201, 200), (200, 201), (201, 201), (300, 300), (-5, 400)]
    DRAWS.shuffle(links)
    got = connected_components(make(links, "u long, v long").repartition(6)).collect()
    want = {(i, 0) for i in range(1, 61)} | {(100 + i, 100) for i in range(1, 40)}
    assert {tuple(r) for r in got} == want | {(201, 200), (400, -5)}
    assert len(got) == len(want) + 2
    assert connected_components(make([], "u long, v long")).collect() == []


def test_documents_against_loops(spark, sf_dir, make):
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    texts = {r.doc_id: r.text for r in some}
    base = some[3].text
    texts |= {
        7000: "",
        7001: None,
        7002: " \n",
        7003: "One",
        7004: "oNE  two",
        7005: base,
        7006: base + " word",
        7007: "ÄÖ ä É é\x85x \x1c y",
        7008: "w " * 70_000,
        -3: base.upper(),
    }
    rows = [(k, t, 1) for k, t in texts.items()]
    frame = make(rows, "doc_id long, text string, bits int")
    got = near.near_duplicates(frame.repartition(3))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    marks = {k: fingerprint(t) for k, t in texts.items()}
    want = components(marks)
    found = got.collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.fingerprint == f"{marks[r.doc_id]:016x}"
        assert r.component_id == want[r.doc_id], r.doc_id


def test_repeats_nulls_and_nothing(make):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "z y"), (9, "q")]
    got = near.near_duplicates(make(rows, "doc_id long, text string")).collect()
    pairs = sorted(((r.doc_id, r.component_id) for r in got), key=str)
    assert pairs == sorted([(5, 5), (5, 5), (None, 5), (None, None), (9, 9)], key=str)
    assert near.near_duplicates(make([], "doc_id long, text string")).collect() == []
