"""Packing against the exact optimum of small cases, pieces against the library."""

import zlib
from functools import lru_cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from freightlake.llm import packing
from freightlake.llm.token_counts import WORD_BPE, load_tokenizer


def optimum(sizes, capacity):
    @lru_cache(None)
    def least(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        best = 1 + least(rest)
        for mask in range(1, 1 << len(rest)):
            inside = [x for i, x in enumerate(rest) if mask >> i & 1]
            if first + sum(inside) <= capacity:
                others = tuple(x for i, x in enumerate(rest) if not mask >> i & 1)
                best = min(best, 1 + least(others))
        return best

    return least(tuple(sorted(sizes)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=7))
def test_bound_is_never_above_the_optimum(sizes):
    best = optimum(sizes, 20)
    assert packing.lower_bound(np.array(sizes, np.int64), 20) <= best
    bins, _ = packing.best_fit_decreasing(np.array(sizes, np.int64), 20)
    assert len(set(bins.tolist())) >= best


def test_best_fit_decreasing_takes_the_tightest_bin():
    sizes = np.array([6, 5, 4, 3, 2], np.int64)
    bins, offsets = packing.best_fit_decreasing(sizes, 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]
    assert packing.lower_bound(np.array([51] * 9), 100) == 9
    assert packing.lower_bound(np.array([34] * 9), 100) == 5


def check_layout(rows, capacity):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_and_layout(spark, sf_dir, make):
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    texts = {r.doc_id: r.text for r in some} | {5000: "", 5001: None, 5002: "word " * 9000}
    rows = make([(k, v, 1) for k, v in texts.items()], "doc_id long, text string, bin int")
    pieces = packing.tokenized_pieces(rows)
    packed = packing.pack(pieces, per_partition=40)
    got = packed.collect()
    library = load_tokenizer(WORD_BPE)
    want = {}
    for key, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            raw = np.array(part, "<u4").tobytes()
            want[key, piece] = (start, len(part), zlib.crc32(raw), part)
    found = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32, r.ids) for r in got}
    assert found == want and len(got) == len(want)
    used = check_layout(got, 4096)
    assert (used, packing.certificate(packed)[0]) == (used, used)
    assert used <= packing.certificate(packed)[1] + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for row in got:
        assert whole[row.sequence_id][row.offset : row.offset + row.length] == row.ids


def test_ties_repeats_nulls_and_nothing(make):
    rows = [(1, 0, 10)] * 30 + [(None, 0, 10)] * 3 + [(2, 0, 40), (3, 0, 39), (4, None, 1)]
    frame = make(rows, "doc_id long, piece int, length long")
    packed = packing.pack(frame, capacity=40, per_partition=5, gap=1)
    got = packed.collect()
    assert len(got) == len(rows) and check_layout(got, 40) <= 11
    assert packing.pack(frame.limit(0), capacity=40).collect() == []
    none = make([], "doc_id long, text string")
    assert packing.tokenized_pieces(none).collect() == []


def test_certified_partitions_run_once(make, monkeypatch):
    stored = []
    plain = packing.common.stored_once

    def recorded(frame, name):
        stored.append(name)
        return plain(frame, name)

    monkeypatch.setattr(packing.common, "stored_once", recorded)
    rows = [(i, 0, 2049) for i in range(40)]
    got = packing.pack(make(rows, "doc_id long, piece int, length long"), per_partition=10).collect()
    assert check_layout(got, 4096) == 40
    assert all(r.partition_sequences == r.partition_bound for r in got)
    assert stored == ["pieces", "packed-0"]


def test_exchange_comes_close_to_one_partition(make):
    draws = np.random.default_rng(11)
    rows = [(i, 0, int(n)) for i, n in enumerate(np.minimum(draws.lognormal(5.5, 1.2, 3000) + 1, 4096))]
    frame = make(rows, "doc_id long, piece int, length long")
    lengths = np.array([n for *_, n in rows])
    bound = packing.lower_bound(lengths, 4096)
    one, many = (
        check_layout(packing.pack(frame, per_partition=n).collect(), 4096) for n in (10_000, 300)
    )
    assert one <= bound + 1 and many <= 1.005 * bound + 2
