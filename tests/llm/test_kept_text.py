"""The text that op4_suffix_dedup leaves, beside its digests."""

import hashlib
import random

from freightlake.llm import queries, repeats

DRAWS = random.Random(47)


def some_words(count):
    return " ".join("".join(DRAWS.choices("abcdefghij", k=DRAWS.randrange(3, 9))) for _ in range(count))


def test_query_shows_what_is_left(make, spark, tmp_path):
    long, short = some_words(90), " ".join(DRAWS.choices(["ab", "cde", "fghi"], k=55))
    assert len(long) > 400 > len(short) > 150
    # Equal up to the second of three bytes of the last sign, 401 bytes in all.
    wide = "€" * 133
    texts = {
        1: f"{some_words(20)}|{long}|{some_words(20)}",
        2: f"{some_words(30)}#{long}#{some_words(9)}",
        3: f"{some_words(20)}|{short}|{some_words(20)}",
        4: f"{some_words(30)}#{short}#{some_words(9)}",
        5: some_words(200),
        6: f"x{wide}€y",
        7: f"z{wide}₭w",
        8: "",
        9: None,
    }
    left = {k: t or "" for k, t in texts.items()} | {6: "xy", 7: "zw"}
    for k in (1, 2):
        left[k] = left[k].replace(long, "")
    bytes_left = {k: t.encode() for k, t in left.items()} | {6: b"x\xacy", 7: b"z\xadw"}
    frame = make(list(texts.items()), "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op4_suffix_dedup(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in got} == left
    assert len(got) == len(texts)
    for r in got:
        kept = bytes_left[r.doc_id]
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert r.n_bytes - r.n_removed == len(kept)


def test_text_beside_bytes(make):
    passage = some_words(4)
    rows = [(1, f"a{passage}b"), (2, f"c{passage}d"), (3, "alone")]
    frame = make(rows, "doc_id long, text string")
    got = repeats.remove_repeats(frame, length=len(passage), with_text=True).collect()
    assert sorted((r.doc_id, bytes(r.kept), r.text) for r in got) == [
        (1, b"ab", "ab"),
        (2, b"cd", "cd"),
        (3, b"alone", "alone"),
    ]
