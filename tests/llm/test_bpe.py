"""Ids and bytes against the library of the rank files."""

import base64
import random

import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from freightlake.llm import bpe

with open(bpe.RANKS, "rb") as file:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
LIBRARY = tiktoken.Encoding(
    "own", pat_str=bpe.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
DRAWS = random.Random(4)
HARD = [
    "",
    " ",
    "\n\n  \t x",
    "foo\n  bar \n baz\t\tqux  ",
    "It's we're '' 's 't  's",
    "<|endoftext|> a<|endoftext|>",
    "a" * 3001,
    "ab" * 300 + "a",
    "".join(DRAWS.choice("abcdefghij") for _ in range(1500)),
    "\x1c\x1d \x85\xa0 \u2003\u3000wide\u2028line \u180e x",
    "你好世界 \U0001f600\U0001f601 é é 123456 १२३",
    "\x00\x01\x7f",
    "-" * 500 + "=" * 333,
]


def test_hard_texts():
    own = bpe.codec(bpe.RANKS, bpe.PATTERN)
    got = own.encode(HARD)
    for text, ids in zip(HARD, got):
        assert ids.tolist() == LIBRARY.encode_ordinary(text), text[:30]
    assert own.decode(got) == [t.encode() for t in HARD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_texts(texts):
    own = bpe.codec(bpe.RANKS, bpe.PATTERN)
    got = own.encode(texts)
    assert [g.tolist() for g in got] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert own.decode(got) == [t.encode() for t in texts]


def test_cache_that_is_too_small(monkeypatch):
    monkeypatch.setattr(bpe, "GENERATION", 3)
    own = bpe.Codec(bpe.RANKS, bpe.PATTERN)
    for text in [*HARD, "some words, some more words", *HARD]:
        assert own.encode([text, "words some"])[0].tolist() == LIBRARY.encode_ordinary(text)


def test_frames(make, spark, sf_dir):
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in some] + [(i, t) for i, t in enumerate(HARD)]
    given_rows = [*[(a, b, "x") for a, b in rows], (None, None, None)]
    frame = make(given_rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(frame)
    got = bpe.decode(encoded).collect()
    want = [(a, LIBRARY.encode_ordinary(b), b.encode()) for a, b in rows] + [(None, [], b"")]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    found = [(r.doc_id, r.ids, bytes(r.decoded)) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    together = bpe.encode_and_decode(frame).collect()
    assert sorted((r.ids for r in together)) == sorted(r.ids for r in got)
    assert {bytes(r.decoded) for r in together} == {bytes(r.decoded) for r in got}
    empty = bpe.decode(bpe.encode(frame.limit(0)))
    assert empty.columns == ["doc_id", "ids", "decoded"] and empty.count() == 0
    odd = make([(1, None), (2, [5, 999_999])], "doc_id long, ids array<int>")
    found = {r.doc_id: bytes(r.decoded) for r in bpe.decode(odd).collect()}
    assert found == {1: b"", 2: next(k for k, v in RANKS.items() if v == 5)}
