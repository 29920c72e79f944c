"""Counts against the tokenizer applied to whole texts."""

from freightlake.llm import token_counts

HARD = [
    "",
    "   \n\t ",
    "It's WE'RE don't 12345 ###!!",
    "a<|endoftext|>b <|startoftext|>",
    "tab\tnew\nline\r\nend\x0bvt\x0cff\x1cfs\x85nel\xa0nbsp\u2003em\u3000wide",
    "café ́x e ́ 각 İstanbul ΣΑΣ",
    "z" * 5000,
    "你好 \U0001f600\U0001f600 " * 40,
    "\x00 nul",
    "Word, WORD!! it's. Über|* \xaa\xba\xaa, x\u0301. \u1e9e\u0130 end) (a) a.b,c ... !!! a\u0338| \u00d7,",
]


def test_counts_equal_the_library(make, spark, sf_dir):
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80)
    texts = HARD + [row.text for row in some.collect()] + HARD[:3]
    rows = make(
        [(i, t, "x") for i, t in enumerate(texts)] + [(None, None, None)],
        "doc_id long, text string, n_tokens string",
    )
    library = token_counts.load_tokenizer(token_counts.WORD_BPE)
    want = [
        (i, len(t.encode()), n, n > 100)
        for i, t in enumerate(texts)
        for n in [len(library.encode(t, add_special_tokens=False).ids)]
    ] + [(None, 0, 0, False)]
    for table_words in (0, 5, 1000):
        got = token_counts.count_tokens(rows, limit=100, table_words=table_words)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        key = lambda r: (r[0] is None, r[0] or 0)
        assert sorted((tuple(r) for r in got.collect()), key=key) == want


def test_empty_table(make):
    rows = make([], "doc_id long, text string")
    assert token_counts.count_tokens(rows).collect() == []
