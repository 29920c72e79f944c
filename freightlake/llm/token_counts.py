"""Token counts by a two-tier lookup of word lengths, without a shuffle of words.

Words are cut at ASCII blanks, where the tokenizer cuts as well, so a text has
as many tokens as its words have. Tier one is a table of the frequent words and
their lengths, worked out once and broadcast; tier two is a cache in each worker
that encodes what the table misses with the tokenizer's own library.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from freightlake.llm import common

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

# Bounds of the broadcast table: words, and bytes of one word. 32,768 words of
# at most 32 bytes and their lengths are about one megabyte.
TABLE_WORDS = 32_768
WORD_BYTES = 32

# Words that a worker counts at a time, and those it keeps when it has to prune.
SUMMARY_WORDS = 200_000
SUMMARY_KEPT = 8_192

# Words in a worker's cache before it starts anew.
CACHE_WORDS = 400_000

# Bytes of text that a worker takes at a time.
CHUNK = 2_000_000


def split_words(text: str) -> list[str]:
    """Words between ASCII blanks; empty strings stand for repeated blanks.

    Only blanks that the tokenizer drops are cut at, so no token spans a cut.
    """
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


# Words of these letters alone are one word to the tokenizer too, whatever stands
# around them, and stay so in lower case. Marks behind them begin a new one.
_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_MARKS = ".,;:!?|*&$%#)"


@lru_cache(maxsize=4)
def load_tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class Encoder:
    """Ids of words by the tokenizer's library, as little-endian 32-bit numbers."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        described = json.loads(self.tokenizer.to_str())
        suffix = described["model"].get("end_of_word_suffix")
        ending = [i for w, i in vocabulary.items() if suffix and w.endswith(suffix)]
        self.ends[ending] = True
        # Whether capitals are the same to this tokenizer, as it says itself.
        self.lowers = "Lowercase" in json.dumps(described.get("normalizer"))
        self.letters = _LETTERS if ending else re.compile(r"(?!)")

    def _plain(self, words: list[str]) -> list[bytes]:
        """Words of letters, encoded as texts of many and cut behind each last token."""
        texts = [" ".join(words[i : i + 200]) for i in range(0, len(words), 200)]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        flat = np.array([i for e in encoded for i in e.ids], "<u4")
        raw = flat.tobytes()
        cuts = [0, *(4 * (np.flatnonzero(self.ends[flat]) + 1)).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _others(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def learn(self, known: dict, words: list[str], value: Callable = bytes) -> None:
        """Put into ``known`` what ``value`` makes of the ids of each word.

        A word of letters with marks behind it is put together from both parts,
        of which more words consist; ``value`` has to allow for adding them.
        """
        heads, tails = [], []
        for word in words:
            head = word.rstrip(_MARKS)
            if self.letters.fullmatch(head):
                heads.append(head.lower() if self.lowers else head)
                tails.append(word[len(head) :])
            else:
                heads.append(word)
                tails.append("")
        plain, others = [], []
        for part in {*heads, *tails}.difference(known):
            (plain if self.letters.fullmatch(part) else others).append(part)
        known.update(zip(plain, map(value, self._plain(plain)), strict=True))
        known.update(zip(others, map(value, self._others(others)), strict=True))
        for word, head, tail in zip(words, heads, tails, strict=True):
            known[word] = known[head] + known[tail]


class WordIds:
    """Token ids of words, kept for the life of a worker."""

    def __init__(self, path: str) -> None:
        self.encoder = Encoder(path)
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        self.encoder.learn(self.known, list(words.difference(self.known)))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class LengthTable:
    """Two tiers of word lengths: the broadcast table and the worker's cache."""

    def __init__(self, path: str, packed: tuple[bytes, bytes]) -> None:
        words, lengths = packed
        self.encoder = Encoder(path)
        self.frequent = dict(
            zip(words.decode().split("\n"), np.frombuffer(lengths, np.uint8).tolist())
        )
        self.known = dict(self.frequent)

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE_WORDS + len(self.frequent):
            self.known = dict(self.frequent)
        missing = list(words.difference(self.known))
        self.encoder.learn(self.known, missing, lambda raw: len(raw) // 4)


_tables: dict[tuple, LengthTable] = {}


def _length_table(path: str, packed: tuple[bytes, bytes]) -> LengthTable:
    key = (path, hash(packed))
    if key not in _tables:
        _tables.clear()
        _tables[key] = LengthTable(path, packed)
    return _tables[key]


def frequent_words(df: DataFrame, text: str, most: int = TABLE_WORDS) -> list[str]:
    """The most frequent words of all texts, as far as summaries of bounded size tell.

    Each task keeps a lossy count of its words and gives its largest counts, so
    what is shuffled is bounded for a task and words themselves never move.
    """

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in common.slices(batch, text, CHUNK):
                for value in common.text_column(part, text):
                    held.update(split_words(value))
                    if len(held) > SUMMARY_WORDS:
                        held = Counter(dict(held.most_common(SUMMARY_KEPT)))
        held.pop("", None)
        rows = [
            (word, n)
            for word, n in held.most_common(SUMMARY_KEPT)
            if len(word.encode()) <= WORD_BYTES
        ]
        yield pa.RecordBatch.from_pydict(
            {"word": [w for w, _ in rows], "n": pa.array([n for _, n in rows], "int64")}
        )

    counted = common.map_arrow(df.select(text), summaries, "word string, n long")
    top = (
        counted.groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(most)
    )
    return [row.word for row in top.collect()]


def count_tokens(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = WORD_BPE,
    limit: int = 2048,
    table_words: int = TABLE_WORDS,
) -> DataFrame:
    """Bytes and tokens of every whole text.

    Gives ``doc_id, n_bytes, n_tokens, over_limit`` for each row of the input,
    repeated rows included; other columns are left out, whatever their names.
    A null text counts as empty and has no tokens; a null id stays null. The
    broadcast table holds ``table_words`` words at most and changes the time
    only: what it lacks is encoded by the library.
    """
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )
    words = frequent_words(rows, "text", table_words)
    lengths = [
        len(e.ids)
        for e in load_tokenizer(tokenizer).encode_batch_fast(
            words, add_special_tokens=False
        )
    ]
    packed = documents.sparkSession.sparkContext.broadcast(
        ("\n".join(words).encode(), bytes(min(n, 255) for n in lengths))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _length_table(tokenizer, packed.value)
        for part in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            split = [split_words(t) for t in common.text_column(part, "text")]
            lookup.learn(set(chain.from_iterable(split)))
            of = lookup.known.__getitem__
            tokens = [sum(map(of, words)) for words in split]
            sizes = pc.binary_length(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    sizes.cast(pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return common.map_arrow(rows, count, schema)
