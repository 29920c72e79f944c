"""Quality rules: base rules, and a likelihood ratio of hashed word n-grams.

Words and word pairs are hashed to buckets. Two multinomials over the buckets
are estimated, of the raw corpus from all documents and of the trusted ones, each
bucket smoothed by ``PRIOR`` n-grams that are dealt as all n-grams are; a bucket of
which little is known is neutral, however large the corpus. A document is judged
by the counts of all others: its own n-grams are taken out of both sides, so that
it makes no difference whether it is itself among the trusted ones. Its score is
the mean over its n-grams of the logarithm of the trusted over the raw probability;
it is kept if it passes the base rules and scores ``threshold`` or more. Nothing is
drawn at random.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common
from freightlake.operators.sizing import bounded

# Buckets, the same for every corpus, the strength of the smoothing of each in
# n-grams, and the least score that is kept.
BUCKETS = 1 << 16
PRIOR = 64.0
THRESHOLD = -0.08

# Trusted ids up to which they go to every task; more meet the texts in a shuffle.
MOST_IDS = 1 << 20

# Words whose hashes a worker keeps, and bytes of text it takes at a time.
CACHE_WORDS = 200_000
CHUNK = 2_000_000

_SYMBOLS, _INNER = b"#*$%&|<>", bytes(range(0x80, 0xC0))


@lru_cache(maxsize=1)
def _known() -> common.WordHashes:
    return common.WordHashes()


def word_hashes(split: list[list[bytes]]) -> np.ndarray:
    """Hashes of all words of some texts, one text after the other."""
    known = _known()
    if len(known) > CACHE_WORDS:
        known.clear()
    hashed = map(known.__getitem__, chain.from_iterable(split))
    return np.fromiter(hashed, np.uint64, sum(map(len, split)))


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0xFF51AFD7ED558CCD) + right * np.uint64(0xC4CEB9FE1A85EC53)
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0x9FB21C651E98DF25)


class Grams:
    """Hashed n-grams of some texts: buckets of words and pairs, and their texts."""

    def __init__(self, split: list[list[bytes]], buckets: int) -> None:
        self.sizes = np.fromiter(map(len, split), np.int64, len(split))
        self.text = np.repeat(np.arange(len(split)), self.sizes)
        self.hashes = word_hashes(split)
        self.inside = self.text[1:] == self.text[:-1]
        pairs = _mix(self.hashes[:-1], self.hashes[1:])[self.inside]
        words = self.hashes * np.uint64(0x9E3779B97F4A7C15)
        both = np.concatenate([words, pairs]) >> np.uint64(32)
        self.buckets = (both % np.uint64(buckets)).astype(np.int64)
        self.of = np.concatenate([self.text, self.text[1:][self.inside]])

    def repeated_words(self) -> np.ndarray:
        """Words of each text in three-word windows that the text has twice or more."""
        out = np.zeros(len(self.sizes), np.int64)
        if len(self.hashes) < 3:
            return out
        whole = self.text[2:] == self.text[:-2]
        starts = np.flatnonzero(whole)
        windows = _mix(_mix(self.hashes[:-2], self.hashes[1:-1]), self.hashes[2:])[starts]
        owner = self.text[starts].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        _, same, counts = np.unique(
            windows ^ owner, return_inverse=True, return_counts=True
        )
        starts = starts[counts[same] > 1]
        covered = np.zeros(len(self.hashes), bool)
        for step in range(3):
            covered[starts + step] = True
        return np.bincount(self.text[covered], minlength=len(out))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids whose labels all say quality 1."""
    return (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"))
        .where("least = 1")
        .select("doc_id")
    )


def flagged(
    documents: DataFrame, labels: DataFrame, doc_id: str, flag: str, most: int = MOST_IDS
) -> DataFrame:
    """``documents`` with a boolean ``flag``: whether the id is a trusted one.

    Texts stay where they are unless there are more than ``most`` trusted ids.
    """
    ids = trusted_ids(labels).select(F.col("doc_id").alias(f"{flag}_id"))
    few = bounded(ids, most)
    # Texts are not sorted for the join: a task holds its share of the ids.
    side = ids.hint("shuffle_hash") if few is None else F.broadcast(few)
    met = documents.join(side, F.col(f"`{doc_id}`") == F.col(f"{flag}_id"), "left")
    return met.withColumn(flag, F.col(f"{flag}_id").isNotNull()).drop(f"{flag}_id")


@dataclass(frozen=True)
class Counts:
    """N-grams of all documents and of the trusted ones by bucket."""

    raw: np.ndarray
    trusted: np.ndarray


def counted(rows: DataFrame, buckets: int = BUCKETS) -> Counts:
    """Counts of all ``rows`` (``text, trusted``).

    Tasks send sums for each bucket, so what is shuffled does not depend on the
    length of texts, and the result is twice ``buckets`` numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), np.int64)
        for part in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            trusted = np.array(part.column("trusted").to_pylist(), bool)
            raw = common.byte_column(part, "text")
            grams = Grams([t.split() for t in raw], buckets)
            sums[0] += np.bincount(grams.buckets, minlength=buckets)
            chosen = grams.buckets[trusted[grams.of]]
            sums[1] += np.bincount(chosen, minlength=buckets)
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_pydict(
            {"bucket": used, "raw": sums[0][used], "trusted": sums[1][used]}
        )

    by_task = common.map_arrow(rows, count, "bucket long, raw long, trusted long")
    sums = by_task.groupBy("bucket").agg(F.sum("raw"), F.sum("trusted")).toArrow()
    raw, trusted = np.zeros(buckets), np.zeros(buckets)
    bucket, n_raw, n_trusted = (c.to_numpy() for c in sums.columns)
    raw[bucket] = n_raw
    trusted[bucket] = n_trusted
    return Counts(raw, trusted)


def scores(grams: Grams, trusted: np.ndarray, counts: Counts, prior: float) -> np.ndarray:
    """Mean logarithm of the ratio of each text, without its own part of the counts.

    0 where no n-grams, or no trusted ones, are left.
    """
    texts, buckets = len(grams.sizes), len(counts.raw)
    keys, n = np.unique(grams.of * buckets + grams.buckets, return_counts=True)
    of, bucket = keys // buckets, keys % buckets
    size = np.bincount(of, n, texts)
    own = n * trusted[of]
    total = counts.trusted.sum() - size * trusted
    share = np.divide(total, counts.raw.sum() - size, out=np.zeros(texts), where=total > 0)
    usable = share[of] > 0
    of, bucket, n, own = of[usable], bucket[usable], n[usable], own[usable]
    above = counts.trusted[bucket] - own + prior * share[of]
    below = (counts.raw[bucket] - n + prior) * share[of]
    return np.bincount(of, n * np.log(above / below), texts) / np.maximum(size, 1)


@dataclass(frozen=True)
class Limits:
    """What the base rules ask of a text, and the least score that is kept."""

    threshold: float = THRESHOLD
    least_words: int = 50
    most_repeated: int = 50


def judge(
    raw: list[bytes], trusted: np.ndarray, counts: Counts, limits: Limits, prior: float
) -> dict[str, np.ndarray]:
    """Counts, score and verdict of some texts, by column."""
    split = [t.split() for t in raw]
    grams = Grams(split, len(counts.raw))
    score = scores(grams, trusted, counts, prior)
    # Bytes that go on a character are no code points of their own.
    chars = [sum(map(len, words)) for words in split]
    inner = [len(t) - len(t.translate(None, _INNER)) for t in raw]
    symbols = [len(t) - len(t.translate(None, _SYMBOLS)) for t in raw]
    repeated = grams.repeated_words()
    full = [[x for x in t.split(b"\n") if x.strip()] for t in raw]
    failed = (grams.sizes < limits.least_words) | (
        100 * repeated > limits.most_repeated * grams.sizes
    )
    return {
        "n_words": grams.sizes,
        "word_chars": np.array(chars, np.int64) - np.array(inner, np.int64),
        "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in full], np.int64),
        "n_repeat_words": repeated,
        "base_failed": failed,
        "score": score,
        "kept": ~failed & (score >= limits.threshold),
    }


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )


def apply_rules(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    limits: Limits = Limits(),
    buckets: int = BUCKETS,
    prior: float = PRIOR,
    most_ids: int = MOST_IDS,
) -> DataFrame:
    """Counts, verdict and score of every document, a row for each row.

    Gives ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score, kept``. ``labels`` has ``doc_id`` and ``quality``; the
    trusted documents are all those with quality 1, and each row is judged without
    its own n-grams. A text without words, null ones included, scores 0 and fails the
    base rules. Without any other trusted document a score is 0, and the base rules
    alone decide. Rows of one id are each judged by their own text; other columns are
    left out.
    """
    rows = flagged(_rows(documents, doc_id, text), labels, "doc_id", "trusted", most_ids)
    counts = counted(rows.select("text", "trusted"), buckets)
    shared = documents.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            trusted = np.array(part.column("trusted").to_pylist(), bool)
            raw = common.byte_column(part, "text")
            found = judge(raw, trusted, shared.value, limits, prior)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *map(pa.array, found.values())],
                ["doc_id", *found],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(
        rows,
        run,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, base_failed boolean, score double, "
        "kept boolean",
    )


def keep_passing(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    limits: Limits = Limits(),
    buckets: int = BUCKETS,
    prior: float = PRIOR,
    most_ids: int = MOST_IDS,
) -> DataFrame:
    """All columns of the rows that ``apply_rules`` keeps."""
    flag = "trusted"
    while any(c.startswith(flag) for c in documents.columns):
        flag += "_"
    marked = flagged(documents, labels, doc_id, flag, most_ids)
    rows = marked.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.col(flag).alias("trusted"))
    counts = counted(rows, buckets)
    shared = documents.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in common.slices(b, text, CHUNK)):
            trusted = np.array(part.column(flag).to_pylist(), bool)
            raw = [t or b"" for t in common.byte_column(part, text)]
            kept = pa.array(judge(raw, trusted, shared.value, limits, prior)["kept"])
            yield part.drop_columns([flag]).filter(kept)

    return common.map_arrow(marked, run, documents.schema)
