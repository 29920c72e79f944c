"""Document fingerprints by consistent weighted sampling.

A text is a bag of weighted terms: its neighbouring word pairs, its first and
its last word, each with the number of times it occurs. For every sample k and
term, gamma draws r and c and a uniform draw b, the same for that term in every
text, give

    t = floor(ln(weight) / r + b),    a = ln(c) - r * (t - b) - r,

and the sample is the term with the least a. Two texts have the same sample with
the probability of their generalised Jaccard similarity, the sum of the smaller
weights over the sum of the larger ones. The least a itself stands for the pair
(term, t) in the fingerprint.

The draws of a term follow from its 64-bit hash alone: gamma draws of shape 2 are
logarithms of products of two uniform ones, and these are pieces of the hash mixed
with a number for each sample. No two terms share draws unless their hashes do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common

SAMPLES = 64
SEED = 20_240_607

# Words whose hashes a worker keeps, words it signs at a time, terms whose draws it
# holds at a time, and characters of the texts that it holds at a time.
CACHE_WORDS = 300_000
CHUNK_WORDS = 40_000
PART_TERMS = 1 << 15
CACHED = 1 << 15
CHUNK_CHARACTERS = 4_000_000

_FIRST, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Mixes in place."""
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x9FB21C651E98DF25)
    values ^= values >> np.uint64(32)
    return values


def _uniform(values: np.ndarray, piece: int, out: np.ndarray) -> None:
    """One of three pieces of 21 bits as a number between 0 and 1."""
    bits = (values >> np.uint64(21 * piece) if piece else values).astype(np.uint32)
    bits &= np.uint32((1 << 21) - 1)
    out[:] = bits.view(np.int32)
    out += np.float32(0.5)
    out *= np.float32(2.0**-21)


class Sampler:
    """Draws of terms, and signatures of texts by them."""

    def __init__(self, samples: int, seed: int) -> None:
        self.samples = samples
        draws = np.random.Generator(np.random.PCG64(seed))
        self.flips = draws.integers(0, 1 << 64, samples, np.uint64)
        self.words = common.WordHashes()

    def draws(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``r``, ``b`` and, for a weight of one, ``a``: rows are terms."""
        shape = (len(hashes), self.samples)
        r, b, a = (np.empty(shape, np.float32) for _ in range(3))
        # A few terms at a time stay within a processor's cache.
        step = max(1, CACHED // self.samples)
        for at in range(0, len(hashes), step):
            part = slice(at, at + step)
            self._draw(hashes[part], r[part], b[part], a[part])
        return r, b, a

    def _draw(self, hashes: np.ndarray, r: np.ndarray, b: np.ndarray, a: np.ndarray) -> None:
        first = _mixed(hashes[:, None] ^ self.flips[None, :])
        other = np.empty_like(r)
        _uniform(first, 0, r)
        _uniform(first, 1, other)
        r *= other
        np.negative(np.log(r, out=r), out=r)
        _uniform(first, 2, a)
        first += np.uint64(0x9E3779B97F4A7C15)
        second = _mixed(first)
        _uniform(second, 0, other)
        _uniform(second, 1, b)
        a *= other
        # ln(weight) is 0 then, so t is 0 and a is ln(c) - r (1 - b).
        np.log(np.negative(np.log(a, out=a), out=a), out=a)
        np.subtract(np.float32(1), b, out=other)
        other *= r
        a -= other

    def _hashes(self, split: list[list[bytes]]) -> np.ndarray:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        hashed = map(self.words.__getitem__, chain.from_iterable(split))
        return np.fromiter(hashed, np.uint64, sum(map(len, split)))

    def _terms(self, split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text of every word pair; n words give n + 1 pairs."""
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        hashes = self._hashes(split)
        ends = np.cumsum(sizes + 1)
        starts = ends - sizes - 1
        left = np.empty(len(hashes) + len(split), np.uint64)
        right = np.empty_like(left)
        inner = np.ones(len(left), bool)
        inner[starts] = False
        left[inner], left[starts] = hashes, _FIRST
        inner[starts] = True
        inner[ends - 1] = False
        right[inner], right[ends - 1] = hashes, _LAST
        mixed = left * np.uint64(0xFF51AFD7ED558CCD) + right * np.uint64(0xC4CEB9FE1A85EC53)
        mixed ^= mixed >> np.uint64(33)
        mixed *= np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(29)
        return mixed, np.repeat(np.arange(len(split)), sizes + 1)

    def _signed(self, split: list[list[bytes]]) -> np.ndarray:
        hashes, of = self._terms(split)
        terms, rows = np.unique(hashes, return_inverse=True)
        keys, weights = np.unique(of * len(terms) + rows, return_counts=True)
        # Parts bound the memory of texts with very many terms.
        least = np.full((len(split), self.samples), np.inf, np.float32)
        for at in range(0, len(keys), PART_TERMS):
            part = keys[at : at + PART_TERMS]
            used, own = np.unique(part % len(terms), return_inverse=True)
            r, b, single = self.draws(terms[used])
            a = single[own]
            heavy = np.flatnonzero(weights[at : at + PART_TERMS] > 1)
            if len(heavy):
                r, b = r[own[heavy]], b[own[heavy]]
                ln_w = np.log(weights[at + heavy].astype(np.float32))[:, None]
                a[heavy] -= r * np.floor(ln_w / r + b)
            texts, first = np.unique(part // len(terms), return_index=True)
            lowest = np.minimum.reduceat(a, first, axis=0)
            least[texts] = np.minimum(least[texts], lowest)
        return least

    def signatures(self, texts: list[bytes]) -> np.ndarray:
        """Sixteen bits for each sample, a row for each text."""
        split = [t.split() for t in texts]
        out = np.empty((len(texts), self.samples), np.uint16)
        for start, end in common.chunks(map(len, split), CHUNK_WORDS):
            bits = self._signed(split[start:end]).view(np.uint32)
            out[start:end] = (bits * np.uint32(2654435761)) >> np.uint32(16)
        return out


@lru_cache(maxsize=2)
def sampler(samples: int, seed: int) -> Sampler:
    return Sampler(samples, seed)


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal samples, which estimates the generalised Jaccard similarity."""
    return (left == right).mean(axis=1)


def hexadecimal(signatures: np.ndarray) -> list[str]:
    raw = signatures.astype(">u2").tobytes().hex()
    width = 4 * signatures.shape[1]
    return [raw[i : i + width] for i in range(0, len(raw), width)]


def fingerprint(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    samples: int = SAMPLES,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, fingerprint`` of every row, in place and without a shuffle.

    A null or empty text has one term, "no words", so empty texts are alike and
    like nothing else. Repeated rows are kept; other columns are left out.
    """
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(samples, seed)
        for batch in batches:
            signed = own.signatures(common.byte_column(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(hexadecimal(signed), pa.string())],
                ["doc_id", "fingerprint"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(rows, sign, f"doc_id {kind}, fingerprint string")


def _in_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows dealt by ranges of ids; each block also gets the first row of the next.

    The ends of the ranges are quantiles of the ids, so they and the first ids of
    the blocks are ``blocks`` values at most, whatever the size of the table. Null
    ids come last.
    """
    inner = [i / blocks for i in range(blocks - 1, 0, -1)]
    cuts = rows.agg(F.percentile_approx("doc_id", inner, 10_000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    block = F.lit(0)
    if cuts:
        above = F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut >= F.col("doc_id"))
        block = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(F.size(above))
    dealt = rows.withColumn("block", block)
    heads = {
        row.block: row.head
        for row in dealt.groupBy("block").agg(F.max("doc_id").alias("head")).collect()
    }
    before = dict(zip(sorted(heads), [max(heads, default=0), *sorted(heads)]))
    kind = dealt.schema["doc_id"].dataType
    places = range(len(cuts) + 1)
    head = F.array(*[F.lit(heads.get(b)).cast(kind) for b in places])[F.col("block")]
    target = F.array(*[F.lit(before.get(b, b)) for b in places])[F.col("block")]
    targets = F.when(
        F.col("doc_id").eqNullSafe(head), F.array(F.col("block"), target)
    ).otherwise(F.array(F.col("block")))
    return dealt.withColumn("targets", targets)


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by the first as many characters of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(part: list[tuple], own: Sampler, kind: pa.DataType) -> pa.RecordBatch:
    """Results of neighbouring rows (id, text, copy, block), all but the last one.

    A row is complete once the row after it is known; copies only follow.
    """
    texts = [row[1] for row in part]
    full = [
        i
        for i, (row, after) in enumerate(zip(part, part[1:]))
        if row[2] == 0 and row[3] == after[3]
    ]
    raw = [edited(texts[i], texts[i + 1]).encode() for i in full]
    # A text and its edited form side by side, as they share most of their terms.
    changed = dict(zip(full, raw))
    both, places = [], []
    for i, text in enumerate(texts):
        places.append(len(both))
        both += [text.encode(), changed[i]] if i in changed else [text.encode()]
    signed = own.signatures(both)
    plain, other = signed[places], signed[[places[i] + 1 for i in full]]
    mine, following = plain[full], plain[[i + 1 for i in full]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part[i][0] for i in full], kind),
            pa.array([len(texts[i]) for i in full], pa.int64()),
            pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
            pa.array(hexadecimal(mine), pa.string()),
            pa.array(hexadecimal(other), pa.string()),
            pa.array(likeness(mine, other), pa.float64()),
            pa.array(likeness(mine, following), pa.float64()),
        ],
        NAMES,
    )


def with_neighbours(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    blocks: int | None = None,
    samples: int = SAMPLES,
    seed: int = SEED,
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how alike they are.

    The next document is the one with the next smaller id; after the last comes
    the first, and a lone document follows itself. Of rows with one id the order
    is that of their texts' hashes; null ids come last. Texts are shuffled once,
    by ranges of ids, and each range is read in order, a batch at a time.
    Gives ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``; a null text is empty.
    """
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )
    if blocks is None:
        blocks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        _in_blocks(rows, blocks)
        .select("doc_id", "text", F.posexplode("targets").alias("copy", "block"))
        .repartitionById(blocks, F.col("block"))
        .sortWithinPartitions(
            "block", "copy", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text"
        )
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(samples, seed)
        held: tuple | None = None
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_pylist()
            for first, last in common.chunks(sizes, CHUNK_CHARACTERS):
                new = zip(*batch.slice(first, last - first).to_pydict().values(), strict=True)
                part = ([held] if held else []) + list(new)
                held = part[-1]
                yield _compared(part, own, batch.schema.field("doc_id").type)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return common.map_arrow(ordered, compare, schema)


NAMES = [
    "doc_id",
    "n_chars",
    "edited_sha256",
    "fingerprint",
    "edited_fingerprint",
    "near_edited",
    "near_next",
]
