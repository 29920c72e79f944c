"""Document quality by a linear-chain conditional random field over lines.

Every line that is not blank is good or bad. Its features are shares of kinds of
characters and words in the line itself, the line before and the line after; the
chain adds weights for neighbouring labels. Forward-backward gives each line's
probability of being good, and a document's quality is their mean weighted by
length, put on a scale where 0.5 parts the two labels of documents.

Labels are known for documents only. Lines of good documents are taken as good;
in bad documents those are bad that a logistic regression, fitted to the labels
of whole documents, calls bad, and at least the worst line is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common

# Bounds of the sample that the model is fitted to.
SAMPLE = 4_000
SAMPLE_CHARACTERS = 100_000
SAMPLE_LINES = 2_000
SEED_STEPS, CHAIN_STEPS = 150, 150

# Bytes of text that a worker takes at a time.
CHUNK = 2_000_000

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKUP = b"#*$%&|<>{}[]~^=_\\/+@"
_LOUD = b"!?"
_HIGH = bytes(range(128, 256))
_COLUMNS = b"|\t;"
OWN = 16


def line_features(line: bytes, seen: bool) -> tuple[float, ...]:
    """What a line looks like; ``seen`` tells that an earlier line is equal."""
    size = len(line)
    words = line.split()
    count = len(words)
    different = len(set(words))
    letters = size - len(line.translate(None, _UPPER + _LOWER + _HIGH))
    upper = size - len(line.translate(None, _UPPER))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    kept = size - len(line.translate(None, b" "))
    return (
        (size - len(line.translate(None, _MARKUP))) / size,
        min(1.0, 10 * (size - len(line.translate(None, _MARKUP))) / size),
        upper / max(letters, 1),
        float(upper > 0.5 * letters),
        (size - len(line.translate(None, _DIGITS))) / size,
        min(1.0, 10 * (size - len(line.translate(None, _LOUD))) / size),
        min(1.0, 10 * (size - len(line.translate(None, _COLUMNS))) / size),
        math.log1p((size - kept) / count) if count else 0.0,
        1.0 - different / count if count else 0.0,
        repeats / count if count else 0.0,
        math.log1p(count) / 5,
        float(count < 3),
        float(line.rstrip()[-1:] in (b".", b"!", b"?", b":")),
        float(seen),
        1.0 - letters / max(size - kept, 1),
        (size - len(line.translate(None, _HIGH))) / size,
    )


@dataclass
class Lines:
    """Lines of some texts: features with those of neighbours, lengths, bounds."""

    features: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of a line, of the line before, of the line after, and a constant.

    The line that is missing at an end counts as like the line itself.
    """
    ends = np.cumsum(counts)
    first = (ends - counts)[counts > 0]
    before, after = np.arange(len(own)) - 1, np.arange(len(own)) + 1
    before[first], after[ends[counts > 0] - 1] = first, ends[counts > 0] - 1
    one = np.ones((len(own), 1))
    return np.hstack([own, own[before], own[after], one])


def read_lines(texts: list[bytes]) -> Lines:
    own, lengths, counts = [], [], []
    for text in texts:
        seen: set[bytes] = set()
        held = 0
        for line in text.split(b"\n"):
            if not line.strip():
                continue
            own.append(line_features(line, line in seen))
            seen.add(line)
            lengths.append(len(line))
            held += 1
        counts.append(held)
    features = np.array(own, np.float64).reshape(len(own), OWN)
    sizes = np.array(counts, np.int64)
    return Lines(with_neighbours(features, sizes), np.array(lengths, np.float64), sizes)


def forward_backward(
    unary: np.ndarray, transitions: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of chains of two labels, side by side.

    ``unary`` is the score of good over bad of all lines. Gives the probability
    of good for each line, the expected number of each pair of labels over all
    chains, and the logarithm of the partition function of each chain.
    """
    starts = np.cumsum(counts) - counts
    # Longest first, so the chains that go on are always the first few.
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    at, size = starts[order], counts[order]
    steps = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(steps), side="left")
    score = np.stack([np.zeros_like(unary), unary], axis=1)
    forward, backward = np.empty_like(score), np.empty_like(score)
    if steps:
        forward[at] = score[at]
    for t in range(1, steps):
        here = at[: alive[t]] + t
        sums = forward[here - 1][:, :, None] + transitions
        forward[here] = np.logaddexp(sums[:, 0], sums[:, 1]) + score[here]
    backward[at + size - 1] = 0.0
    pairs = np.zeros((2, 2))
    total = np.logaddexp(*forward[at + size - 1].T)
    for t in range(steps - 1, 0, -1):
        here = at[: alive[t]] + t
        message = (score[here] + backward[here])[:, None, :] + transitions
        backward[here - 1] = np.logaddexp(message[:, :, 0], message[:, :, 1])
        joint = forward[here - 1][:, :, None] + message - total[: alive[t], None, None]
        pairs += np.exp(joint).sum(axis=0)
    both = forward + backward
    marginal = 1.0 / (1.0 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    logz = np.zeros(len(counts))
    logz[order] = total
    return marginal, pairs, logz


def _adam(gradient, start: np.ndarray, steps: int, rate: float = 0.1) -> np.ndarray:
    """Full-batch descent with adaptive steps; the same numbers on every run."""
    point, mean, square = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, steps + 1):
        slope = gradient(point)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        fixed = mean / (1 - 0.9**step)
        point = point - rate * fixed / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return point


@dataclass
class Model:
    """Weights of features and transitions, and the scale of documents' scores."""

    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    offset: float
    prior: float

    def marginals(self, lines: Lines) -> np.ndarray:
        unary = lines.features @ self.weights
        return forward_backward(unary, self.transitions, lines.counts)[0]

    def score(self, lines: Lines) -> np.ndarray:
        """Quality from 0 to 1; documents without lines get the share of good ones."""
        quality = weighted_mean(self.marginals(lines), lines)
        score = 1.0 / (1.0 + np.exp(-(self.slope * quality + self.offset)))
        return np.where(lines.counts > 0, score, self.prior)


def weighted_mean(values: np.ndarray, lines: Lines) -> np.ndarray:
    owner = np.repeat(np.arange(len(lines.counts)), lines.counts)
    sums = np.bincount(owner, values * lines.lengths, len(lines.counts))
    return sums / np.maximum(np.bincount(owner, lines.lengths, len(lines.counts)), 1.0)


def fit(lines: Lines, labels: np.ndarray, l2: float = 1e-3) -> Model:
    """A model for documents labelled 0 or 1.

    Without both labels among documents that have lines, all scores are alike:
    the share of good labels, or one half without any.
    """
    width = lines.features.shape[1]
    prior = float(labels.mean()) if len(labels) else 0.5
    used = lines.counts > 0
    if len(set(labels[used].tolist())) < 2:
        tilt = math.log(max(prior, 1e-3) / max(1 - prior, 1e-3))
        return Model(np.zeros(width), np.zeros((2, 2)), 0.0, tilt, prior)
    owner = np.repeat(np.arange(len(labels)), lines.counts)
    truth = labels[owner].astype(np.float64)
    x = lines.features
    # Both labels weigh alike, so that the many good lines don't hide bad ones.
    many, few = max(truth.sum(), 1), max((1 - truth).sum(), 1)
    weight = np.where(truth > 0, 0.5 / many, 0.5 / few)

    def seed_slope(w: np.ndarray) -> np.ndarray:
        error = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -500, 500))) - truth
        return x.T @ (weight * error) + l2 * w

    seed = x @ _adam(seed_slope, np.zeros(width), SEED_STEPS)
    line_labels = truth.copy()
    in_bad = truth == 0
    line_labels[in_bad] = seed[in_bad] > 0
    worst = np.full(len(labels), np.inf)
    np.minimum.at(worst, owner, seed)
    line_labels[in_bad & (seed == worst[owner])] = 0.0

    inner = np.ones(len(x), bool)
    inner[lines.starts[used]] = False
    pair_counts = np.zeros((2, 2))
    now, kind = np.flatnonzero(inner), line_labels.astype(int)
    np.add.at(pair_counts, (kind[now - 1], kind[now]), 1)

    def chain_slope(point: np.ndarray) -> np.ndarray:
        w, transitions = point[:width], point[width:].reshape(2, 2)
        marginal, pairs, _ = forward_backward(x @ w, transitions, lines.counts)
        by_feature = x.T @ (marginal - line_labels) / len(x)
        by_pair = (pairs - pair_counts) / len(x)
        return np.concatenate([by_feature, by_pair.ravel()]) + 0.1 * l2 * point

    point = _adam(chain_slope, np.zeros(width + 4), CHAIN_STEPS)
    model = Model(point[:width], point[width:].reshape(2, 2), 0.0, 0.0, prior)
    quality = weighted_mean(model.marginals(lines), lines)[used]
    wanted = labels[used].astype(np.float64)

    def scale_slope(p: np.ndarray) -> np.ndarray:
        raised = np.exp(-np.clip(p[0] * quality + p[1], -500, 500))
        error = 1.0 / (1.0 + raised) - wanted
        return np.array([(error * quality).mean(), error.mean()]) + 1e-5 * p

    model.slope, model.offset = map(float, _adam(scale_slope, np.array([8.0, -6.0]), 500))
    return model


def training_rows(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    characters: int = SAMPLE_CHARACTERS,
) -> DataFrame:
    """``text, quality`` of a bounded sample: ``sample`` ids, in order of a hash.

    Ids whose labels disagree, rows held out and texts of more than
    ``characters`` characters or ``SAMPLE_LINES`` lines don't take part.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where(~held_out(F.col("doc_id")) & (F.col("quality") == F.col("most")))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = documents.join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id")
    breaks = F.length("text") - F.length(F.translate("text", "\n", ""))
    fit = (F.length("text") <= characters) & (breaks < SAMPLE_LINES)
    return rows.where(fit).select("text", "quality")


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 1 by 3."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))


def train(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    characters: int = SAMPLE_CHARACTERS,
) -> Model:
    """Fit the field on the driver to the features of the sample's lines."""

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = common.byte_column(batch, "text")
            rows = [read_lines([t]) for t in raw]
            yield pa.RecordBatch.from_pydict(
                {
                    "features": [r.features[:, :OWN].astype("<f4").tobytes() for r in rows],
                    "lengths": [r.lengths.astype("<f4").tobytes() for r in rows],
                    "quality": batch.column("quality").cast(pa.int32()),
                }
            )

    rows = training_rows(documents, labels, sample, characters)
    found = common.map_arrow(
        rows, featured, "features binary, lengths binary, quality int"
    ).collect()
    # In an order that doesn't depend on how the rows came in.
    found.sort(key=lambda r: (r.quality, bytes(r.features), bytes(r.lengths)))
    own = np.frombuffer(b"".join(bytes(r.features) for r in found), "<f4")
    lengths = np.frombuffer(b"".join(bytes(r.lengths) for r in found), "<f4")
    counts = np.array([len(r.lengths) // 4 for r in found], np.int64)
    own = own.astype(np.float64).reshape(-1, OWN)
    lines = Lines(with_neighbours(own, counts), lengths.astype(np.float64), counts)
    return fit(lines, np.array([r.quality for r in found], np.int64))


def classify(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    characters: int = SAMPLE_CHARACTERS,
    threshold: float = 0.5,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text, row by row.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1) for some documents. A text
    without any line that is not blank, null ones included, scores the share of
    good labels in the sample. Rows of one id are scored each by their own text.
    Only the sample's bounds limit what is learnt from; all rows are scored.
    """
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )
    model = documents.sparkSession.sparkContext.broadcast(
        train(rows, labels, sample, characters)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            score = model.value.score(read_lines(common.byte_column(part, "text")))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(score),
                    pa.array((score >= threshold).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(
        rows.withColumn("held_out", held_out(F.col("doc_id"))),
        run,
        f"doc_id {kind}, held_out boolean, score double, predicted int",
    )


def keep_good(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    characters: int = SAMPLE_CHARACTERS,
    threshold: float = 0.5,
) -> DataFrame:
    """All columns of the rows whose text scores ``threshold`` or more.

    The rows stay where they are; texts are scored as ``classify`` does.
    """
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )
    model = documents.sparkSession.sparkContext.broadcast(
        train(rows, labels, sample, characters)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in common.slices(b, text, CHUNK)):
            raw = [t or b"" for t in common.byte_column(part, text)]
            yield part.filter(pa.array(model.value.score(read_lines(raw)) >= threshold))

    return common.map_arrow(documents, run, documents.schema)
