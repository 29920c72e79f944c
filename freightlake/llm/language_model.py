"""A hidden Markov language model.

Hidden states emit classes of words, and a class emits its words. The most
frequent training words, if seen ``LEAST`` times, are a class each; all others fall into one of ``SHAPES``
classes by a hash of their last three bytes, and so does a word that training
never saw. Within such a class a word has the share of its training count, where
all unseen words together count as one. Every text ends with an end token.

Words are counted over all training texts by an ordinary aggregate. The most
frequent ``KNOWN`` words are looked up in the task that reads a text; the others
meet their counts in a join, one row for each different one of a text. Classes of
all texts are written once, two bytes a token. Each round of Baum-Welch reads the
training texts among them in runs of up to ``RUN`` tokens, works out expected
counts by the forward-backward recursion, adds them up by task and then across
tasks, and sets the states anew. The score of a text is exact: its scaled forward
recursion from the first to the last token. Long texts are cut into lanes whose
matrices are worked out side by side and multiplied.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common

STATES = 8
ROUNDS = 6

# Words that are a class each, classes of the others, words that are looked up in
# tasks, and the bytes that such a word has at most.
FREQUENT = 1 << 15
SHAPES = 1 << 12
KNOWN = 1 << 17
WORD_BYTES = 64

# Tokens of a run, tokens that are worked on together, and the tokens of a text from
# which on it is scored in lanes.
RUN = 128
TOGETHER = 1 << 18
LONG = 1 << 12
LANES = 64

# Least count of a word that is a class of its own.
LEAST = 5

# Part of the starts and transitions that are alike for all states, and tokens of
# each class that are dealt to states as all tokens are.
PRIOR = 0.01
NEUTRAL = 2.0
SEED = 17

CHUNK = 4_000_000
HELD = 300_000
END = b"\n"


def shape(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word[-3:], 3) % SHAPES


class Places(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


class Shapes(dict):
    def __missing__(self, ending: bytes) -> int:
        found = self[ending] = shape(ending)
        return found


def _tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, shape, n`` over all texts (``text``), the end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, counts = Shapes(), Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(counts.keys(), pa.binary()),
                    pa.array([shapes[w[-3:]] for w in counts], pa.int32()),
                    pa.array(counts.values(), pa.int64()),
                ],
                ["word", "shape", "n"],
            )

        for part in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            for text in common.byte_column(part, "text"):
                counts.update(_tokens(text))
            counts[END] += len(part)
            if len(counts) > HELD:
                yield counted()
                counts.clear()
        yield counted()

    counted = common.map_arrow(texts, run, "word binary, shape int, n long")
    return counted.groupBy("word", "shape").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Frequent words and totals; its size is bounded by parameters.

    A class is a frequent word's place, or ``frequent`` plus a shape.
    """

    def __init__(
        self, known: list[tuple[bytes, int]], frequent: int, shapes: dict[int, tuple[int, int]],
        total: int, distinct: int,
    ) -> None:
        self.total, self.distinct = total, distinct
        # Words come in falling order of their counts.
        self.frequent = min(frequent, sum(n >= LEAST for _, n in known))
        self.classes = self.frequent + SHAPES
        self.scale = total + 0.5 * (distinct + 1)
        self.place = Places((w, i) for i, (w, _) in enumerate(known))
        self.counts = np.array([n for _, n in known], np.int64)
        # Tokens and different words of the classes that hold several words.
        self.shape_tokens, self.shape_words = (np.zeros(SHAPES) for _ in range(2))
        for at, (tokens, words) in shapes.items():
            self.shape_tokens[at], self.shape_words[at] = tokens, words
        rest = np.array([shape(w) for w, _ in known[self.frequent :]], np.int64)
        self.class_of = np.r_[np.arange(self.frequent), self.frequent + rest].astype(np.int64)
        self.base = np.log10((self.counts + 0.5) / self.scale)
        inner = (self.counts[self.frequent :] + 0.5) / self.within(rest)
        self.inner = np.r_[np.zeros(self.frequent), np.log10(inner)]

    def within(self, shapes: np.ndarray) -> np.ndarray:
        """What the counts of words of a class are divided by."""
        return self.shape_tokens[shapes] + 0.5 * (self.shape_words[shapes] + 1)

    def share(self) -> np.ndarray:
        """Share of each class in all training tokens, unseen ones a little above 0."""
        found = np.r_[self.counts[: self.frequent], self.shape_tokens] + 0.5
        return found / found.sum()


def vocabulary(counts: DataFrame, frequent: int = FREQUENT, known: int = KNOWN) -> Vocabulary:
    """From ``word, shape, n``; long words are never among the known ones."""
    total, distinct = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    ).first()
    short = counts.where(F.octet_length("word") <= WORD_BYTES)
    listed = short.orderBy(F.desc("n"), "word").limit(known).collect()
    top = [(bytes(r.word), r.n) for r in listed]
    shapes = {
        r["shape"]: [r.n, r.words]
        for r in counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    }
    for word, n in top[:frequent]:
        if n >= LEAST:
            own = shapes[shape(word)]
            own[0] -= n
            own[1] -= 1
    return Vocabulary(top, frequent, shapes, total, distinct)


CODED = (
    "row long, held_out boolean, n_tokens long, n_known long, base double, inner double, "
    "classes binary, rare array<struct<word: binary, within: double, n: bigint>>"
)


def coded(rows: DataFrame, words: Vocabulary) -> DataFrame:
    """Each text (``doc_id, held_out, text``) as classes, with what its known words give.

    ``row`` numbers rows; ``rare`` are the different words of a text that are not
    among the known ones, with their number and what the counts of their class are
    divided by.
    """
    shared = rows.sparkSession.sparkContext.broadcast(words)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shapes = shared.value, Shapes()
        within = known.within(np.arange(SHAPES)).tolist()
        place, frequent = known.place.__getitem__, known.frequent
        row = TaskContext.get().partitionId() << 40
        for part in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            out: dict[str, list] = {c.split()[0]: [] for c in CODED.split(", ")[:7]}
            out["rare"] = []
            for text in common.byte_column(part, "text"):
                tokens = _tokens(text)
                tokens.append(END)
                found = np.fromiter(map(place, tokens), np.int64, len(tokens))
                seen = found >= 0
                places = found[seen]
                classes = np.empty(len(tokens), np.int64)
                classes[seen] = known.class_of[places]
                other = [tokens[i] for i in np.flatnonzero(~seen)]
                classes[~seen] = [frequent + shapes[t[-3:]] for t in other]
                out["row"].append(row)
                out["n_tokens"].append(len(tokens))
                out["n_known"].append(len(places))
                out["base"].append(float(known.base[places].sum()))
                out["inner"].append(float(known.inner[places].sum()))
                out["classes"].append(classes.astype("<u2").tobytes())
                out["rare"].append(
                    [
                        {"word": w, "within": within[shapes[w[-3:]]], "n": n}
                        for w, n in Counter(other).items()
                    ]
                )
                row += 1
            rare = pa.list_(
                pa.struct([("word", pa.binary()), ("within", pa.float64()), ("n", pa.int64())])
            )
            kinds = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.binary(), rare]
            names = ["row", "n_tokens", "n_known", "base", "inner", "classes", "rare"]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    *(pa.array(out[c], k) for c, k in zip(names, kinds)),
                ],
                ["doc_id", "held_out", *names],
            )

    fields = dict(c.split(maxsplit=1) for c in CODED.split(", ", 7)[:7])
    fields["rare"] = CODED.split(", ", 7)[7].split(maxsplit=1)[1]
    order = ["held_out", "row", "n_tokens", "n_known", "base", "inner", "classes", "rare"]
    schema = f"doc_id {kind}, " + ", ".join(f"{c} {fields[c]}" for c in order)
    return common.map_arrow(rows, run, schema)


class Model:
    """Start, transition and emission shares of hidden states."""

    def __init__(self, start: np.ndarray, steps: np.ndarray, emission: np.ndarray) -> None:
        self.start, self.steps, self.emission = start, steps, emission

    @classmethod
    def first(cls, share: np.ndarray, states: int = STATES, seed: int = SEED) -> Model:
        """States that emit each class somewhat more or less than the corpus does."""
        draws = np.random.Generator(np.random.PCG64(seed))
        emission = share[:, None] * draws.uniform(0.5, 1.5, (len(share), states))
        steps = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return cls(np.full(states, 1 / states), steps, emission / emission.sum(axis=0))

    def updated(self, start: np.ndarray, steps: np.ndarray, emitted: np.ndarray, share: np.ndarray) -> Model:
        """The model that expected counts ask for.

        Each class gets ``NEUTRAL`` more tokens, dealt to states as all tokens are,
        so that a class of few tokens says little about its state.
        """
        states = len(start)

        def shares(counts: np.ndarray) -> np.ndarray:
            total = counts.sum(axis=-1, keepdims=True)
            flat = np.full_like(counts, 1 / states)
            return (1 - PRIOR) * np.divide(counts, total, out=flat, where=total > 0) + PRIOR / states

        weight = shares(emitted.sum(axis=0))
        of_class = emitted.sum(axis=1, keepdims=True)
        among = (emitted + NEUTRAL * weight) / (of_class + NEUTRAL)
        emission = share[:, None] * among
        return Model(shares(start), shares(steps), emission / emission.sum(axis=0))


def _batches(sequences: list[np.ndarray], most: int = TOGETHER) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sequences of like length side by side: their numbers, lengths, and a table by time."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    at = 0
    while at < len(order):
        longest = len(sequences[order[at]])
        own = order[at : at + max(1, most // longest)]
        at += len(own)
        sizes = np.array([len(sequences[i]) for i in own])
        table = np.zeros((longest, len(own)), np.uint16)
        for column, i in enumerate(own):
            table[: len(sequences[i]), column] = sequences[i]
        yield own, sizes, table


def forward(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 of the likelihood of each sequence, by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    for own, sizes, table in _batches(sequences):
        logs = np.zeros(len(own))
        alpha = np.broadcast_to(model.start, (len(own), len(model.start)))
        live = len(own)
        for time in range(len(table)):
            # Longer sequences come first.
            while sizes[live - 1] <= time:
                live -= 1
            alpha = alpha[:live] if not time else alpha[:live] @ model.steps
            alpha = alpha * model.emission[table[time, :live]]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            logs[:live] += np.log10(scale)
        out[own] = logs
    return out


def forward_state(model: Model, sequence: np.ndarray) -> tuple[float, np.ndarray]:
    """log10 likelihood and the scaled forward values behind the last token."""
    log, alpha = 0.0, model.start
    for time, emitted in enumerate(model.emission[sequence]):
        alpha = (alpha if not time else alpha @ model.steps) * emitted
        scale = alpha.sum()
        log += math.log10(scale)
        alpha = alpha / scale
    return log, alpha


def forward_long(model: Model, sequence: np.ndarray, lanes: int = LANES) -> float:
    """The same as ``forward`` for one long sequence, whose parts go side by side."""
    states = len(model.start)
    size = -(-len(sequence) // lanes)
    parts = [sequence[i : i + size] for i in range(0, len(sequence), size)]
    log, alpha = forward_state(model, parts[0])
    rest = parts[1:]
    table = np.zeros((size, len(rest)), np.uint16)
    for column, part in enumerate(rest):
        table[: len(part), column] = part
    # Row k of a lane's matrix: forward values from state k before its first token.
    lane = np.broadcast_to(np.eye(states), (len(rest), states, states)).copy()
    logs = np.zeros(len(rest))
    for time in range(size if rest else 0):
        # Only the last part may be shorter.
        live = len(rest) - (time >= len(rest[-1]))
        moved = (lane[:live] @ model.steps) * model.emission[table[time, :live]][:, None, :]
        scale = moved.sum(axis=(1, 2))
        lane[:live] = moved / scale[:, None, None]
        logs[:live] += np.log10(scale)
    for matrix, own in zip(lane, logs.tolist()):
        alpha = alpha @ matrix
        scale = alpha.sum()
        log += own + math.log10(scale)
        alpha = alpha / scale
    return float(log)


def expected_counts(model: Model, runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, transitions and emissions of some runs, and their log10 likelihood."""
    classes, states = model.emission.shape
    start, steps = np.zeros(states), np.zeros((states, states))
    emitted = np.zeros((classes, states))
    log = 0.0
    for _, sizes, table in _batches(runs):
        width, longest = len(sizes), len(table)
        live = (sizes[None, :] > np.arange(longest)[:, None]).sum(axis=1)
        seen = model.emission[table]
        alphas = np.empty((longest, width, states))
        scales = np.ones((longest, width))
        for time, n in enumerate(live):
            before = np.broadcast_to(model.start, (n, states)) if not time else alphas[time - 1, :n] @ model.steps
            own = before * seen[time, :n]
            scale = own.sum(axis=1)
            alphas[time, :n] = own / scale[:, None]
            scales[time, :n] = scale
        log += float(np.log10(scales).sum())
        beta = np.ones((width, states))
        for time in range(longest - 1, -1, -1):
            n = live[time]
            if time + 1 < longest:
                m = live[time + 1]
                # Behind the last token of a run beta is one.
                ahead = beta[:m] * seen[time + 1, :m] / scales[time + 1, :m, None]
                steps += model.steps * (alphas[time, :m].T @ ahead)
                beta[:m] = ahead @ model.steps.T
            # From here on this holds the states' shares at that token.
            alphas[time, :n] *= beta[:n]
        start += alphas[0, : live[0]].sum(axis=0)
        inside = np.arange(width)[None, :] < live[:, None]
        flat = table[inside]
        for state in range(states):
            emitted[:, state] += np.bincount(flat, alphas[:, :, state][inside], classes)
    return start, steps, emitted, log


def _runs(classes: bytes) -> list[np.ndarray]:
    whole = np.frombuffer(classes, "<u2")
    return [whole[i : i + RUN] for i in range(0, len(whole), RUN)]


def one_round(training: DataFrame, model: Model, share: np.ndarray) -> tuple[Model, float]:
    """One round of Baum-Welch over ``classes``, and the log10 likelihood before it.

    A task sends a row for each class it saw, with the expected counts by state;
    the driver receives their sums, one row for each class.
    """
    shared = training.sparkSession.sparkContext.broadcast(model)
    count, states = model.emission.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums = [np.zeros(states), np.zeros((states, states)), np.zeros((count, states)), 0.0]
        for batch in batches:
            held: list[np.ndarray] = []
            size = 0
            for classes in batch.column("classes"):
                held += _runs(classes.as_py())
                size += len(classes.as_py()) // 2
                if size > TOGETHER:
                    sums = [a + b for a, b in zip(sums, expected_counts(own, held))]
                    held, size = [], 0
            if held:
                sums = [a + b for a, b in zip(sums, expected_counts(own, held))]
        start, steps, emitted, log = sums
        # Places behind the classes: starts, transitions and the likelihood.
        table = np.vstack([emitted, start, steps, np.r_[log, np.zeros(states - 1)]])
        some = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), *(pa.array(table[some, s].copy()) for s in range(states))],
            ["place", *(f"s{s}" for s in range(states))],
        )

    names = [f"s{s}" for s in range(states)]
    counted = common.map_arrow(
        training.select("classes"), run, "place long, " + ", ".join(f"{n} double" for n in names)
    )
    summed = counted.groupBy("place").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    table = np.zeros((count + 1 + states + 1, states))
    table[summed["place"].to_numpy()] = summed[names].to_numpy()
    emitted, start = table[:count], table[count]
    steps, log = table[count + 1 : count + 1 + states], float(table[-1, 0])
    return model.updated(start, steps, emitted, share), log


def trained(
    training: DataFrame, words: Vocabulary, states: int = STATES, rounds: int = ROUNDS
) -> Model:
    """The model after some rounds over all training texts (``classes``)."""
    share = words.share()
    model = Model.first(share, states)
    if words.total:
        for _ in range(rounds):
            model, _ = one_round(training, model, share)
    return model


def _forward_frame(texts: DataFrame, model: Model) -> DataFrame:
    """``row`` and all other columns of ``texts`` but classes, with their ``log``."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in texts.schema if f.name != "classes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in (p for b in batches for p in common.slices(b, "classes", 1 << 20)):
            whole = [np.frombuffer(c.as_py(), "<u2") for c in part.column("classes")]
            logs = np.zeros(len(whole))
            short = [i for i, s in enumerate(whole) if len(s) < LONG]
            logs[short] = forward(own, [whole[i] for i in short])
            for i, sequence in enumerate(whole):
                if len(sequence) >= LONG:
                    logs[i] = forward_long(own, sequence)
            columns = [part.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(logs)], [*(f.name for f in kept), "log"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return common.map_arrow(texts, run, f"{schema}, log double")


def _rare_sums(texts: DataFrame, counts: DataFrame, scale: float) -> DataFrame:
    """``row, known, base, inner`` of the words that were not looked up.

    Each of them is in a small part of the texts, so the join has no hot key but
    for long words, and those adaptive execution splits.
    """
    rare = texts.select("row", F.explode("rare").alias("r")).select("row", "r.*")
    met = rare.join(counts.select("word", F.col("n").alias("c")), "word", "left")
    c = F.coalesce("c", F.lit(0))
    return met.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(scale))).alias("rare_base"),
        F.sum(F.col("n") * F.log10((c + 0.5) / F.col("within"))).alias("rare_inner"),
    )


def score(
    documents: DataFrame,
    held_out: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
    frequent: int = FREQUENT,
    known: int = KNOWN,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model learns from all rows that are not held out, whole, and each row is
    scored whole. Letters A to Z count as lower case; tokens are the words between
    blanks and one end. ``n_known`` counts tokens that training saw, ``base_score``
    is the log10 probability by word counts alone, ``score`` that by the model. A
    null text is empty: just an end. A row whose ``held_out`` is null is held out.
    Without training rows all states are alike. Repeated rows are scored alike, and
    count as often as they are there.
    """
    rows = common.blank(
        documents.select(
            F.col(doc_id).alias("doc_id"),
            F.coalesce(held_out, F.lit(True)).alias("held_out"),
            F.col(text).alias("text"),
        ),
        "text",
    )
    counts = common.stored_once(word_counts(rows.where("NOT held_out").select("text")), "counts")
    words = vocabulary(counts, frequent, known)
    texts = common.stored_once(coded(rows, words), "coded")
    model = trained(texts.where("NOT held_out"), words, states, rounds)
    scored = _forward_frame(texts.drop("rare"), model)
    rare = _rare_sums(texts, counts, words.scale)
    zero = F.lit(0.0)
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("log") + F.col("inner") + F.coalesce("rare_inner", zero)).alias("score"),
    )
