"""Repeated passages by a distributed suffix array of sampled suffixes.

A window is ``length`` bytes at one place of a text. Its anchor is the place of
the least hash of short byte strings in its middle, so equal windows have equal
anchors at an equal distance, and neighbouring windows mostly share theirs. Only
suffixes at anchors are looked at, one in some 150 bytes. All windows of an anchor
lie in its segment and contain its core, the bytes next to it.

1. Anchors whose core occurs at one place only have no repeated window. Segments
   that occur as a whole at two places have only repeated ones. Both follow from
   counts of hashes.
2. What is left, different segments with one core, is sorted: by the suffix from
   the anchor on, and once more by what precedes the anchor, read backwards.
   Sampled splitters part the order into buckets by leading tokens of eight
   bytes, so members of one core that many texts share go to many buckets. A
   bucket is sorted by multikey quicksort, and each suffix is compared with its
   neighbours, across the bounds of buckets too. Two suffixes that agree in l
   bytes before the anchor and r bytes from it have equal windows at all
   distances from length - r to l.
3. Neighbours settle all but windows that would have to match a suffix further
   off in both orders; those few are compared by their hashes.

Passages of a number of words, whatever their bytes, are found in the same way in
texts whose words are coded by six bytes of their hash each.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common
from freightlake.llm.bitmaps import maybe_in

LENGTH = 400
GRAM = 32

# Bytes of text that anchors are looked for in at a time, bytes of a token, the
# neighbours on either side that a suffix is compared with, and the rows that are
# sampled for each splitter.
BLOCK = 1 << 18
TOKEN = 8
REACH = 8
SAMPLED = 20

# Bytes that stand for a word where passages are measured in words.
WORD_BYTES = 6
CACHE_WORDS = 200_000

_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")

_PLACE_BITS = np.uint64(20)
_PLACE_MASK = np.uint64((1 << 20) - 1)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and powers of an odd base and of its inverse."""
    draws = np.random.Generator(np.random.PCG64(9))
    table = draws.integers(1, 1 << 63, 256, np.uint64)
    base = 0x9E3779B97F4A7C15
    size = BLOCK + 1
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, factor, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return table, out[0], out[1]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


class Shape:
    """Where anchors, cores and windows lie, for windows of ``length`` bytes."""

    def __init__(self, length: int) -> None:
        if length < 8:
            raise ValueError("windows need eight bytes at least")
        self.length = length
        # Anchors of a window are from margin to length - margin bytes into it.
        self.margin = length // 8
        self.gram = min(GRAM, self.margin)
        self.places = length - 2 * self.margin + 1


def block_anchors(
    block: np.ndarray, starts: np.ndarray, ends: np.ndarray, shape: Shape
) -> tuple[np.ndarray, ...]:
    """Anchors of texts that lie side by side in a block of bytes.

    Gives, for each anchor, its text, place, first and last window, and hashes of
    core and segment. Texts shorter than a window have none.
    """
    table, power, inverse = _powers()
    size = len(block)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(table[block] * power[:size], out=sums[1:])

    def hashed(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (sums[last] - sums[first]) * inverse[first]

    count = size - shape.gram + 1
    grams = _mixed((sums[shape.gram :] - sums[:count]) * inverse[:count])
    key = (grams & ~_PLACE_MASK) | np.arange(count, dtype=np.uint64)
    least, width = key, 1
    while 2 * width <= shape.places:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = shape.places - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    windows = np.concatenate(
        [np.arange(a, b - shape.length + 1) for a, b in zip(starts.tolist(), ends.tolist())]
        or [np.empty(0, np.int64)]
    )
    owner = np.repeat(np.arange(len(starts)), np.maximum(ends - starts - shape.length + 1, 0))
    place = (least[windows + shape.margin] & _PLACE_MASK).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(windows)] - 1
    at, low, high = place[first], windows[first], windows[last]
    core = _mixed(hashed(at - shape.margin, at + shape.margin))
    segment = hashed(low, high + shape.length)
    layout = ((at - low) << 20 | (high - low)).astype(np.uint64)
    segment = _mixed(segment + layout * np.uint64(0xC4CEB9FE1A85EC53))
    text = owner[first]
    begin = starts[text]
    return text, at - begin, low - begin, high - begin, core, segment


def _blocks(texts: list[bytes], shape: Shape) -> Iterator[tuple]:
    """Blocks of whole texts, or of parts of long ones that share length - 1 bytes."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    step = BLOCK - shape.length + 1
    for index, text in enumerate(texts):
        if len(text) < shape.length:
            continue
        parts = range(0, max(1, len(text) - shape.length + 1), step)
        for offset in parts:
            part = text[offset : offset + BLOCK]
            if size + len(part) > BLOCK:
                yield held
                held, size = [], 0
            held.append((index, offset, part))
            size += len(part)
    if held:
        yield held


def anchors(texts: list[bytes], shape: Shape) -> tuple[np.ndarray, ...]:
    """Anchors of some texts: text, place, first and last window, core, segment."""
    out = []
    for held in _blocks(texts, shape):
        index, offset, parts = zip(*held)
        sizes = np.array(list(map(len, parts)), np.int64)
        ends = np.cumsum(sizes)
        block = np.frombuffer(b"".join(parts), np.uint8)
        text, at, low, high, core, segment = block_anchors(block, ends - sizes, ends, shape)
        shift = np.array(offset, np.int64)[text]
        found = np.array(index, np.int64)[text]
        out.append((found, at + shift, low + shift, high + shift, core, segment))
    if not out:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def multikey_quicksort(rows: list[tuple[bytes, ...]], part: int) -> list[tuple[bytes, ...]]:
    """Rows in order of their byte string ``part``, token by token.

    Rows are parted in three by the token at the present depth; only those that
    are equal there go one token deeper. A token shorter than others ends its
    string, which is then equal to the rows beside it.
    """
    out: list[tuple[bytes, ...]] = []
    open_parts = [(rows, 0)]
    while open_parts:
        some, depth = open_parts.pop()
        if len(some) <= 1 or depth < 0:
            out += some
            continue
        at = depth * TOKEN
        token = [r[part][at : at + TOKEN] for r in some]
        pivot = sorted((token[0], token[len(token) // 2], token[-1]))[1]
        less = [r for r, t in zip(some, token) if t < pivot]
        same = [r for r, t in zip(some, token) if t == pivot]
        more = [r for r, t in zip(some, token) if t > pivot]
        deeper = depth + 1 if len(pivot) == TOKEN else -1
        open_parts += [(more, depth), (same, deeper), (less, depth)]
    return out


def common_prefix(left: bytes, right: bytes) -> int:
    size = min(len(left), len(right))
    differing = int.from_bytes(left[:size], "big") ^ int.from_bytes(right[:size], "big")
    return size - (differing.bit_length() + 7) // 8


def compare_neighbours(
    rows: list[tuple],
    before: tuple | None,
    after: tuple | None,
    length: int,
    reach: int = REACH,
) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """For each of some sorted rows, what its neighbours tell.

    A row is (core, first, second, ...), sorted in that order, where first and
    second are the bytes on the two sides of an anchor; ``before`` and ``after``
    are the rows next to the first and the last one. Gives the largest agreement
    in ``first`` with any row that was not compared, and the agreements (first,
    second) with those that were and that have a window in common.
    """
    around = [before, *rows, after]
    for at in range(1, len(rows) + 1):
        own = around[at]
        # With less than this on one side the other can't make up for it.
        needed = length - len(own[2])
        bound, found = -1, []
        for step in (-1, 1):
            agreed = len(own[1])
            for far in range(1, reach + 2):
                place = at + step * far
                other = around[place] if 0 <= place < len(around) else None
                beyond = not 0 <= place < len(around)
                if beyond:
                    # What follows is unknown, but agrees no more than the last one.
                    bound = max(bound, agreed)
                    break
                if other is None or other[0] != own[0]:
                    break
                agreed = min(agreed, common_prefix(own[1], other[1]))
                if agreed < needed:
                    break
                if far > reach:
                    bound = max(bound, agreed)
                    break
                side = common_prefix(own[2], other[2])
                if agreed + side >= length:
                    found.append((agreed, side))
        yield bound, found


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64))


def _anchor_frame(texts: DataFrame, shape: Shape) -> DataFrame:
    """``key, place, low, high, core, segment, spot``: anchors of texts with a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = common.byte_column(batch, "text")
            for first, last in common.chunks(map(len, raw), 4 * BLOCK):
                text, at, low, high, core, segment = anchors(raw[first:last], shape)
                keys = batch.column("key").slice(first, last - first).take(pa.array(text))
                yield pa.RecordBatch.from_arrays(
                    [keys, *map(pa.array, (at, low, high)), _signed(core), _signed(segment)],
                    ["key", "place", "low", "high", "core", "segment"],
                )

    found = common.map_arrow(
        texts, run, "key binary, place long, low long, high long, core long, segment long"
    )
    return found.withColumn("spot", F.xxhash64("key", "place", "low"))


def _segment_frame(wanted: DataFrame, length: int) -> DataFrame:
    """``core, segment, left, right``: bytes before the anchor, backwards, and from it on."""

    def sides(text: bytes, members: list[dict]) -> list[tuple]:
        return [
            (
                m["core"],
                m["segment"],
                text[m["low"] : m["place"]][::-1],
                text[m["place"] : m["high"] + length],
            )
            for m in members
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_pylist()
            for first, last in common.chunks(sizes, 4 * BLOCK):
                part = batch.slice(first, last - first)
                raw = common.byte_column(part, "text")
                listed = part.column("members").to_pylist()
                rows = [r for t, own in zip(raw, listed) for r in sides(t, own)]
                core, segment, left, right = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core, pa.int64()),
                        pa.array(segment, pa.int64()),
                        pa.array(left, pa.binary()),
                        pa.array(right, pa.binary()),
                    ],
                    ["core", "segment", "left", "right"],
                )

    return common.map_arrow(
        wanted, run, "core long, segment long, left binary, right binary"
    )


def _neighbour_frame(segments: DataFrame, first: str, second: str, length: int) -> DataFrame:
    """``core, segment, bound, agreed``: each segment against its neighbours in order."""
    spark = segments.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    reach = REACH
    ordered = segments.select("core", F.col(first).alias("a"), F.col(second).alias("b"), "segment")
    count = ordered.count()
    share = min(1.0, SAMPLED * buckets / max(count, 1))
    sampled = sorted(map(tuple, ordered.drop("segment").sample(share, seed=7).collect()))
    sampled = [(c, bytes(a), bytes(b)) for c, a, b in sampled]
    every = max(1, len(sampled) // buckets)
    splitters = spark.sparkContext.broadcast(sampled[every::every])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = splitters.value
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("core", "a", "b")))
            bucket = [bisect.bisect_right(cuts, row) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bucket, pa.int32())], [*batch.schema.names, "bucket"]
            )

    dealt = common.map_arrow(
        ordered, deal, "core long, a binary, b binary, segment long, bucket int"
    )
    row = F.struct("core", "a", "b")
    # One row for each bucket: what borders on the buckets beside it.
    ends = dealt.groupBy("bucket").agg(F.min(row).alias("low"), F.max(row).alias("high"))
    edges = {
        r.bucket: [(e.core, bytes(e.a), bytes(e.b)) for e in (r.low, r.high)]
        for r in ends.collect()
    }
    used = sorted(edges)
    beside = {
        b: (
            edges[used[i - 1]][1] if i else None,
            edges[used[i + 1]][0] if i + 1 < len(used) else None,
        )
        for i, b in enumerate(used)
    }
    shared = spark.sparkContext.broadcast(beside)

    def compare(key: tuple, part: pa.Table) -> pa.Table:
        names = ("core", "a", "b", "segment")
        rows = list(zip(*(part.column(c).to_pylist() for c in names)))
        # The core is the leading token of all, so it heads the string.
        head = [(c + (1 << 63)).to_bytes(TOKEN, "big") for c, *_ in rows]
        keyed = [(h + r[1], r[2], r) for h, r in zip(head, rows)]
        sorted_rows: list[tuple] = []
        run: list[tuple] = []
        for item in multikey_quicksort(keyed, 0):
            if run and run[-1][0] != item[0]:
                sorted_rows += [r for *_, r in multikey_quicksort(run, 1)]
                run = []
            run.append(item)
        sorted_rows += [r for *_, r in multikey_quicksort(run, 1)]
        bucket = key[0].as_py() if hasattr(key[0], "as_py") else key[0]
        before, after = shared.value[bucket]
        told = list(compare_neighbours(sorted_rows, before, after, length, reach))
        kind = pa.list_(pa.struct([("first", pa.int32()), ("second", pa.int32())]))
        agreed = [[{"first": a, "second": b} for a, b in found] for _, found in told]
        return pa.table(
            {
                "core": pa.array([r[0] for r in sorted_rows], pa.int64()),
                "segment": pa.array([r[3] for r in sorted_rows], pa.int64()),
                "bound": pa.array([bound for bound, _ in told], pa.int32()),
                "agreed": pa.array(agreed, kind),
            }
        )

    return dealt.groupBy("bucket").applyInArrow(
        compare,
        "core long, segment long, bound int, agreed array<struct<first: int, second: int>>",
    )


def _settled(forward: DataFrame, backward: DataFrame, length: int) -> DataFrame:
    """``core, segment, near, open_low, open_high``: distances of repeated windows.

    ``near`` is a list of ranges that neighbours have shown. What may still match a
    suffix further off is at most the distances that both bounds allow; those that
    ``near`` covers from either end are settled, and ``open_low`` to ``open_high``
    is what remains.
    """
    key = ["core", "segment"]
    joined = forward.select(
        *key, F.col("bound").alias("right_bound"), F.col("agreed").alias("f")
    ).join(
        backward.select(*key, F.col("bound").alias("left_bound"), F.col("agreed").alias("g")),
        key,
    )

    def shown(found: str, right: str, left: str) -> Column:
        return F.transform(
            found,
            lambda a: F.struct((F.lit(length) - a[right]).alias("x"), a[left].alias("y")),
        )

    ranges = F.concat(shown("f", "first", "second"), shown("g", "second", "first"))
    upward = F.array_sort("near")
    downward = F.reverse(
        F.array_sort(F.transform("near", lambda r: F.struct(r["y"].alias("y"), r["x"].alias("x"))))
    )
    low = F.aggregate(
        upward,
        F.lit(length) - F.col("right_bound"),
        lambda at, r: F.when(r["x"] <= at, F.greatest(at, r["y"] + 1)).otherwise(at),
    )
    high = F.aggregate(
        downward,
        F.col("left_bound"),
        lambda at, r: F.when(r["y"] >= at, F.least(at, r["x"] - 1)).otherwise(at),
    )
    return (
        joined.select(*key, "left_bound", "right_bound", ranges.alias("near"))
        .select(*key, "near", low.alias("open_low"), high.alias("open_high"))
        .where((F.size("near") > 0) | (F.col("open_low") <= F.col("open_high")))
    )


def _open_windows(settled: DataFrame, segments: DataFrame, length: int) -> DataFrame:
    """``core, segment, x, y`` of windows that match a suffix that is no neighbour.

    The open distances of a core are looked at in all of its segments, as the
    partner of an open window may itself be settled already.
    """
    doubtful = settled.where("open_low <= open_high")
    cores = doubtful.groupBy("core").agg(
        F.min("open_low").alias("from_x"), F.max("open_high").alias("to_y")
    )
    rows = segments.join(cores, "core")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = ("core", "segment", "left", "right", "from_x", "to_y")
            for core, segment, left, right, low, high in zip(
                *(batch.column(c).to_pylist() for c in columns)
            ):
                text = left[::-1] + right
                low, high = max(low, length - len(right)), min(high, len(left))
                for x in range(low, high + 1):
                    at = len(left) - x
                    digest = xxhash.xxh64_intdigest(text[at : at + length], 5)
                    out.append((core, segment, x, digest - (1 << 63)))
            core, segment, x, digest = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core, pa.int64()),
                    pa.array(segment, pa.int64()),
                    pa.array(x, pa.int32()),
                    pa.array(digest, pa.int64()),
                ],
                ["core", "segment", "x", "digest"],
            )

    windows = common.stored_once(
        common.map_arrow(rows, run, "core long, segment long, x int, digest long"), "windows"
    )
    repeated = (
        windows.groupBy("core", "x", "digest")
        .agg(F.min("segment").alias("lowest"), F.max("segment").alias("highest"))
        .where("lowest <> highest")
    )
    return windows.join(repeated, ["core", "x", "digest"], "left_semi").select(
        "core", "segment", "x", F.col("x").alias("y")
    )


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, spans``: for each different text, the spans that repeated windows cover.

    ``texts`` has ``key`` and ``text``, where equal texts have equal keys. A span
    is ``start, end`` in bytes; spans may overlap. Texts without any are left out.
    Windows of equal texts are repeated as a whole. The work is done in one text
    of each kind.
    """
    shape = Shape(length)
    copies = texts.where(F.octet_length("text") >= length).groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("text")).alias("size")
    )
    copies = common.stored_once(copies.where("copies > 1"), "copies")
    found = common.stored_once(_anchor_frame(texts, shape), "anchors")
    shared_cores = common.stored_once(
        found.groupBy("core")
        .agg(F.min("spot").alias("lowest"), F.max("spot").alias("highest"))
        .where("lowest <> highest")
        .select("core"),
        "cores",
    )
    likely = maybe_in(found, "core", shared_cores, "core", "likely").where("likely")
    several = common.stored_once(
        likely.drop("likely")
        .join(shared_cores, "core", "left_semi")
        .dropDuplicates(["spot", "core", "segment"]),
        "several",
    )
    by_segment = several.groupBy("core", "segment").agg(
        F.min("spot").alias("lowest"),
        F.max("spot").alias("highest"),
        F.min(F.struct("key", "place", "low", "high")).alias("one"),
    )
    by_segment = common.stored_once(by_segment, "segments")
    whole = by_segment.where("lowest <> highest").select(
        "core",
        "segment",
        (F.col("one.place") - F.col("one.high")).cast("int").alias("x"),
        (F.col("one.place") - F.col("one.low")).cast("int").alias("y"),
    )
    # Stored, so that the join that follows can split a core of many segments.
    mixed = common.stored_once(
        by_segment.groupBy("core")
        .agg(F.min("segment").alias("lowest"), F.max("segment").alias("highest"))
        .where("lowest <> highest")
        .select("core"),
        "mixed",
    )
    members = (
        by_segment.join(mixed, "core", "left_semi")
        .select("one.*", "core", "segment")
        .groupBy("key")
        .agg(F.collect_list(F.struct("core", "segment", "place", "low", "high")).alias("members"))
    )
    members = common.stored_once(members, "members")
    holders = maybe_in(texts, "key", members, "key", "likely").where("likely")
    segments = common.stored_once(
        _segment_frame(holders.join(members, "key").select("text", "members"), length)
        .dropDuplicates(["core", "segment"]),
        "suffixes",
    )
    forward = _neighbour_frame(segments, "right", "left", length)
    backward = _neighbour_frame(segments, "left", "right", length)
    settled = common.stored_once(_settled(forward, backward, length), "settled")
    ranges = (
        settled.select("core", "segment", F.explode("near").alias("range"))
        .select("core", "segment", "range.x", "range.y")
        .unionByName(_open_windows(settled, segments, length))
        .unionByName(whole)
    )
    spans = several.join(ranges, ["core", "segment"]).select(
        "key",
        F.struct(
            (F.col("place") - F.col("y")).alias("start"),
            (F.col("place") - F.col("x") + length).alias("end"),
        ).alias("span"),
    )
    entire = copies.select(
        "key",
        F.struct(F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end")).alias("span"),
    )
    return spans.unionByName(entire).groupBy("key").agg(F.collect_set("span").alias("spans"))


def word_codes(text: bytes, known: common.WordHashes) -> bytes:
    """``WORD_BYTES`` bytes of the hash of each word, one after the other."""
    hashed = np.fromiter(map(known.__getitem__, text.split()), "<u8")
    return hashed.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()


def _coded(texts: DataFrame, words: int) -> DataFrame:
    """``key, text`` with the codes of all texts that have so many words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.WordHashes()
        for part in (p for b in batches for p in common.slices(b, "text", 4 * BLOCK)):
            if len(known) > CACHE_WORDS:
                known.clear()
            raw = [word_codes(t, known) for t in common.byte_column(part, "text")]
            coded = pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(raw, pa.binary())], ["key", "text"]
            )
            yield coded.filter(pa.array([len(c) >= WORD_BYTES * words for c in raw], pa.bool_()))

    return common.map_arrow(texts, run, "key binary, text binary")


def spans_of_words(text: bytes, coded: list[tuple[int, int]], words: int) -> list[tuple[int, int]]:
    """Bytes of a text that spans of its codes stand for, whole words only.

    A span of codes covers windows one byte apart, of which those count that
    start with a word.
    """
    found = [(-(-a // WORD_BYTES), b // WORD_BYTES) for a, b in coded]
    found = [(a, b) for a, b in found if b - a >= words]
    if not found:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in found]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _cut(value: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for span in spans for e in span), len(value)]
    return b"".join(value[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _kept(
    batch: pa.RecordBatch, as_text: bool, words: int | None, both: bool, with_text: bool
) -> pa.RecordBatch:
    """What remains of some texts (``doc_id, text, spans, coded``) without their spans."""
    raw = common.byte_column(batch, "text")
    spans, coded = (
        [[(s["start"], s["end"]) for s in own] for own in batch.column(c).to_pylist()]
        for c in ("spans", "coded")
    )
    passages = [merged(spans_of_words(t, own, words)) if own else [] for t, own in zip(raw, coded)]
    spans = [merged(own) for own in spans]
    gone = [merged(a + b) for a, b in zip(spans, passages)] if both else spans
    kept = [_cut(value, own) for value, own in zip(raw, gone)]
    texts = [k.decode("utf-8", "ignore") for k in kept] if as_text or with_text else []
    structs = [
        pa.array([[{"start": a, "end": b} for a, b in own] for own in found], batch.column("spans").type)
        for found in (spans, passages)
    ]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(list(map(len, raw)), pa.int64()),
            *structs,
            pa.array(texts, pa.string()) if as_text else pa.array(kept, pa.binary()),
            *([pa.array(texts, pa.string())] if with_text else []),
        ],
        ["doc_id", "n_bytes", "spans", "passages", "kept", *(["text"] if with_text else [])],
    )


def remove_repeats(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int | None = LENGTH,
    as_text: bool = False,
    words: int | None = None,
    cut_passages: bool = True,
    with_text: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, spans, passages, kept`` of every row.

    ``spans`` are the maximal runs of bytes covered by any string of ``length``
    bytes that also starts elsewhere, in the same text or another one; ``passages``
    the runs covered by any ``words`` words that do, whatever is between them. One
    of the two may be left out. ``kept`` is what remains without spans, and without
    passages unless ``cut_passages`` is false, as binary, or as text without
    characters that were cut in two; ``with_text`` adds that text as a column ``text``
    beside the binary one. All places of a repeated string count, and all
    are judged on the input. A null text is empty. Repeated rows are repeats of
    each other like any other equal texts; other columns are left out.
    """
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    ).withColumn("key", _key(F.col("text")))
    texts = rows.select("key", "text")
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    found = []
    if length is not None:
        found.append(repeated_spans(texts, length).withColumn("coded", none))
    if words is not None:
        coded = common.stored_once(_coded(texts, words), "coded")
        in_words = repeated_spans(coded, WORD_BYTES * words)
        found.append(in_words.select("key", none.alias("spans"), F.col("spans").alias("coded")))
    if len(found) == 2:
        found = [
            found[0].drop("coded").join(found[1].drop("spans"), "key", "full").select(
                "key", F.coalesce("spans", none).alias("spans"), F.coalesce("coded", none).alias("coded")
            )
        ]
    if not found:
        raise ValueError("give a length in bytes, in words or both")
    spans = common.stored_once(found[0], "spans")
    marked = maybe_in(rows, "key", spans, "key", "likely")
    plain = marked.where("NOT likely").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        none.alias("spans"),
        none.alias("passages"),
        F.col("text").cast("string" if as_text else "binary").alias("kept"),
        *(["text"] if with_text else []),
    )
    touched = (
        marked.where("likely")
        .join(spans, "key", "left")
        .select(
            "doc_id",
            "text",
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("coded", none).alias("coded"),
        )
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_pylist()
            for first, last in common.chunks(sizes, 4 * BLOCK):
                part = batch.slice(first, last - first)
                yield _kept(part, as_text, words, cut_passages, with_text)

    kind = rows.schema["doc_id"].dataType.simpleString()
    listed = "array<struct<start: bigint, end: bigint>>"
    removed = common.map_arrow(
        touched,
        cut,
        f"doc_id {kind}, n_bytes long, spans {listed}, passages {listed}, "
        f"kept {'string' if as_text else 'binary'}{', text string' if with_text else ''}",
    )
    return plain.unionByName(removed)


def without_repeats(
    documents: DataFrame,
    text: str = "text",
    length: int | None = LENGTH,
    characters: str = "n_chars",
    words: int | None = None,
) -> DataFrame:
    """All rows and columns, the text without its repeated spans.

    Spans are of ``length`` bytes, of ``words`` words, or of both kinds.

    A character that is cut in two goes as a whole. The column ``characters``, if
    there is one, follows the new length. A null text becomes an empty one.
    """
    others = [c for c in documents.columns if c != text]
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("others"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    removed = remove_repeats(rows, "others", "text", length, as_text=True, words=words)
    columns = {c: F.col(f"doc_id.`{c}`") for c in others} | {text: F.col("kept")}
    if characters in columns and characters != text:
        kind = documents.schema[characters].dataType
        columns[characters] = F.length("kept").cast(kind)
    return removed.select(*[columns[c].alias(c) for c in documents.columns])
