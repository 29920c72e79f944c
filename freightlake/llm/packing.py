"""Best-fit packing of documents into sequences, certified by lower bounds.

Every partition packs its pieces by best-fit decreasing and works out a lower
bound on its sequences from dual feasible functions: functions u of a length
with sum(u) <= 1 for whatever fits into one sequence, so the sum of u over all
pieces is a bound. A partition that reaches its bound is certified; what remains
to be won lies between partitions. Those with gaps hand over the documents of
their open sequences; these meet in fewer, other partitions, where best-fit
decreasing runs again, until one partition holds what is left or a round wins
nothing any more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common
from freightlake.llm.token_counts import CHUNK, WORD_BPE, split_words, word_ids

SEQUENCE = 4096
END_OF_TEXT = 1

# Pieces that meet in one partition, the gap from which a sequence is open, and
# the rounds of exchange.
PIECES = 50_000
GAP = 16
ROUNDS = 6

PIECE_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def tokenized_pieces(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = WORD_BPE,
    length: int = SEQUENCE,
    end_id: int = END_OF_TEXT,
    with_ids: bool = True,
) -> DataFrame:
    """Token ids of every document, cut into pieces of at most ``length``.

    A document is the ids of its whole text and then ``end_id``; only longer ones
    are cut. Gives ``doc_id, piece, start, length, ids_crc32`` and, if wanted,
    ``ids``. A null text is an empty one, of one piece that holds ``end_id``.
    """
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for part in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            split = [split_words(t) for t in common.text_column(part, "text")]
            words.learn(set(chain.from_iterable(split)))
            of = words.known.__getitem__
            rows_of, out = [], []
            for at, own in enumerate(split):
                raw = b"".join([*map(of, own), end])
                for piece, start in enumerate(range(0, len(raw) // 4, length)):
                    ids = raw[4 * start : 4 * (start + length)]
                    rows_of.append(at)
                    out.append((piece, start, len(ids) // 4, zlib.crc32(ids), ids))
            piece, start, size, crc, ids = zip(*out, strict=True)
            columns = [
                part.column("doc_id").take(pa.array(rows_of)),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = list(PIECE_COLUMNS)
            if with_ids:
                columns.append(pa.array([np.frombuffer(p, "<i4") for p in ids]))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return common.map_arrow(rows, cut, schema + (", ids array<int>" if with_ids else ""))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, longest first into the fullest bin that holds it.

    Open bins are kept by the room they have left, and the rooms in use as the
    bits of one number, so the tightest fit is its lowest bit from the length on.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    used = 0
    for at, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            own, room = used, capacity
            used += 1
        bins[at], offsets[at] = own, capacity - room
        left = room - size
        if left:
            by_room[left].append(own)
            rooms |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins, by two families of dual feasible functions.

    For a threshold e: lengths over capacity - e count 1, those under e count 0,
    the rest count in proportion. For a number k: a length x counts
    floor((k + 1) x / capacity) / k, or x / capacity where that is whole.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    for e in range(1, capacity // 2 + 1, max(1, capacity // 256)):
        inner = (sizes >= e) & (sizes <= capacity - e)
        whole = int(counts[sizes > capacity - e].sum()) * capacity
        best = max(best, -(-(whole + int((sizes * counts)[inner].sum())) // capacity))
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def pack(
    pieces: DataFrame,
    capacity: int = SEQUENCE,
    per_partition: int = PIECES,
    gap: int = GAP,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``pieces`` with ``sequence_id``, ``offset``, and their certificate.

    ``pieces`` has ``doc_id``, ``piece`` and ``length`` (1 to ``capacity``); all
    columns but those added are kept. The pieces of one sequence lie without a
    gap from offset 0. ``partition_sequences`` and ``partition_bound`` tell how
    many sequences the partition needed and how many it needs at least.

    Pieces as long as a sequence fill one each and take no part. The others meet
    by a hash of their key, ``per_partition`` of them at a time in the mean. A
    partition whose number of sequences equals its bound is certified: it is final
    but for one sequence that is at most half full. Others hand the pieces of all
    sequences with room on, to be packed anew with those of other partitions.
    Every round is written to the shared folder, so a lost executor costs a
    round. The last round ends with what is in it; none is left out.
    """
    spark = pieces.sparkSession
    added = ["sequence_id", "offset", "partition_sequences", "partition_bound"]
    pieces = pieces.drop(*added, "part", "bin", "open", "salt")
    full = F.col("length") >= capacity
    salt = F.when(full, F.lit(0)).otherwise(
        F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())
    )
    waiting = common.stored_once(pieces.withColumn("salt", salt), "pieces")
    columns = waiting.columns

    def packed(keys: tuple, part: pd.DataFrame) -> pd.DataFrame:
        lengths = part["length"].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, lengths)
        bound = lower_bound(lengths, capacity)
        open_bins = capacity - fill >= gap
        if len(fill) == bound:
            # Nothing in here can be packed better, but a sequence that is at most
            # half full may still meet another partition's.
            open_bins &= (np.arange(len(fill)) == fill.argmin()) & (2 * fill <= capacity)
        is_open = open_bins[bins]
        return part.assign(
            bin=bins,
            offset=offsets,
            open=is_open,
            partition_sequences=np.int64(len(fill)),
            partition_bound=np.int64(bound),
        )

    done: list[DataFrame] = []
    whole = waiting.where(full).select(
        *columns,
        F.lit(-1).alias("round"),
        F.monotonically_increasing_id().alias("part"),
        F.lit(0).cast("long").alias("bin"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(1).cast("long").alias("partition_sequences"),
        F.lit(1).cast("long").alias("partition_bound"),
    )
    done.append(whole)
    waiting = waiting.where(~full)
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in waiting.schema.fields
    )
    schema += (
        ", part long, bin long, offset long, open boolean, "
        "partition_sequences long, partition_bound long"
    )
    count, before = waiting.count(), None
    for turn in range(rounds):
        if not count:
            break
        parts = -(-count // per_partition)
        if before is not None and parts > 1:
            # Fewer partitions than before, or the same documents meet again.
            parts = min(parts, max(1, before // 2))
        dealt = waiting.withColumn(
            "part", F.pmod(F.xxhash64("salt", F.lit(turn)), F.lit(parts)).cast("long")
        )
        solved = common.stored_once(
            dealt.groupBy("part").applyInPandas(packed, schema), f"packed-{turn}"
        ).withColumn("round", F.lit(turn))
        last = parts == 1 or turn == rounds - 1
        kept = solved if last else solved.where(~F.col("open"))
        done.append(kept.drop("open"))
        if last:
            break
        waiting = solved.where("open").select(*columns)
        count, before = waiting.count(), parts

    result = done[0]
    for other in done[1:]:
        result = result.unionByName(other)
    # Round, partition and bin side by side in one number.
    number = F.when(F.col("round") < 0, -F.col("part") - 1).otherwise(
        F.shiftleft(F.col("round").cast("long"), 58)
        + F.shiftleft(F.col("part"), 26)
        + F.col("bin")
    )
    kept = [c for c in columns if c != "salt"]
    return result.withColumn("sequence_id", number).select(*kept, *added)


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence in order of offset, from pieces that carry ``ids``."""
    gathered = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces")
    )
    return gathered.select("sequence_id", F.flatten("pieces.ids").alias("ids"))


def certificate(packed: DataFrame, capacity: int = SEQUENCE) -> tuple[int, int]:
    """Sequences in use, and the lower bound for all pieces together.

    The bound needs the number of pieces of each length, ``capacity`` rows at most.
    """
    used = packed.select("sequence_id").distinct().count()
    sizes = packed.groupBy("length").count().collect()
    lengths = np.repeat([r.length for r in sizes], [r["count"] for r in sizes])
    return used, lower_bound(lengths.astype(np.int64), capacity)
