"""Near duplicates by SimHash fingerprints and BK-trees.

A fingerprint has 64 bits, each the majority of that bit in the hashes of a
text's word shingles. Equal fingerprints are first reduced to one. Fingerprints
that differ in three bits or fewer agree in at least one of four blocks of 16
bits, and, of what is left, in at least one of four blocks of 12: those 28 bits
and their place name a shard, and each fingerprint belongs to 16 shards. A task
builds the tree of each of its shards, with children keyed by their Hamming
distance to the parent, and follows from a node only the edges whose distance
can still lead to a fingerprint within the radius. A shard passes on links
that connect what it found, fewer than it has members; components follow from
the links of all shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common
from freightlake.llm.bitmaps import maybe_in
from freightlake.llm.components import connected_components

RADIUS = 3
SHINGLE = 3
SEED = 42

# Bytes of text that a worker takes at a time.
CHUNK = 2_000_000

_EMPTY = np.empty(0, np.uint64)


def shingle_hashes(text: bytes, width: int, seed: int) -> np.ndarray:
    """Hashes of all word shingles, repeats included; ``text`` in lower case."""
    words = text.split()
    if not words:
        return _EMPTY
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    joined = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, seed) for s in joined), np.uint64, len(words) - width + 1)


def simhash(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have; zero without any."""
    sums = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        raw = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        sums += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * sums > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, bits`` of every whole text, the 64 bits as a signed number.

    Letters A to Z count as lower case. A text with fewer words than a shingle
    has one shingle, all its words; one without words, null ones included, has
    the fingerprint zero.
    """
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            raw = common.byte_column(batch, "text")
            bits = [simhash(shingle_hashes(t.lower(), width, seed)) for t in raw]
            signed = np.array(bits, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], ["doc_id", "bits"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(rows, run, f"doc_id {kind}, bits long")


class Tree:
    """A BK-tree of fingerprints: children keyed by their distance to the parent."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, bits: int) -> None:
        new = len(self.nodes)
        self.nodes.append(bits)
        self.children.append({})
        if not new:
            return
        at = 0
        while True:
            distance = (bits ^ self.nodes[at]).bit_count()
            below = self.children[at].setdefault(distance, new)
            if below == new:
                return
            at = below

    def within(self, bits: int, radius: int) -> list[int]:
        """Nodes whose distance to ``bits`` is at most ``radius``."""
        found, open_nodes = [], [0] if self.nodes else []
        while open_nodes:
            at = open_nodes.pop()
            distance = (bits ^ self.nodes[at]).bit_count()
            if distance <= radius:
                found.append(at)
            for edge, below in self.children[at].items():
                if distance - radius <= edge <= distance + radius:
                    open_nodes.append(below)
        return found


def shard_links(members: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect the members of one shard as those within the radius do."""
    tree, parent = Tree(), list(range(len(members)))

    def root(at: int) -> int:
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    for new, bits in enumerate(members):
        for other in tree.within(bits, radius):
            a, b = root(new), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(bits)
    return [(m, members[root(i)]) for i, m in enumerate(members) if root(i) != i]


def _shards(bits: Column) -> list[Column]:
    """The 16 shards of a fingerprint: places of the two blocks, and their bits."""
    out = []
    for outer in range(4):
        block = F.shiftrightunsigned(bits, 16 * outer).bitwiseAND(F.lit(0xFFFF))
        low = bits.bitwiseAND(F.lit((1 << (16 * outer)) - 1))
        if outer == 3:
            rest = low
        else:
            high = F.shiftrightunsigned(bits, 16 * (outer + 1))
            rest = F.shiftleft(high, 16 * outer).bitwiseOR(low)
        for inner in range(4):
            part = F.shiftrightunsigned(rest, 12 * inner).bitwiseAND(F.lit(0xFFF))
            place = F.lit((4 * outer + inner) << 28).cast("long")
            out.append(place + F.shiftleft(block, 12) + part)
    return out


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``u, v`` of distinct fingerprints, connected as by all pairs in the radius."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"shards find pairs up to {RADIUS} bits apart")
    sharded = distinct.select("bits", F.explode(F.array(*_shards(F.col("bits")))).alias("shard"))
    together = sharded.repartition("shard").sortWithinPartitions("shard", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_shard, held_bits = np.empty(0, np.int64), np.empty(0, np.int64)

        def linked(shard: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else shard
            sizes = np.diff(np.r_[starts, len(shard)])
            out: list[tuple[int, int]] = []
            for at, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                members = bits[at : at + size].astype(np.uint64).tolist()
                out += shard_links(members, radius)
            ends = np.array(out, np.uint64).reshape(-1, 2).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["u", "v"]
            )

        for batch in batches:
            shard = np.r_[held_shard, batch.column("shard").to_numpy()]
            bits = np.r_[held_bits, batch.column("bits").to_numpy()]
            if not len(shard):
                continue
            # The last shard may go on in the next batch.
            cut = int(np.searchsorted(shard, shard[-1]))
            held_shard, held_bits = shard[cut:], bits[cut:]
            yield linked(shard[:cut], bits[:cut])
        yield linked(held_shard, held_bits)

    return common.map_arrow(together, run, "u long, v long")


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``bits, root, least``: component of each fingerprint and its least ``first``."""
    stars = connected_components(links)
    rooted = classes.join(stars, classes["bits"] == stars["u"], "left").select(
        "bits", "first", F.coalesce("v", "bits").alias("root")
    )
    # Only classes that have links need the least of their component.
    least = (
        rooted.join(stars.select(F.col("v").alias("root")).distinct(), "root", "left_semi")
        .groupBy("root")
        .agg(F.min("first").alias("least"))
    )
    return rooted.join(least, "root", "left").select(
        "bits", "root", F.coalesce("least", "first").alias("least")
    )


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
    radius: int = RADIUS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Documents whose fingerprints differ in ``radius`` bits or fewer are linked;
    ``component_id`` is the smallest id that links reach. Texts without words are
    linked like any other, by their fingerprint zero. Repeated rows are repeated;
    null ids are never a component's id unless it has no other.
    """
    marked = common.stored_once(
        fingerprints(documents, doc_id, text, width, seed), "fingerprints"
    )
    classes = common.stored_once(
        marked.groupBy("bits").agg(F.min("doc_id").alias("first")), "classes"
    )
    named = _components(classes, near_links(classes.select("bits"), radius)).select(
        "bits", F.col("least").alias("component_id")
    )
    return marked.join(named, "bits").select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
    radius: int = RADIUS,
) -> DataFrame:
    """All columns of one row of each component: that of the smallest id.

    Rows are linked by fingerprints within ``radius`` bits. Texts without words
    have the fingerprint zero and are linked like any other.

    Of rows with that id the one with the least hash of its text stays, and of
    rows that are alike in both any one; null ids come last. Texts of documents
    that are near no other are not shuffled.
    """
    rows = documents.withColumns(
        {
            "_id": F.col(doc_id),
            "_key": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
        }
    )
    texts = rows.select(F.struct("_id", "_key").alias("who"), F.col(text).alias("words"))
    order = F.struct(F.col("doc_id._id").isNull().alias("last"), "doc_id._id", "doc_id._key")
    own = [F.min("who").alias("first"), F.count(F.lit(1)).alias("n")]
    marked = fingerprints(texts, "who", "words", width, seed)
    marked = common.stored_once(marked.select(order.alias("who"), "bits"), "fingerprints")
    classes = common.stored_once(marked.groupBy("bits").agg(*own), "classes")
    links = near_links(classes.select("bits"), radius)
    named = common.stored_once(_components(classes.select("bits", "first"), links), "named")
    # Components of several rows, however these are spread over fingerprints.
    sizes = named.join(classes.select("bits", "n"), "bits").groupBy("root").agg(
        F.sum("n").alias("rows"), F.min("least").alias("stays")
    )
    crowded = common.stored_once(sizes.where("rows > 1").select("root", "stays"), "crowded")
    members = named.join(crowded, "root", "left_semi").select("bits")
    touched = common.stored_once(
        marked.join(members, "bits", "left_semi").select("who._id", "who._key").distinct(),
        "touched",
    ).withColumn("_who", F.xxhash64("_id", "_key"))
    judged = maybe_in(
        rows.withColumn("_who", F.xxhash64("_id", "_key")), "_who", touched, "_who", "_likely"
    )
    alone = judged.where("NOT _likely")
    likely = judged.where("_likely")
    same = F.col("l._id").eqNullSafe(F.col("r._id")) & (F.col("l._key") == F.col("r._key"))
    apart = likely.alias("l").join(touched.alias("r"), same, "left_anti")
    stays = crowded.select("stays._id", "stays._key").distinct()
    staying = (
        likely.alias("l")
        .join(stays.alias("r"), same, "left_semi")
        .dropDuplicates(["_id", "_key"])
    )
    kept = alone.unionByName(apart).unionByName(staying)
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])
