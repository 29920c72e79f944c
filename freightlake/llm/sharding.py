"""Placement of rows on shards by a permutation-filled lookup table.

Each shard walks the slots of a prime-sized table in an order of its own; the
shards take turns and each claims the first slot of its order that is free. A
row's key hashes to a slot and the slot names the shard. A shard that joins or
leaves moves few other keys, and all shards hold nearly the same number of slots.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A table of over a hundred slots for each shard keeps shares within a percent
# or two of each other.
SLOTS = 2039
SHARDS = tuple(f"shard-{i:02d}" for i in range(16))


def _number(text: str) -> int:
    """The first 60 bits of a digest, which SQL engines work out alike."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], slots: int) -> list[int]:
    """Index of the shard that owns each slot; the size is that of ``slots``."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names")
    divisors = range(2, math.isqrt(slots) + 1)
    if slots < len(shards) or any(slots % d == 0 for d in divisors):
        raise ValueError("slots must be a prime not less than the number of shards")
    offset = [_number(f"offset:{name}") % slots for name in shards]
    skip = [_number(f"skip:{name}") % (slots - 1) + 1 for name in shards]
    steps = [0] * len(shards)
    owner = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[at := (offset[shard] + steps[shard] * skip[shard]) % slots] >= 0:
            steps[shard] += 1
        owner[at] = shard
    return owner


def table_frame(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """The filled table as ``slot, shard``, one row for each slot."""
    owners = ",".join(map(str, fill_table(shards, slots)))
    names = F.split(F.lit("\x1f".join(shards)), "\x1f")
    cells = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")))
    return cells.select(
        F.col("pos").alias("slot"),
        F.element_at(names, F.col("col").cast("int") + 1).alias("shard"),
    )


def slot_of(key: Column, slots: int) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    return (number % slots).cast("int")


def place(
    rows: DataFrame,
    key: str = "doc_id",
    shards: tuple[str, ...] = SHARDS,
    slots: int = SLOTS,
    slot_column: str = "slot",
    shard_column: str = "shard",
) -> DataFrame:
    """All columns of ``rows`` with the slot and the shard of each row.

    Rows are looked up where they are: the table of ``slots`` rows is broadcast
    and nothing is shuffled, so a key that holds a third of all rows costs no
    more than others. Repeated keys go to one shard; a null key is placed like
    an empty one. Input columns named as the two results are replaced.
    """
    cells = table_frame(rows.sparkSession, list(shards), slots)
    kept = [c for c in rows.columns if c not in (slot_column, shard_column)]
    keyed = rows.select(
        *[F.col(f"`{c}`") for c in kept],
        slot_of(F.col(f"`{key}`"), slots).alias(slot_column),
    )
    looked_up = F.broadcast(cells.toDF(slot_column, shard_column))
    joined = keyed.join(looked_up, slot_column)
    return joined.select(*[f"`{c}`" for c in kept], slot_column, shard_column)


PLACE_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT range AS shard, 'shard-' || lpad(range::VARCHAR, 2, '0') AS name
  FROM range({len(SHARDS)})
), orders AS (
  SELECT shard, name,
    ('0x' || substr(md5('offset:' || name), 1, 15))::BIGINT % {SLOTS} AS first_slot,
    ('0x' || substr(md5('skip:' || name), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS skip
  FROM shards
), preferred AS (
  SELECT shard, list_transform(range({SLOTS}), lambda j: (first_slot + j * skip) % {SLOTS}) AS slots
  FROM orders
), filled AS (
  SELECT 0::BIGINT AS turn, repeat('.', {SLOTS}) AS owners
  UNION ALL
  SELECT turn + 1, owners[:claimed] || chr((97 + turn % {len(SHARDS)})::INTEGER) || owners[claimed + 2:]
  FROM (
    SELECT f.turn, f.owners,
      list_filter(p.slots, lambda s: substr(f.owners, s + 1, 1) = '.')[1] AS claimed
    FROM filled f JOIN preferred p ON p.shard = f.turn % {len(SHARDS)}
    WHERE f.turn < {SLOTS}
  )
), cells AS (
  SELECT slot, ascii(substr(owners, slot + 1, 1)) - 97 AS shard
  FROM filled, range({SLOTS}) AS slots(slot) WHERE turn = {SLOTS}
), keyed AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS})::INTEGER AS slot
  FROM documents
)
SELECT k.doc_id, k.slot, s.name AS shard
FROM keyed k JOIN cells c ON c.slot = k.slot JOIN shards s ON s.shard = c.shard
"""
