"""Broadcast only what was seen to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup tables here are a few narrow columns wide, so this is some 20 MB.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20

_KNOWN = "_freightlake_rows"


def bounded(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame | None:
    """``df`` as a local table, or None if it has more rows or bytes than allowed.

    A broadcast table passes through the driver in any case. Fetching one row
    more than allowed proves its size on the way, works its lineage out once
    instead of once to count and again to use, and stops early otherwise. The
    table is a single partition, so windows over it need no shuffle. What this
    gave before, and what a session was handed as a local table, is not fetched
    again.
    """
    if max_rows <= 0:
        return None
    known = getattr(df, _KNOWN, None)
    if known is None and df.isLocal():
        # No job: the rows are in the driver already.
        known = len(df.limit(max_rows + 1).collect())
        if known <= max_rows:
            return _marked(df.coalesce(1), known)
    if known is not None:
        return df if known <= max_rows else None
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return None
    local = df.sparkSession.createDataFrame(rows, df.schema).coalesce(1)
    return _marked(local, rows.num_rows)


def _marked(df: DataFrame, rows: int) -> DataFrame:
    setattr(df, _KNOWN, rows)
    return df


def part_of(df: DataFrame, whole: DataFrame) -> DataFrame:
    """``df``, some columns or rows of ``whole``: as small as that is known to be."""
    known = getattr(whole, _KNOWN, None)
    return df if known is None else _marked(df, known)


def together(df: DataFrame, *wholes: DataFrame) -> DataFrame:
    """``df`` as a single partition again, where all of ``wholes`` are local.

    Laying out columns as rows makes Spark forget that there is only one.
    """
    if all(getattr(w, _KNOWN, None) is not None for w in wholes):
        return df.coalesce(1)
    return df


def beside(df: DataFrame, *wholes: DataFrame) -> DataFrame:
    """The right side of a join of tables that come from ``wholes``.

    Where all of these are local, both sides are single partitions: a hash join in
    place needs neither a shuffle nor a broadcast, so the lookup is one task.
    """
    if all(getattr(w, _KNOWN, None) is not None for w in wholes):
        return df.hint("shuffle_hash")
    return df


def local_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The local form of a small table; a larger one as it is."""
    local = bounded(df, max_rows)
    return df if local is None else local


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Hint a broadcast for a table seen to be small.

    A larger table is returned as it is: Spark then shuffles both sides, and
    adaptive execution splits the partitions of a hot key.
    """
    local = bounded(df, max_rows)
    return df if local is None else F.broadcast(local)
