"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from freightlake.sources.tables import shared_folder, stored_once

__all__ = [
    "WordHashes",
    "blank",
    "byte_column",
    "chunks",
    "documents",
    "map_arrow",
    "shared_folder",
    "slices",
    "stored_once",
    "table",
    "text_column",
]

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
DEFAULT_BATCH, TEXT_BATCH = "67108864b", "4194304b"

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def blank(df: DataFrame, *columns: str) -> DataFrame:
    """Null texts read as empty ones."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in columns})


def _give_back() -> None:
    """Hand memory that a task no longer uses back to the system.

    Workers live on from stage to stage; what Arrow's pool and the C library keep
    for later would add up beside the JVM's heap.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        # Other C libraries have no such call.
        pass


def map_arrow(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` whose workers find this package.

    A session started elsewhere does not hand its import path to the Python
    workers; on a cluster the package is sent with ``--py-files`` as usual. Where
    the session leaves the size of Arrow batches at its default, it is made
    smaller, as each batch of texts is held several times on its way.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES) == DEFAULT_BATCH:
        conf.set(BATCH_BYTES, TEXT_BATCH)
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if ROOT not in re.split(os.pathsep, paths):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, paths) if p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _give_back()

    return df.mapInArrow(run, schema)


class WordHashes(dict):
    """Hashes of words; one that is asked for the first time is worked out."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def text_column(batch: pa.RecordBatch, name: str) -> list[str]:
    return batch.column(name).to_pylist()


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``most`` bytes together."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    for first, last in chunks(sizes, most):
        yield batch.slice(first, last - first)


def chunks(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows that hold about ``most`` units together.

    A row is never cut: one that is larger by itself is a range of its own.
    """
    start, held, at = 0, 0, -1
    for at, size in enumerate(sizes):
        if held and held + size > most:
            yield start, at
            start, held = at, 0
        held += size
    if at >= start:
        yield start, at + 1
