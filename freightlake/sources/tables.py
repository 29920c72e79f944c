"""Read, write and describe tables kept in files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.operators.checks import ModelInputError

# Formats by extension, compressed extensions Spark reads and
# writes by itself.
FORMATS = {".csv": "csv", ".parquet": "parquet"}
COMPRESSION = {".gz": "gzip", ".bz2": "bzip2"}


def table_format(path: str, format: str = "unknown") -> tuple[str, str | None]:
    """Format and compression, from ``format`` or else from the extension."""
    name = path.rstrip("/").lower()
    compression = None
    for ending, codec in COMPRESSION.items():
        if name.endswith(ending):
            name, compression = name.removesuffix(ending), codec
    known = format.lower()
    if known == "unknown":
        known = next((f for end, f in FORMATS.items() if name.endswith(end)), known)
    if known not in FORMATS.values():
        raise ModelInputError(f"unrecognised format for {path}")
    return known, compression


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "unknown",
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read a table, compressed or not; give a schema to spare a pass over CSV.

    Plain CSV files are split over tasks. Set ``multi_line`` if quoted text
    holds line breaks; each file is then read by one task.
    """
    kind, _ = table_format(path, format)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        return reader.csv(
            path,
            header=True,
            inferSchema=schema is None,
            escape='"',
            multiLine=multi_line,
        )
    return reader.format(kind).load(path)


def write_table(
    df: DataFrame,
    path: str,
    overwrite: bool = True,
    format: str = "unknown",
    compression: str | None = None,
) -> None:
    """Write a table as a folder of part files, one per task."""
    kind, implied = table_format(path, format)
    codec = compression or implied
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    if codec:
        writer = writer.option("compression", codec)
    if kind == "csv":
        # Quotes are doubled inside quotes, as other CSV readers expect.
        writer = writer.option("header", True).option("escape", '"')
    writer.format(kind).save(path)


def file_attributes(df: DataFrame) -> DataFrame:
    """Path, time of change, size and records of each file behind a table."""
    return (
        df.select(
            "_metadata.file_path",
            "_metadata.file_modification_time",
            "_metadata.file_size",
        )
        .groupBy("file_path", "file_modification_time", "file_size")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach, as set by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named is None:
        raise ModelInputError("set spark.checkpoint.dir to a shared folder")
    return named


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Ends the lineage of a stage: what is lost later starts from the files.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}.parquet"
    write_table(df, path, overwrite=False)
    return df.sparkSession.read.schema(df.schema).parquet(path)
