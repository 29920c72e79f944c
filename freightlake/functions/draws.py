"""Repeatable uniform draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightlake.functions.columns import as_column

HEX_DIGITS = 13  # 52 bits, all of a double's mantissa


def keyed_uniform(*keys: Column | str, stage: str, seed: int = 0) -> Column:
    """Uniform number in [0, 1) fixed by (seed, stage, keys).

    ``rand`` depends on how rows fall into partitions and changes when a lost
    task is run again; a digest of the row's own key does neither. ``stage``
    keeps the draws made for one row independent of each other. Each key is led
    by its length, and a NULL has a mark of its own, so different keys never make
    the same text.
    """

    def marked(key: Column | str) -> Column:
        text = as_column(key).cast("string")
        led = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(led, F.lit("-"))

    text = F.concat_ws("|", F.lit(str(seed)), F.lit(stage), *map(marked, keys))
    digits = F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**HEX_DIGITS))
