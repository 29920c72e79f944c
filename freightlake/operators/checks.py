"""Guards: reject tables stay lazy, ``require_none`` runs one small job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

SHOWN = 20


class ModelInputError(ValueError):
    """Input tables do not fit together."""


def require_none(rejects: DataFrame, message: str) -> None:
    """Raise if ``rejects`` has rows, naming the first few."""
    sample = rejects.limit(SHOWN + 1).collect()
    if sample:
        shown = "; ".join(
            ", ".join(str(value) for value in row) for row in sample[:SHOWN]
        )
        more = " ..." if len(sample) > SHOWN else ""
        raise ModelInputError(f"{message}: {shown}{more}")


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ModelInputError(f"{what} lacks columns: {', '.join(missing)}")
