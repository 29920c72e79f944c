from freightlake.functions.columns import (
    half_even,
    highest,
    is_in,
    lowest,
    settled,
    sum_or_null,
    to_int,
)
from freightlake.functions.draws import keyed_uniform

__all__ = [
    "half_even",
    "highest",
    "is_in",
    "keyed_uniform",
    "lowest",
    "settled",
    "sum_or_null",
    "to_int",
]
