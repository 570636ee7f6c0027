"""Column expressions shared by the operators."""

from ludometry.functions.columns import (
    content_key,
    epoch_date,
    epoch_timestamp,
    lower_trim,
    ratio,
    record_digest,
    round_half,
    upper_trim,
)

__all__ = [
    "content_key",
    "epoch_date",
    "epoch_timestamp",
    "lower_trim",
    "ratio",
    "record_digest",
    "round_half",
    "upper_trim",
]
