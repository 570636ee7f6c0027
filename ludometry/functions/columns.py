"""Built-in column expressions only, so every caller stays inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds of 0001-01-01 and 9999-12-31T23:59:59, the range a timestamp
# can show. Larger numbers are almost always milliseconds sent by mistake.
MIN_EPOCH = -62_135_596_800
MAX_EPOCH = 253_402_300_799
SECONDS_PER_DAY = 86_400


def lower_trim(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def upper_trim(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def _sane_epoch(name: str) -> Column:
    seconds = F.col(name)
    return F.when(seconds.between(MIN_EPOCH, MAX_EPOCH), seconds)


def epoch_timestamp(name: str) -> Column:
    """Epoch seconds as an instant; null where the number is out of range."""
    return F.timestamp_seconds(_sane_epoch(name))


def epoch_date(name: str) -> Column:
    """UTC calendar day of epoch seconds, whatever the session time zone is."""
    days = F.floor(_sane_epoch(name) / F.lit(SECONDS_PER_DAY))
    return F.date_from_unix_date(days.cast("int"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half(value: Column, digits: int) -> Column:
    """Scale, round, unscale.

    ``F.round(x, n)`` rounds the decimal text of a double and differs from a
    columnar database's ``round`` on true ties such as 201/400.
    """
    scale = F.lit(float(10**digits))
    return F.round(value * scale) / scale


def record_digest(payload: Sequence[str], corrupt: str = "invalid_record") -> Column:
    """Digest of a raw line that did not parse, or of the fields of one that did."""
    return F.sha2(F.coalesce(F.col(corrupt), F.to_json(F.struct(*payload))), 256)


def content_key(key: str, payload: Sequence[str], corrupt: str = "invalid_record") -> Column:
    """Identity of a record that may lack its key.

    A record with a key is identified by it. One without is identified by a
    digest of its raw line, or of its fields where the line was well-formed.
    The one-letter tag keeps both kinds from meeting in one join.
    """
    return F.when(F.col(key).isNotNull(), F.concat(F.lit("k"), F.col(key))).otherwise(
        F.concat(F.lit("d"), record_digest(payload, corrupt))
    )
