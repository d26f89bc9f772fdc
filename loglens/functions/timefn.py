"""Epoch-second doubles to timestamps, independent of the session time zone.

Results are ``TIMESTAMP_NTZ`` (wall clock in UTC); arithmetic goes through
micro/second offsets from the NTZ epoch so no session zone is consulted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglens.functions.status import _col

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(ts_ntz: Column | str) -> Column:
    """Microseconds since the epoch of a ``TIMESTAMP_NTZ`` (UTC wall clock)."""
    c = _col(ts_ntz)
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)


def epoch_seconds(ts_ntz: Column | str) -> Column:
    """Epoch seconds with fraction (double) of a ``TIMESTAMP_NTZ``."""
    return epoch_micros(ts_ntz) / F.lit(1_000_000.0)


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Epoch seconds -> NTZ, micros kept, rounded half-even like Python's
    ``datetime.fromtimestamp``."""
    micros = F.bround(_col(seconds) * F.lit(1_000_000.0), 0).try_cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def epoch_to_timestamp_seconds(seconds: Column | str) -> Column:
    """Epoch seconds -> NTZ truncated to the second (``from_unixtime`` parity)."""
    secs = _col(seconds).try_cast("bigint")
    return F.timestamp_add("SECOND", secs, F.expr(_EPOCH_NTZ))
