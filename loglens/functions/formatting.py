"""Result formatting: ``%.4f`` values and Python-style datetimes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglens.functions.status import _col
from loglens.functions.timefn import epoch_micros


def format_value(value: Column | str, digits: int = 4) -> Column:
    """``%.{digits}f``, rounded half-even on the exact binary value.

    ``format_number`` rounds like C's printf (and Python's format); it only
    adds thousands separators, which are removed.
    """
    return F.regexp_replace(F.format_number(_col(value), digits), ",", "")


def format_timestamp(ts_ntz: Column | str, with_micros: bool = True) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` plus ``.ffffff`` when the micros are non-zero
    (``str(datetime)``); ``with_micros=False`` gives the display format."""
    c = _col(ts_ntz)
    # the string form of a TIMESTAMP_NTZ involves no zone (``date_format``
    # would convert through the session zone and shift DST-gap wall clocks)
    base = F.substring(c.cast("timestamp_ntz").cast("string"), 1, 19)
    if not with_micros:
        return base
    micros = F.pmod(epoch_micros(c), F.lit(1_000_000))
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(base, F.coalesce(frac, F.lit("")))
