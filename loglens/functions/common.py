"""The safe ratio."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglens.functions.status import _col


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double, 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(_col(num), _col(den)), F.lit(0.0))
