"""The four success/failure definitions.  They disagree; never unify them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglens.functions.status import _col
from loglens.schema import OK_MESSAGE


def success_2xx(code: Column | str) -> Column:
    """Status string starts with ``2`` (``"2xx"`` and ``"20000"`` succeed)."""
    return _col(code).startswith("2")


def failure_not_ok_message(message: Column | str) -> Column:
    """Message lacks ``HTTP Status Code: 200``; a missing message fails."""
    return ~F.coalesce(_col(message), F.lit("")).contains(OK_MESSAGE)


def success_below_400(status: Column | str) -> Column:
    """``status < 400`` as int 0/1 (1xx and 3xx succeed); null status -> null."""
    return (_col(status) < 400).cast("int")


def error_4xx_5xx(status: Column | str) -> Column:
    """The documented error class: a status in 400..599."""
    return _col(status).between(400, 599)
