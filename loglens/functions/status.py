"""Status-code extraction from a log message, three flavours.

The three flavours disagree on edge cases on purpose; each operator uses
the one whose semantics it reproduces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglens.schema import STATUS_REGEX, STATUS_TAG

# --- Fixed values: the whitespace set of Python's ``str.split()`` ---
PY_WHITESPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# --- end of fixed values ---

# Tag, optional whitespace, then the first whitespace-free token.
STRICT_PATTERN = f"{STATUS_TAG}[{PY_WHITESPACE}]*([^{PY_WHITESPACE}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status_strict(message: Column | str) -> Column:
    """Text after the first ``"HTTP Status Code: "``, first token, as string.

    Null when the tag is absent or nothing but whitespace follows it.
    """
    m = F.coalesce(_col(message), F.lit(""))
    return F.nullif(F.regexp_extract(m, STRICT_PATTERN, 1), F.lit(""))


def status_regex(message: Column | str) -> Column:
    """``HTTP Status Code:\\s*(\\d+)`` group 1 as int; null on no match.

    ``try_cast``: under ANSI mode a plain cast of the no-match ``''`` raises.
    """
    return F.regexp_extract(_col(message), STATUS_REGEX, 1).try_cast("int")


def status_last_segment(message: Column | str) -> Column:
    """Text after the last ``": "``; the whole message when absent."""
    return F.element_at(F.split(_col(message), ": ", -1), -1)
