"""DuckDB SQL twins of the registered queries (the correctness oracle).

Every view and expression is generated from the same fixed values as the
Spark side, so the two can only disagree on semantics, not on constants.
"""

from __future__ import annotations

from loglens.schema import (
    OK_MESSAGE,
    SERVICES,
    STATUS_CODES,
    STATUS_REGEX,
    STATUS_TAG,
)
from loglens.sources.views import BATCH_SIZE, DIRT_RULES, LATE_EVERY, LATE_SPREAD


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def pmod(x: str, n: int) -> str:
    return f"((({x}) % {n}) + {n}) % {n}"


def ts_micros(x: str) -> str:
    """Epoch seconds -> TIMESTAMP, micros rounded half-even."""
    return f"make_timestamp(TRY_CAST(round_even(({x}) * 1000000.0, 0) AS BIGINT))"


def ts_seconds(x: str) -> str:
    """Epoch seconds -> TIMESTAMP truncated to the second."""
    return f"make_timestamp(TRY_CAST(trunc({x}) AS BIGINT) * 1000000)"


def status_regex(m: str = "message") -> str:
    return f"TRY_CAST(regexp_extract({m}, {q(STATUS_REGEX)}, 1) AS INTEGER)"


# the white space that Python's str.split() splits at, as code points
_WHITE = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def status_strict(m: str = "message") -> str:
    """First token after the tag, by position and splitting (no regular expression:
    the Spark side uses one, so the two check each other)."""
    after = f"substr({m}, strpos({m}, {q(STATUS_TAG)}) + {len(STATUS_TAG)})"
    spaced = f"translate({after}, {' || '.join(f'chr({c})' for c in _WHITE)}, repeat(' ', {len(_WHITE)}))"
    return (f"CASE WHEN strpos(coalesce({m}, ''), {q(STATUS_TAG)}) > 0 "
            f"THEN list_filter(string_split({spaced}, ' '), lambda t: t <> '')[1] END")


def status_last(m: str = "message") -> str:
    return f"(string_split({m}, ': '))[-1]"


def failure_not_ok(m: str = "message") -> str:
    return f"NOT contains(coalesce({m}, ''), {q(OK_MESSAGE)})"


def log_view(dirty: bool = False, late: bool = False) -> str:
    """SELECT producing (event_id, batch_id, pos, service, timestamp, message)."""
    batch = f"(event_id // {BATCH_SIZE})"
    if late:
        batch = (f"({batch} + CASE WHEN event_id % {LATE_EVERY} = 0 "
                 f"THEN 1 + event_id % {LATE_SPREAD} ELSE 0 END)")
    services = "[" + ", ".join(q(s) for s in SERVICES) + "]"
    codes = "[" + ", ".join(str(c) for c in STATUS_CODES) + "]"
    k = "TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT)"
    cols = {
        "service": f"({services})[{pmod('user_id', len(SERVICES))} + 1]",
        "timestamp": "(epoch_us(ts) / 1000000.0)",
        "message": f"({q(STATUS_TAG)} || CAST(({codes})[{pmod(k, len(STATUS_CODES))} + 1] AS VARCHAR))",
    }
    if dirty:
        kind = "CASE " + " ".join(
            f"WHEN event_id % {div} = 0 THEN {i}" for i, (div, _, _) in enumerate(DIRT_RULES)) + " END"
        for col in ("service", "timestamp", "message"):
            whens = []
            for i, (_, target, value) in enumerate(DIRT_RULES):
                if target == col:
                    typ = "DOUBLE" if col == "timestamp" else "VARCHAR"
                    lit = "NULL" if value is None else (q(value) if isinstance(value, str) else repr(value))
                    whens.append(f"WHEN {i} THEN CAST({lit} AS {typ})")
            if whens:
                cols[col] = f"CASE ({kind}) {' '.join(whens)} ELSE {cols[col]} END"
    return (
        f"SELECT event_id, CAST({batch} AS BIGINT) AS batch_id, "
        f"CAST(event_id % {BATCH_SIZE} AS BIGINT) AS pos, "
        f"{cols['service']} AS service, CAST({cols['timestamp']} AS DOUBLE) AS \"timestamp\", "
        f"{cols['message']} AS message FROM events"
    )


def with_view(body: str, dirty: bool = False, late: bool = False) -> str:
    return f"WITH v AS ({log_view(dirty, late)}) {body}"
