"""Structured Streaming forms of the operators.

Sources are file streams over a directory of JSON log files (the file
source's checkpoint replaces the reference's ``seen`` set); results go to
``foreachBatch`` sinks that write one table partition per micro-batch, so a
replayed micro-batch overwrites its own output (idempotent).
"""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Sequence

from pyspark.sql.streaming import StreamingQuery

from loglens.streaming.source import read_log_stream, read_raw_stream  # noqa: F401


def stop_after_drain(query, timeout_s: float | None = None) -> None:
    """Process everything already available, then stop (no result is lost)."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)


def run_available(query, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to finish, however long its input takes.

    With ``timeout_s`` a query still running then is stopped and the call raises."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} still running after {timeout_s}s")


def finish_batch(query: StreamingQuery, poll_s: float = 0.05) -> None:
    """Stop ``query`` between two micro-batches.

    One that starts in the instant before the stop is cut off; it has committed nothing, and a
    restart takes its files again and replaces its results."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(poll_s)
    query.stop()
    query.awaitTermination()


def run_until_signal(queries: Sequence[StreamingQuery], *, signals: Sequence[int] = (signal.SIGTERM, signal.SIGINT),
                     drain: bool = False, poll_s: float = 0.5) -> int | None:
    """Wait until all ``queries`` end or the process gets one of ``signals``; then let each finish its
    current micro-batch (with ``drain`` all that is available) and stop it.  Returns the signal, or None.

    Call it from the main thread.  The handler only raises a flag that the wait looks at: a handler that
    called Spark could break into a call that the main thread is in.  Old handlers are put back."""
    got: list[int] = []
    asked = threading.Event()

    def ask(number, _frame) -> None:
        got.append(number)
        asked.set()

    old = {s: signal.signal(s, ask) for s in signals}
    try:
        while not asked.is_set() and any(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(poll_s / len(queries))  # raises what ended a query with an error
        for q in queries:
            if asked.is_set() and q.isActive:
                if drain:
                    q.processAllAvailable()
                finish_batch(q)
    finally:
        for s, handler in old.items():
            signal.signal(s, handler)
    return got[0] if got else None
