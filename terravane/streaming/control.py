"""Start, stop and watch the streaming queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.streaming import StreamingQuery


def status(queries: Iterable[StreamingQuery]) -> list[dict]:
    """Name, state, last batch and rows of each query."""
    lines = []
    for query in queries:
        progress = query.lastProgress
        error = query.exception()
        lines.append({
            "name": query.name,
            "running": query.isActive,
            "batch": progress["batchId"] if progress else None,
            "rows": progress["numInputRows"] if progress else None,
            "error": str(error) if error else None,
        })
    return lines


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def drain(queries: Iterable[StreamingQuery], seconds: int | None = None) -> None:
    """Wait until queries started with ``availableNow`` have read everything."""
    for query in queries:
        if seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            raise TimeoutError(f"stream {query.name} did not finish in {seconds} s")
