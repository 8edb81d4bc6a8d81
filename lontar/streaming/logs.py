"""Structured logs: one JSON object a line."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

from pyspark.sql.streaming import StreamingQueryListener


class JsonLines(logging.Formatter):
    """Log records as JSON: time, level, message, and what ``extra={"fields": {...}}`` adds."""

    def format(self, record: logging.LogRecord) -> str:
        said = {"time": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname.lower(), "message": record.getMessage()}
        return json.dumps(said | getattr(record, "fields", {}), ensure_ascii=False, default=str)


def logger(name: str = "lontar", handler: logging.Handler | None = None) -> logging.Logger:
    """A logger that writes JSON lines, to stderr by default."""
    log = logging.getLogger(name)
    if handler is not None or not log.handlers:
        h = handler or logging.StreamHandler()
        h.setFormatter(JsonLines())
        log.addHandler(h)
    log.setLevel(logging.INFO)
    log.propagate = False
    return log


class ProgressLog(StreamingQueryListener):
    """Logs the start, the progress and the end of streaming queries."""

    def __init__(self, log: logging.Logger) -> None:
        self.log = log

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.log.info("query started", extra={"fields": {"query": str(event.id), "name": event.name}})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.log.info("query progress", extra={"fields": {"query": str(p.id), "batch": p.batchId, "rows": p.numInputRows}})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.log.info("query ended", extra={"fields": {"query": str(event.id), "error": event.exception}})
