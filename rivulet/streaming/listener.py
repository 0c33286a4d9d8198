"""Progress of streaming queries in Python's logs."""

from __future__ import annotations

import json
import logging

from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener


class LogListener(StreamingQueryListener):
    """``spark.streams.addListener(LogListener())``; one line an event, as JSON after a fixed word."""

    def __init__(self, logger: logging.Logger | None = None) -> None:
        self.logger = logger or logging.getLogger("rivulet.streaming")

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self.logger.info("started %s", json.dumps({"id": str(event.id), "name": event.name}))

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        self.logger.info("progress %s", json.dumps({"id": str(p.id), "batch": p.batchId, "rows": p.numInputRows, "offsets": [s.endOffset for s in p.sources]}))

    def onQueryIdle(self, event: object) -> None:
        self.logger.debug("idle")

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        (self.logger.error if event.exception else self.logger.info)("terminated %s", json.dumps({"id": str(event.id), "error": event.exception}))
