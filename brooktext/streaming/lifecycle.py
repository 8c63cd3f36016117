"""Start, limit and end a micro-batch query."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

logger = logging.getLogger(__name__)

# Fixed value: rows shown by a preview.
PREVIEW_ROWS = 5

BatchHandler = Callable[[DataFrame, int], bool]


class BatchLimitReached(RuntimeError):
    """Raised inside the batch after the last one, so that it stays unread."""


class BatchRun:
    """A query that hands each micro-batch to ``handler``.

    The handler tells whether the batch held rows; only those count towards
    ``max_batches``. A batch beyond the limit is refused before any work, is not
    committed and is read again by the next run on the same checkpoint.
    """

    def __init__(
        self,
        stream: DataFrame,
        handler: BatchHandler,
        checkpoint: str,
        trigger: dict | None = None,
        max_batches: int | None = None,
        output_mode: str = "append",
    ):
        self.handler = handler
        self.max_batches = max_batches
        self.batches = 0
        writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
        writer = writer.trigger(**(trigger or {"availableNow": True}))
        self.query: StreamingQuery = writer.foreachBatch(self._on_batch).start()

    def _full(self) -> bool:
        return self.max_batches is not None and self.batches >= self.max_batches

    def _on_batch(self, batch: DataFrame, batch_id: int) -> None:
        if self._full():
            raise BatchLimitReached(f"{self.max_batches} batches done")
        logger.info("batch %d at %s", batch_id, time.strftime("%Y-%m-%d %H:%M:%S"))
        if self.handler(batch, batch_id):
            self.batches += 1

    def wait(self, timeout: float | None = None, poll: float = 0.5) -> int:
        """Wait for the end, the batch limit or the time limit, then stop.

        Returns the number of non-empty batches. A failure of the query is
        raised; only the refusal of a batch beyond the limit is not a failure.
        ``limited`` tells afterwards whether the limit ended the run.
        """
        deadline = None if timeout is None else time.monotonic() + timeout
        try:
            while not self.query.awaitTermination(poll):
                if self._full() or (deadline is not None and time.monotonic() >= deadline):
                    break
        except StreamingQueryException as failure:
            if BatchLimitReached.__name__ not in str(failure):
                raise
        finally:
            if self.query.isActive:
                self.query.stop()
        if self.limited:
            logger.warning("stopped after %d batches as told by max_batches; input may be left", self.batches)
        return self.batches

    def drain(self) -> int:
        """Wait until all that has come so far is read, then stop; for triggers that go on. Returns as ``wait``."""
        try:
            self.query.processAllAvailable()
        finally:
            self.query.stop()
        return self.batches

    @property
    def limited(self) -> bool:
        return self._full()

    def awaitTermination(self) -> None:
        self.wait()


def start_preview(stream: DataFrame, checkpoint: str, rows: int = PREVIEW_ROWS, trigger: dict | None = None):
    """Show the first rows of every micro-batch on the console."""
    writer = stream.writeStream.format("console").option("numRows", rows).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
