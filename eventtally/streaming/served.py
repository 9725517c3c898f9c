"""Streams whose totals are put into the serving table."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery


class ServedQuery(StreamingQuery):
    """A query whose totals are also served when it has ended and while it waits for input.

    A thread publishes every so many seconds and after the end; `lock` keeps it apart from the
    batches. Who waits for the query waits for the last totals to be served as well.
    """

    def __init__(
        self, query: StreamingQuery, publish: Callable[[], None], seconds: float, lock: threading.Lock
    ):
        super().__init__(query._jsq)
        self._publish, self._seconds, self._lock = publish, seconds, lock
        self._error: Exception | None = None
        self._server = threading.Thread(target=self._serve, daemon=True)
        self._server.start()

    def _serve(self) -> None:
        ended = False
        while not ended:
            try:
                ended = super().awaitTermination(self._seconds)
            except StreamingQueryException:
                ended = True  # its finished batches count; who waits for the query is told
            try:
                with self._lock:
                    self._publish()
                self._error = None
            except Exception as error:  # tried again next time; after the end it is raised
                self._error = error

    def _served(self) -> None:
        self._server.join()
        if self._error is not None:
            raise self._error

    def awaitTermination(self, timeout: float | None = None) -> bool | None:
        ended = super().awaitTermination(timeout)
        if timeout is None or ended:
            self._served()
        return ended

    def processAllAvailable(self) -> None:
        super().processAllAvailable()
        with self._lock:
            self._publish()

    def stop(self) -> None:
        super().stop()
        self._served()
