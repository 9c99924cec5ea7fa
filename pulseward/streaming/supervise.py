"""Restart of failed streaming queries from their checkpoints, with a budget of failures.

A failed query ends in Spark; a restart from its checkpoint goes on where it stopped. ``Supervisor`` starts each
query again until more than ``tolerated`` failures follow each other without a micro-batch committed in between, or until
more than ``per_window`` failures of it fall in ``window_s`` seconds; then all queries are stopped and its error is raised.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

TOLERATED = 3          # fixed: failures in a row that are tolerated
WINDOW_S = 3600.0
PER_WINDOW = 20


class _Watched:
    def __init__(self, start: Callable[[], StreamingQuery]):
        self.start = start
        self.query = start()
        self.in_a_row = 0
        self.restarts = 0
        self.times: deque[float] = deque()

    def failed(self, now: float, window_s: float) -> None:
        last = self.query.lastProgress
        if last is not None:                 # a micro-batch was committed since the last (re)start
            self.in_a_row = 0
        self.in_a_row += 1
        self.times.append(now)
        while self.times and now - self.times[0] > window_s:
            self.times.popleft()

    def restart(self) -> None:
        self.restarts += 1
        self.query = self.start()


class Supervisor:
    """``starts``: a function per query that starts it on its checkpoint. ``tick`` is called about every ``poll_s``."""

    def __init__(self, starts: list[Callable[[], StreamingQuery]], tolerated: int = TOLERATED, per_window: int = PER_WINDOW,
                 window_s: float = WINDOW_S, pause_s: float = 1.0, poll_s: float = 0.5, tick: Callable[[], None] | None = None):
        self.tolerated, self.per_window, self.window_s = tolerated, per_window, window_s
        self.pause_s, self.poll_s, self.tick = pause_s, poll_s, tick
        self.watched: list[_Watched] = []
        try:
            for start in starts:
                self.watched.append(_Watched(start))
        except BaseException:
            self.stop()
            raise

    def stop(self) -> None:
        for w in self.watched:
            if w.query.isActive:
                w.query.stop()

    def _error(self, w: _Watched) -> StreamingQueryException | None:
        try:
            return w.query.exception()
        except StreamingQueryException as e:
            return e

    def run(self, until: Callable[[], bool] | None = None) -> None:
        """Returns when every query has ended by itself, or when ``until`` says so."""
        try:
            while not (until and until()):
                ended = True
                for w in self.watched:
                    if w.query.isActive:
                        ended = False
                        continue
                    error = self._error(w)
                    if error is None:
                        continue
                    w.failed(time.monotonic(), self.window_s)
                    if w.in_a_row > self.tolerated or len(w.times) > self.per_window:
                        raise error
                    time.sleep(self.pause_s)
                    w.restart()
                    ended = False
                if self.tick:
                    self.tick()
                if ended:
                    return
                time.sleep(self.poll_s)
        finally:
            self.stop()
