"""Politeness of sources that fetch: a sliding-window limiter and retries with growing pauses."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable


class RateLimiter:
    """At most ``limit`` calls in ``window`` seconds and ``gap`` seconds between calls; safe for threads.

    ``clock`` and ``sleep`` can be replaced in tests.
    """

    def __init__(self, limit: int, window: float, gap: float = 0.0, *, clock=time.monotonic, sleep=time.sleep):
        self.limit, self.window, self.gap, self.clock, self.sleep = limit, window, gap, clock, sleep
        self.calls: deque[float] = deque()
        self.lock = threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            due = now
            if self.calls:
                due = max(due, self.calls[-1] + self.gap)
            while self.calls and self.calls[0] <= due - self.window:
                self.calls.popleft()
            if len(self.calls) >= self.limit:
                due = max(due, self.calls[0] + self.window)
                self.calls.popleft()
            self.calls.append(due)
            if due > now:
                self.sleep(due - now)

    def status(self) -> dict[str, float]:
        now = self.clock()
        recent = sum(1 for t in self.calls if t > now - self.window)
        return {"recent": recent, "left": self.limit - recent}


def with_retries(call: Callable[[], object], *, tries: int = 3, pause: float = 1.0, sleep=time.sleep):
    """The call's result; OSError is retried with doubled pauses, the last one is raised."""
    for n in range(tries):
        try:
            return call()
        except OSError:
            if n + 1 == tries:
                raise
            sleep(pause * 2**n)
