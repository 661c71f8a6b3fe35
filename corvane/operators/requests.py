"""A sliding window of requests: what is done is taken as it comes, over batch borders, and the server's answers set the window.

A task submits texts while fewer than ``window.size`` are in flight; a slow one holds up no other. The window
halves when the server says it is busy, or when requests take much longer than they did, once for what was
under way then; it grows by one for each window of answers without that, up to its bound.
"""

from __future__ import annotations

import os
import threading
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

SLOW, NOTICED = 3.0, 0.05  # times the usual latency, and seconds from which latency says something of a server
SMOOTH, WARM = 0.1, 20  # weight of the newest latency in the usual one; answers before it is judged


class RequestWindow:
    def __init__(self, most: int, slow: float = SLOW, clock: Callable[[], float] = time.monotonic):
        self.most, self.size, self.least, self.slow, self.clock = most, most, most, slow, clock
        self.lock, self.local = threading.Lock(), threading.local()
        self.last_cut, self.good, self.answers, self.usual, self.quickest = float("-inf"), 0, 0, 0.0, float("inf")

    def busy(self) -> None:
        """The server refused an attempt of this thread's request; only attempts that began after the last halving count."""
        with self.lock:
            if getattr(self.local, "began", self.clock()) > self.last_cut:
                self._halve()
        self.local.began = self.clock()

    def _halve(self) -> None:
        self.size, self.good, self.last_cut = max(1, self.size // 2), 0, self.clock()
        self.least = min(self.least, self.size)

    def timed(self, work: Callable) -> Callable:
        """``work`` as a thread's request, whose time is told to the window."""

        def run(*args):
            began = self.local.began = self.clock()
            found = work(*args)
            self._answered(began, self.clock() - began)
            return found

        return run

    def _answered(self, began: float, seconds: float) -> None:
        with self.lock:
            self.answers += 1
            weight = max(SMOOTH, 1 / self.answers)
            self.usual += weight * (seconds - self.usual)
            if self.answers >= WARM:
                self.quickest = min(self.quickest, self.usual)
            if began <= self.last_cut:  # it says nothing of the window as it is now
                return
            if self.usual > max(NOTICED, self.slow * self.quickest):
                self._halve()
                self.usual = self.quickest  # until it shows anew
                return
            self.good += 1
            if self.good >= self.size:
                self.size, self.good = min(self.most, self.size + 1), 0


def sliding(items: Iterable, work: Callable, window: RequestWindow) -> Iterator[tuple[object, object]]:
    """(item, ``work(item)``) of each item as it is done; ``work`` must not raise."""
    timed, under_way = window.timed(work), {}
    with ThreadPoolExecutor(window.most) as pool:

        def drained() -> Iterator[tuple[object, object]]:
            done: set[Future] = wait(under_way, return_when=FIRST_COMPLETED).done
            for f in done:
                yield under_way.pop(f), f.result()

        for item in items:
            while len(under_way) >= window.size:
                yield from drained()
            under_way[pool.submit(timed, item)] = item
        while under_way:
            yield from drained()


def resident_mb() -> float:
    """Memory of this process, in MB; 0 where the system doesn't tell."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / (1 << 20)
    except OSError:
        return 0.0
