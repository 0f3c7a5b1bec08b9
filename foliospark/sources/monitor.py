"""The driver process's own samples and counters, as rows for the operators that draw them."""

from __future__ import annotations

import os
import resource
import threading
import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "at double, elapsed double, rss long, cpu double, counters map<string,double>"
_BEGAN = time.monotonic()


class Counters:
    """Named sums that any thread may add to."""

    def __init__(self):
        self._lock, self._sums = threading.Lock(), {}

    def add(self, name: str, n: float = 1) -> None:
        with self._lock:
            self._sums[name] = self._sums.get(name, 0.0) + n

    def read(self) -> dict[str, float]:
        with self._lock:
            return dict(self._sums)

    def reset(self) -> None:
        with self._lock:
            self._sums.clear()


def rss() -> int:
    """Resident bytes of this process; its highest so far where the system does not say."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    except OSError:
        return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024


class Monitor:
    """The last ``window`` samples."""

    def __init__(self, counters: Counters, window: int = 600):
        self.counters, self.samples = counters, deque(maxlen=window)

    def take(self) -> None:
        used = os.times()
        self.samples.append((time.time(), time.monotonic() - _BEGAN, rss(), used.user + used.system, self.counters.read()))

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.samples), SCHEMA)
