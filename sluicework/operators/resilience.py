"""Retry and concurrency policies: pure steps for the connector, and folds for event tables."""

from __future__ import annotations

import contextlib
import random
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workers import placed


class Retryable(Exception):
    """A failure worth another attempt; ambiguous if the request may have been applied; wait as the server asked."""

    def __init__(self, message: str, *, ambiguous: bool = False, wait: float | None = None):
        super().__init__(message)
        self.ambiguous, self.wait = ambiguous, wait


class RetriesExhausted(Exception):
    """The last failure after all attempts or all time."""


@dataclass(frozen=True)
class RetryPolicy:
    """Bounded attempts and time, exponential ceilings, full jitter; a server's own wait takes precedence."""

    attempts: int = 5
    budget: float = 300.0
    initial: float = 0.5
    cap: float = 30.0

    @classmethod
    def from_options(cls, o: dict[str, str]) -> RetryPolicy:
        """retry.attempts, retry.budget, retry.initial and retry.cap (seconds) of a source's or sink's options."""
        wait = {k: float(o[f"retry.{k}"]) for k in ("budget", "initial", "cap") if f"retry.{k}" in o}
        policy = cls(int(o.get("retry.attempts", cls.attempts)), **wait)
        if policy.attempts < 1 or min(policy.budget, policy.initial, policy.cap) < 0:
            raise ValueError("a retry policy needs an attempt at least, and no negative times")
        return policy

    def ceiling(self, attempt: int) -> float:
        return min(self.cap, self.initial * 2 ** min(max(attempt - 1, 0), 30))

    def run(self, call: Callable, *, idempotent: bool, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic, draw: Callable[[float, float], float] = random.uniform, told: Callable[[float, Exception], None] | None = None):
        """call's result; told hears of every wait before another attempt and of its cause."""
        begun, attempt = clock(), 0
        while True:
            attempt += 1
            try:
                return call()
            except Retryable as e:
                if e.ambiguous and not idempotent:
                    raise
                wait = e.wait if e.wait is not None else draw(0.0, self.ceiling(attempt))
                if attempt >= self.attempts or clock() - begun + wait > self.budget:
                    raise RetriesExhausted(f"gave up after {attempt} attempts: {e}") from e
                if told:
                    told(wait, e)
                sleep(wait)


@dataclass
class AimdLimit:
    """Permits that are halved when throttled and grow by one after `every` successes."""

    top: int = 8
    every: int = 50
    permits: int = 0
    successes: int = 0

    def __post_init__(self) -> None:
        self.permits = self.permits or self.top

    def throttled(self) -> None:
        self.permits, self.successes = max(1, self.permits // 2), 0

    def succeeded(self) -> None:
        if self.permits < self.top:
            self.successes += 1
            if self.successes >= self.every:
                self.permits, self.successes = self.permits + 1, 0


class Limiter:
    """Requests at once to one instance: permits are taken and given back, fewer after throttling, one more after every so many successes.

    All clients of a process share an instance's limiter; tasks are bounded by their number.
    """

    _shared: dict[str, Limiter] = {}
    _guard = threading.Lock()

    def __init__(self, top: int = 8, every: int = 50):
        if top < 1:
            raise ValueError("at least one permit")
        self.law, self.flying, self._free = AimdLimit(top, every), 0, threading.Condition()

    @classmethod
    def of(cls, instance: str, top: int) -> Limiter:
        """The instance's limiter; another top resizes it."""
        with cls._guard:
            found = cls._shared.setdefault(instance, cls(top))
        if found.law.top != top:
            found.resize(top)
        return found

    @property
    def permits(self) -> int:
        return self.law.permits

    def resize(self, top: int) -> None:
        with self._free:
            self.law = AimdLimit(top, self.law.every)
            self._free.notify_all()

    @contextlib.contextmanager
    def permit(self, timeout: float = 60.0) -> Iterator[None]:
        """Hold one permit, waiting for it; too long a wait is a failure worth another attempt."""
        with self._free:
            if not self._free.wait_for(lambda: self.flying < self.law.permits, timeout):
                raise Retryable(f"no request permit within {timeout:g} s, {self.flying} in use")
            self.flying += 1
        try:
            yield
        finally:
            with self._free:
                self.flying -= 1
                self._free.notify_all()

    def throttled(self) -> None:
        with self._free:
            self.law.throttled()

    def succeeded(self) -> None:
        with self._free:
            self.law.succeeded()
            self._free.notify_all()


def aimd_permits(events: DataFrame, lane: str, order: str, throttled: Column, *, top: int = 8, every: int = 50) -> DataFrame:
    """Permits of each lane after its events in order.

    Only how many successes lie between two throttlings matters, and that is the
    difference of their places in one sort of all events; so a lane's fold holds
    its throttlings, not its events.
    """
    told = placed(events.select(F.col(lane).alias("lane"), F.col(order).alias("_order"), F.coalesce(throttled, F.lit(False)).alias("_hit")).orderBy("lane", "_order"))
    ends = told.groupBy("lane").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.array_sort(F.collect_list(F.when(F.col("_hit"), F.col("place")))).alias("hits"))

    def grown(permits: Column, successes: Column) -> Column:
        return F.least(F.lit(top).cast("bigint"), permits + F.floor(successes / every))

    start = F.struct(F.lit(top).cast("bigint").alias("p"), (F.col("first") - 1).alias("at"))
    step = lambda a, hit: F.struct(F.greatest(F.lit(1).cast("bigint"), F.floor(grown(a["p"], hit - a["at"] - 1) / 2)).alias("p"), hit.alias("at"))
    return ends.select(F.col("lane").alias(lane), F.aggregate("hits", start, step, lambda a: grown(a["p"], F.col("last") - a["at"])).cast("int").alias("permits"))
