"""Subscriptions: the notifications of a stream, one by one, for a reader and for callbacks.

A micro-batch hands its rows over through a bounded queue and ends when the reader has taken the last of them, so a
slow reader holds the stream up, and a batch that wasn't read whole isn't committed: after a restart from the same
checkpoint it comes again, whole.  Every notification carries its batch and its place in it, by which a reader can
tell what it has seen.
"""

from __future__ import annotations

import queue
import threading
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame

from recordspark.streaming.feeds import live

CLOSE = {"action": "CLOSE"}
_WAIT = 0.05


class Closed(RuntimeError):
    """The subscription ended while a batch was being handed over."""


class Subscription:
    """size: the most notifications that wait for the reader; once: what is there now, then close."""

    def __init__(self, rows: DataFrame, checkpoint: str, size: int = 1000, condition: Column | None = None, once: bool = False):
        if size < 1:
            raise ValueError("a subscription needs room for a notification")
        self.errors: list[tuple[Callable[[dict[str, Any]], None], Exception]] = []
        self._callbacks: list[Callable[[dict[str, Any]], None]] = []
        self._waiting: queue.Queue[dict[str, Any]] = queue.Queue(size)
        self._over = threading.Event()
        self.query = live(rows, self._hand_over, checkpoint, condition, once)

    @property
    def active(self) -> bool:
        return not self._over.is_set() and self.query.isActive

    def on(self, callback: Callable[[dict[str, Any]], None]) -> Callable[[], None]:
        """Call a function with every notification that the reader takes; returns what ends that.  What it raises goes to `errors`."""
        self._callbacks.append(callback)
        return lambda: self._callbacks.remove(callback) if callback in self._callbacks else None

    def _hand_over(self, batch: DataFrame, number: int) -> None:
        for place, row in enumerate(batch.toLocalIterator()):
            told = {**row.asDict(recursive=True), "batch": number, "place": place}
            while True:
                if self._over.is_set():
                    raise Closed
                try:
                    self._waiting.put(told, timeout=_WAIT)
                    break
                except queue.Full:
                    continue
        while self._waiting.unfinished_tasks:
            if self._over.is_set():
                raise Closed
            threading.Event().wait(_WAIT)

    def __iter__(self) -> Iterator[dict[str, Any]]:
        """Notifications as they come; the iterator ends when the subscription is closed or its stream ends.

        A notification counts as read when the next one is asked for.
        """
        while True:
            try:
                told = self._waiting.get(timeout=_WAIT)
            except queue.Empty:
                if not self.active:
                    break
                continue
            self._call(told)
            yield told
            self._waiting.task_done()
        self._call(dict(CLOSE))
        failed = self.query.exception()
        if failed is not None and not self._over.is_set():
            raise RuntimeError(f"the subscription failed: {failed}") from failed

    def _call(self, told: dict[str, Any]) -> None:
        for callback in list(self._callbacks):
            try:
                callback(told)
            except Exception as e:  # noqa: BLE001  one callback's error is kept from the others
                self.errors.append((callback, e))

    def run(self) -> int:
        """Read to the end for the callbacks alone; how many notifications came."""
        return sum(1 for _ in self)

    def close(self) -> None:
        """End the subscription; what wasn't read comes again after a restart."""
        self._over.set()
        self.query.stop()
