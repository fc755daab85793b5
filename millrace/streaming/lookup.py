"""Lookup joins: each stream row sees the external table as it is when the row is processed."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.salting import NO_SALTING, Salting
from millrace.streaming.runner import start_batches


def lookup_join(
    stream: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", salting: Salting = NO_SALTING
) -> DataFrame:
    """Join of rows with the table as ``dim`` shows it.

    A frame over files keeps the list of its files, so on a stream it shows the table of the start; ``start_lookup`` makes
    a new frame in each micro-batch. ``salting`` spreads the stream rows of hot keys when the table is too large to be broadcast.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    keys = list(on)
    if salting.idle:
        return stream.join(dim, keys, how)
    spread = salting.spread(stream, keys, stream.columns)
    return spread.join(salting.copy(dim, keys), [*keys, "_salt"], how).drop("_salt")


def start_lookup(
    stream: DataFrame,
    load: Callable[[], DataFrame],
    on: Sequence[str],
    path: str,
    checkpoint: str,
    how: str = "left",
    salting: Salting = NO_SALTING,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Lookup join that loads the table anew in every micro-batch; later changes do not touch old rows."""
    return start_batches(
        stream, path, checkpoint, "append", lambda rows, _: lookup_join(rows, load(), on, how, salting), trigger
    )


class Snapshot:
    """The external table, loaded again when the kept copy is older than ``refresh_seconds``."""

    def __init__(self, load: Callable[[], DataFrame], refresh_seconds: float, clock: Callable[[], float] = time.monotonic):
        self.load = load
        self.refresh = refresh_seconds
        self.clock = clock
        self.frame: DataFrame | None = None
        self.loaded_at = 0.0

    def get(self) -> DataFrame:
        now = self.clock()
        if self.frame is None or now - self.loaded_at >= self.refresh:
            self.drop()
            self.frame = self.load().persist(StorageLevel.MEMORY_AND_DISK)
            self.loaded_at = now
        return self.frame

    def drop(self) -> None:
        if self.frame is not None:
            self.frame.unpersist()
            self.frame = None


class CachedLookup:
    """A running cached lookup; its snapshot is dropped when it ends."""

    def __init__(self, query: StreamingQuery, snapshot: Snapshot):
        self.query, self.snapshot = query, snapshot

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        try:
            return self.query.awaitTermination(timeout)
        finally:
            if not self.query.isActive:
                self.snapshot.drop()

    def stop(self) -> None:
        self.query.stop()
        self.snapshot.drop()

    def __getattr__(self, name: str):
        return getattr(self.query, name)


def start_cached_lookup(
    stream: DataFrame,
    load: Callable[[], DataFrame],
    on: Sequence[str],
    path: str,
    checkpoint: str,
    refresh_seconds: float = 30.0,
    how: str = "left",
    salting: Salting = NO_SALTING,
    trigger: dict | None = None,
    clock: Callable[[], float] = time.monotonic,
) -> CachedLookup:
    """Lookup join against a kept snapshot; ``load`` makes a new frame, and reads may be stale up to the refresh time."""
    snapshot = Snapshot(load, refresh_seconds, clock)

    def join(rows: DataFrame, batch_id: int) -> DataFrame:
        return lookup_join(rows, snapshot.get(), on, how, salting)

    return CachedLookup(start_batches(stream, path, checkpoint, "append", join, trigger), snapshot)
