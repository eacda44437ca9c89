"""Frames that are kept in memory or on disk for a while, and never longer."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def persisted(
    *frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[tuple[DataFrame, ...]]:
    """Keep ``frames`` from their first use to the end of the block, however that ends.

    Blocks that were lost with an executor are computed anew.  A frame that was kept before, by the
    caller or an outer block, stays kept; its level is then not changed.
    """
    with ExitStack() as ends:
        for frame in frames:
            if not frame.is_cached and frame.storageLevel == StorageLevel.NONE:
                ends.callback(frame.persist(level).unpersist, blocking=True)
        yield frames
