"""Versions of a layer: a log of commits that several writers may add to at once.

A run writes the tables of a layer into a folder of its own below ``_versions``.  The layer's tables are
those of the version that the last entry of ``_log`` names, so readers see the old tables or all of the
new ones, and data is never renamed.  An entry has the next free number and is never replaced: two
runs that end at once cannot both take a number, and the one that comes too late looks again.

A refresh replaces the whole layer.  Of runs that overlap, the one that began last has the newest input
and is the one that stays, whichever order they end in; one that began earlier than the published
version ends with ``Superseded`` and takes its folder away.

While it runs, a run holds a lease, a small file that it writes anew from time to time.  Folders are
removed only if no lease younger than ``LEASE_SECONDS`` is on them, so no run loses what it is writing, and
what a crashed run left goes when its lease has run out.  All ages are told by the file system's clock.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import SparkSession

from tallyforge.sources.tables import exists, filesystem, remove

LEASE_SECONDS = 3600.0
#: Published versions that stay: the current one and the one before it, which readers may still have open.
KEPT = 2


class Superseded(RuntimeError):
    """A run that began later has published the layer."""


class Commit(NamedTuple):
    """An entry of a layer's log; ``started`` is when its run began, in milliseconds."""

    number: int
    version: str
    started: int


def _text(spark: SparkSession, path: str) -> str:
    hadoop_path, fs = filesystem(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, text: str) -> int:
    """Write a small file, over one that is there; returns its time on the file system's clock."""
    hadoop_path, fs = filesystem(spark, path)
    stream = fs.create(hadoop_path, True)
    stream.write(text.encode())
    stream.close()
    return fs.getFileStatus(hadoop_path).getModificationTime()


def _names(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder, with their times; none if there is no such folder."""
    hadoop_path, fs = filesystem(spark, folder)
    if not fs.exists(hadoop_path):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(hadoop_path)}


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its whole content, unless there is one: then ``False``, and it stays as it is."""
    draft = f"{path}.{uuid.uuid4().hex}"
    _put(spark, draft, text)
    source, fs = filesystem(spark, draft)
    target, _ = filesystem(spark, path)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), no_overwrite)
        return True
    except Exception:
        if fs.exists(target):
            return False
        raise
    finally:
        if fs.exists(source):
            fs.delete(source, False)


def _entry(spark: SparkSession, layer: str, name: str) -> Commit | None:
    """An entry of the log; none if it has been removed, as those before the last few are."""
    path = f"{layer}/_log/{name}"
    try:
        entry = json.loads(_text(spark, path))
    except Exception:
        if not exists(spark, path):
            return None
        raise
    return Commit(int(name), entry["version"], entry["started"])


def commits(spark: SparkSession, layer: str) -> list[Commit]:
    """The log, oldest entry first."""
    names = sorted(n for n in _names(spark, f"{layer}/_log") if n.isdigit())
    return [entry for n in names if (entry := _entry(spark, layer, n))]


def current_version(spark: SparkSession, layer: str) -> str | None:
    """The published folder of a layer, if there is one."""
    log = commits(spark, layer)
    return f"{layer}/_versions/{log[-1].version}" if log else None


def table_path(spark: SparkSession, layer: str, name: str) -> str:
    """Where the published table ``name`` of a layer is; a missing layer leads to a missing path."""
    return f"{current_version(spark, layer) or layer}/{name}"


class _Run:
    """A version that is being written, and the lease on its folder."""

    def __init__(self, spark: SparkSession, layer: str, lease_seconds: float):
        self.spark, self.layer, self.lease_seconds = spark, layer, lease_seconds
        self.version = uuid.uuid4().hex
        self.folder = f"{layer}/_versions/{self.version}"
        self.lease = f"{layer}/_leases/{self.version}"
        # The lease is there before the folder is: a folder without one belongs to no run.
        self.started = _put(spark, self.lease, "")
        log = commits(spark, layer)
        self.seen = log[-1].number if log else -1
        self._ended = threading.Event()
        self._keeper = threading.Thread(target=self._renew, daemon=True)
        self._keeper.start()

    def _renew(self) -> None:
        while not self._ended.wait(self.lease_seconds / 4):
            try:
                _put(self.spark, self.lease, "")
            except Exception:  # a file system that is away for a while; the next try may do
                continue

    def end(self) -> None:
        self._ended.set()
        self._keeper.join()
        remove(self.spark, self.lease)

    def commit(self) -> Commit:
        """Enter the version into the log as the newest, or raise ``Superseded``."""
        entry = json.dumps({"version": self.version, "started": self.started})
        while True:
            log = commits(self.spark, self.layer)
            last = log[-1] if log else Commit(-1, "", -1)
            later = (last.started, last.version) > (self.started, self.version)
            if last.number > self.seen and later:
                raise Superseded(f"{self.layer}: a run that began later has published {last.version}")
            number = last.number + 1
            if _create_once(self.spark, f"{self.layer}/_log/{number:020d}", entry):
                return Commit(number, self.version, self.started)


def clean(spark: SparkSession, layer: str, now: int, lease_seconds: float = LEASE_SECONDS) -> list[str]:
    """Remove what neither readers nor runs need, and name the versions removed.

    Kept are the last published versions and every version under a lease that has not run out at ``now``.
    The log is read after the leases, so that a run that ends in between is seen in one of them.
    """
    versions = set(_names(spark, f"{layer}/_versions"))
    leases = _names(spark, f"{layer}/_leases")
    held = {name for name, renewed in leases.items() if now - renewed <= 1000 * lease_seconds}
    log = commits(spark, layer)
    published = {c.version for c in log[-KEPT:]}
    removed = sorted(versions - held - published)
    for version in removed:
        remove(spark, f"{layer}/_versions/{version}")
    for name in leases.keys() - held:
        remove(spark, f"{layer}/_leases/{name}")
    for entry in log[:-KEPT]:
        remove(spark, f"{layer}/_log/{entry.number:020d}")
    return removed


@contextmanager
def new_version(
    spark: SparkSession, layer: str, lease_seconds: float = LEASE_SECONDS
) -> Iterator[str]:
    """A new version's folder, published if the block ends well and removed if not."""
    run = _Run(spark, layer, lease_seconds)
    try:
        yield run.folder
        run.commit()
    except BaseException:
        remove(spark, run.folder)
        run.end()
        raise
    now = _put(spark, run.lease, "")
    run.end()
    clean(spark, layer, now, lease_seconds)
