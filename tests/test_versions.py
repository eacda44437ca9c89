"""Publishing with one writer and with several, and the leases that keep their folders."""

from __future__ import annotations

import os
import threading
import time
from pathlib import Path

import pytest

from tallyforge.sources import versions


@pytest.fixture
def layer(tmp_path):
    return str(tmp_path / "layer")


def put(spark, folder, n):
    spark.range(n).write.parquet(f"{folder}/numbers")


def published(spark, layer):
    return spark.read.parquet(versions.table_path(spark, layer, "numbers")).count()


def names(layer, part):
    folder = Path(layer, part)
    return {p.name for p in folder.iterdir() if not p.name.endswith(".crc")} if folder.exists() else set()


def test_one_after_the_other(spark, layer):
    assert versions.current_version(spark, layer) is None
    for n in range(1, 5):
        with versions.new_version(spark, layer) as folder:
            put(spark, folder, n)
        assert published(spark, layer) == n
        assert len(names(layer, "_versions")) == min(n, versions.KEPT)
    assert [c.number for c in versions.commits(spark, layer)] == [2, 3]
    assert names(layer, "_leases") == set()


def test_an_unfinished_version_of_another_run_stays(spark, layer):
    """While one run writes, others publish as often as they like."""
    with versions.new_version(spark, layer) as folder:
        put(spark, folder, 1)
    slow = versions._Run(spark, layer, versions.LEASE_SECONDS)
    put(spark, slow.folder, 100)
    for n in (2, 3, 4):
        with versions.new_version(spark, layer) as folder:
            put(spark, folder, n)
    assert spark.read.parquet(f"{slow.folder}/numbers").count() == 100
    assert slow.version in names(layer, "_versions") and slow.version in names(layer, "_leases")
    slow.end()


def test_the_run_that_began_last_stays(spark, layer):
    first = versions.new_version(spark, layer)
    older = first.__enter__()
    put(spark, older, 10)
    time.sleep(0.01)
    with versions.new_version(spark, layer) as newer:
        put(spark, newer, 20)
    with pytest.raises(versions.Superseded):
        first.__exit__(None, None, None)
    assert published(spark, layer) == 20
    assert Path(older).name not in names(layer, "_versions")
    assert names(layer, "_leases") == set()


def test_the_older_may_end_first(spark, layer):
    first, second = (versions.new_version(spark, layer) for _ in range(2))
    older = first.__enter__()
    time.sleep(0.01)
    newer = second.__enter__()
    put(spark, newer, 20)
    put(spark, older, 10)
    first.__exit__(None, None, None)
    assert published(spark, layer) == 10
    second.__exit__(None, None, None)
    assert published(spark, layer) == 20
    assert names(layer, "_versions") == {Path(older).name, Path(newer).name}


def test_a_log_entry_is_made_once(spark, layer):
    """Many writers try the same number; one of them gets it, and its content stays."""
    path = f"{layer}/_log/{0:020d}"
    got = []
    threads = [
        threading.Thread(target=lambda i=i: got.append((versions._create_once(spark, path, str(i)), i)))
        for i in range(4)
    ]
    for t in threads:
        t.start()
        t.join()
    winners = [i for won, i in got if won]
    assert len(winners) == 1 and Path(path).read_text() == str(winners[0])
    assert names(layer, "_log") == {f"{0:020d}"}


def test_writers_at_once_all_end_defined(spark, layer):
    ends = []

    def write(n):
        try:
            with versions.new_version(spark, layer) as folder:
                put(spark, folder, n)
            ends.append(("published", n))
        except versions.Superseded:
            ends.append(("superseded", n))

    threads = [threading.Thread(target=write, args=(n,)) for n in range(1, 6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(ends) == 5
    log = versions.commits(spark, layer)
    assert published(spark, layer) in {n for how, n in ends if how == "published"}
    assert [c.number for c in log] == sorted(c.number for c in log)
    assert all(a.started <= b.started for a, b in zip(log, log[1:]))
    assert names(layer, "_leases") == set()


def test_a_failed_run_takes_its_folder_away(spark, layer):
    with versions.new_version(spark, layer) as folder:
        put(spark, folder, 1)
    with pytest.raises(ZeroDivisionError), versions.new_version(spark, layer) as folder:
        put(spark, folder, 2)
        1 / 0
    assert published(spark, layer) == 1
    assert len(names(layer, "_versions")) == 1 and names(layer, "_leases") == set()


def test_what_a_crash_left_goes_when_its_lease_has_run_out(spark, layer):
    crashed = versions._Run(spark, layer, versions.LEASE_SECONDS)
    crashed._ended.set()
    put(spark, crashed.folder, 7)
    with versions.new_version(spark, layer) as folder:
        put(spark, folder, 1)
    assert crashed.version in names(layer, "_versions")
    long_ago = time.time() - 2 * versions.LEASE_SECONDS
    os.utime(crashed.lease, (long_ago, long_ago))
    with versions.new_version(spark, layer) as folder:
        put(spark, folder, 2)
    assert crashed.version not in names(layer, "_versions") and names(layer, "_leases") == set()


def test_leases_are_renewed(spark, layer):
    run = versions._Run(spark, layer, 0.2)
    before = os.path.getmtime(run.lease)
    time.sleep(0.5)
    assert os.path.getmtime(run.lease) > before
    run.end()
