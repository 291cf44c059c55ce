"""Commit protocol of the report folder (OP-06): overlapping refreshes, leases, put-if-absent."""

import os
import threading
import time

import pytest

from scorewright.plans import report, testbed
from scorewright.sources.sinks import Conflict, VersionLog

ROOT = "/root/testdata/sf0.001"


def write(spark, root, version, n):
    spark.range(n).write.parquet(os.path.join(root, version, "t"))


def rows(spark, root, version):
    return spark.read.parquet(os.path.join(root, version, "t")).count()


def test_overlapping_writers_both_end_readable(spark, tmp_path):
    root = str(tmp_path)
    a, b = VersionLog(spark, root), VersionLog(spark, root)
    first, second = a.begin(), b.begin()
    write(spark, root, first, 1)
    write(spark, root, second, 2)
    b.commit(second)
    b.release(second)
    assert b.clean() == [] and rows(spark, root, first) == 1        # the writer in flight keeps its folder
    a.commit(first)
    a.release(first)
    assert a.clean() == [] and a.current() == first
    assert rows(spark, root, first) == 1 and rows(spark, root, second) == 2
    assert a.entry(a.entries()[-1]) == (first, second)


def test_log_numbers_are_given_once(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path))
    got = []
    threads = [threading.Thread(target=lambda i=i: got.append(log.commit(f"v-{i}"))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(1, 9)) == log.entries()
    assert {log.entry(n)[0] for n in got} == {f"v-{i}" for i in range(8)}
    assert not log._put("_log/000000000003", "x") and log.entry(3)[0] != "x"


def test_expected_predecessor(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path))
    log.commit("v-a", expected=None)
    with pytest.raises(Conflict):
        log.commit("v-b", expected=None)
    log.commit("v-b", expected="v-a")
    assert log.current() == "v-b"


def test_expired_leases_are_cleaned_and_running_ones_stay(spark, tmp_path):
    root = str(tmp_path)
    dead, alive = VersionLog(spark, root, lease_seconds=-1).begin(), VersionLog(spark, root).begin()
    write(spark, root, dead, 1)
    write(spark, root, alive, 1)
    log = VersionLog(spark, root)
    for n in range(4):
        v = log.begin()
        write(spark, root, v, n)
        log.commit(v)
        log.release(v)
        log.clean()
    left = {n for n in os.listdir(root) if n.startswith("v-")}
    assert dead not in left and alive in left and len(left) == 3 and log.leased() == {alive}
    assert len(log.entries()) == 2 and log.current() == v
    log.abandon(alive)
    assert alive not in os.listdir(root) and log.leased() == set()


def test_failed_refresh_leaves_nothing_and_the_report_stays(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    log = VersionLog(spark, root)
    v = log.begin()
    log.commit(v)
    log.release(v)
    monkeypatch.setattr(report, "build", lambda *a: (_ for _ in ()).throw(RuntimeError("no sources")))
    with pytest.raises(RuntimeError, match="no sources"):
        report.refresh(spark, None, None, root)
    assert log.current() == v and log.leased() == set() and not [n for n in os.listdir(root) if n.startswith("v-")]


def test_two_overlapping_refreshes(spark, tmp_path):
    """Both refreshes run at once into one folder; both are readable, and the later commit is the current one."""
    root, out = str(tmp_path), {}

    def run(name, wait):
        time.sleep(wait)
        out[name] = report.refresh(spark, testbed.sources(spark, ROOT), testbed.config(), root)

    threads = [threading.Thread(target=run, args=a) for a in (("a", 0), ("b", 1))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    counts = [{n: spark.read.parquet(p).count() for n, p in tables.items()} for tables in out.values()]
    assert counts[0] == counts[1] and counts[0]["scorecard"] > 0
    log = VersionLog(spark, root)
    assert len(log.entries()) == 2 and log.leased() == set()
    assert {n: df.count() for n, df in report.current_tables(spark, root).items()} == counts[0]
