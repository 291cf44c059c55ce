"""Sinks and materialisation (OP-06, OP-07, OP-08).

The refresh computes every result first and overwrites the report tables
last, so readers never see a truncated-but-not-yet-filled table for longer
than the write itself (the source truncates four tables before filling any).
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from scorewright.session import scratch_path


class Workspace:
    """The persisted frames and written tables of one build; ``release`` frees both.

    Used from several driver threads at once (list appends only).
    """

    def __init__(self):
        self.frames: list[DataFrame] = []
        self.paths: list[tuple[SparkSession, str]] = []

    def release(self) -> None:
        while self.frames:
            self.frames.pop().unpersist()
        while self.paths:
            delete_path(*self.paths.pop())


def _filesystem(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _filesystem(spark, path)
    fs.delete(p, True)


def append_all(frames: Sequence[DataFrame], cols: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL of several result sets with one explicit column list (duplicates kept)."""
    if cols is not None:
        frames = [f.select(*cols) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), frames)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> str:
    """Full refresh of one sink: replace its whole content."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def read_back(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def materialise(df: DataFrame, mode: str = "cache", name: str = "stage", work: Workspace | None = None,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """Materialise an intermediate that several consumers read.

    ``cache``      persisted MEMORY_AND_DISK; lost blocks are recomputed from lineage.
    ``table``      written as parquet into the shared checkpoint folder and read back:
                   cuts the lineage, survives executor loss, scans prune and push down.
    ``checkpoint`` reliable ``DataFrame.checkpoint`` into ``spark.checkpoint.dir``.
    ``none``       keep it lazy.

    ``work`` takes note of what has to be released when the build is done.
    """
    if mode == "none":
        return df
    if mode == "cache":
        if work is not None:
            work.frames.append(df)
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    spark = df.sparkSession
    if mode == "table":
        path = scratch_path(spark, name)
        if work is not None:
            work.paths.append((spark, path))
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    if mode == "checkpoint":
        scratch_path(spark, name)  # makes sure a checkpoint folder is registered
        return df.checkpoint(eager=True)
    raise ValueError(f"unknown materialise mode {mode!r}")


def run_concurrently(tasks: Sequence[Callable[[], object]], max_workers: int = 4) -> list:
    """Run independent Spark actions from separate driver threads.

    Each action is its own Spark job; jobs submitted from different threads
    are scheduled side by side (FIFO or FAIR pool), so independent outputs
    share the cluster instead of waiting for each other.  Results keep the
    task order; the first failure is raised.
    """
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]


class Conflict(RuntimeError):
    """Another refresh committed after the version that this one was based on."""


class VersionLog:
    """Versions of a report folder: leased while they are written, committed by one put-if-absent log entry.

    Layout under ``root``: ``v-<id>/`` the tables of a version, ``_log/<number>``
    the committed versions in order (an entry holds the version's name and its
    predecessor's), ``_leases/v-<id>`` the end of a lease (epoch seconds).

    ``begin`` leases a new version before anything of it is written.  ``commit``
    writes the log entry after the last one with "create, never overwrite": of
    two refreshes that commit at once one gets the number, the other finds it
    taken.  A refresh recomputes the whole report, so by default the other
    takes the next number and both stay readable, in log order; with
    ``expected`` it raises ``Conflict`` instead.  ``clean`` deletes what no
    reader or writer can need: committed versions but the last ``keep``, and
    uncommitted ones whose lease has ended.  The folder of a refresh in flight
    has a running lease and is never touched, whoever cleans.

    A put-if-absent is atomic where the store's create without overwrite is
    (HDFS, stores with conditional writes); on local disks it is made from a
    finished temporary file that is linked to the name.
    """

    def __init__(self, spark: SparkSession, root: str, lease_seconds: int = 86_400, keep: int = 2):
        self.spark, self.root, self.lease_seconds, self.keep = spark, root, lease_seconds, keep

    # ---- files
    def _names(self, folder: str) -> list[str]:
        path, fs = _filesystem(self.spark, f"{self.root}/{folder}" if folder else self.root)
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def _read(self, name: str) -> str | None:
        path, fs = _filesystem(self.spark, f"{self.root}/{name}")
        try:
            stream = fs.open(path)
        except Exception:  # noqa: BLE001  (deleted since it was listed)
            if fs.exists(path):
                raise
            return None
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _put(self, name: str, text: str) -> bool:
        """Create the file with this content; False if it exists."""
        path, fs = _filesystem(self.spark, f"{self.root}/{name}")
        if fs.getUri().getScheme() == "file":
            return self._put_local(path.toUri().getPath(), text)
        try:
            out = fs.create(path, False)
        except Exception:  # noqa: BLE001  (the store's own "already exists")
            if fs.exists(path):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    @staticmethod
    def _put_local(path: str, text: str) -> bool:
        # a finished file linked into place: the link fails if the name is taken, and no reader sees half a file
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}")
        with open(part, "x") as f:
            f.write(text)
        try:
            os.link(part, path)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(part)

    # ---- log
    def entries(self) -> list[int]:
        return sorted(int(n) for n in self._names("_log") if n.isdigit())

    def entry(self, number: int) -> tuple[str, str | None] | None:
        """(version, predecessor) of a log entry, None if it was cleaned away."""
        text = self._read(f"_log/{number:012d}")
        if not text:
            return None
        version, _, before = text.partition("\n")
        return version, before or None

    def current(self) -> str | None:
        """The version committed last, None before the first."""
        for number in reversed(self.entries()):
            if found := self.entry(number):
                return found[0]
        return None

    def begin(self) -> str:
        """Lease and name of a new version."""
        version = f"v-{uuid.uuid4().hex[:12]}"
        self._put(f"_leases/{version}", str(int(time.time()) + self.lease_seconds))
        return version

    def commit(self, version: str, expected=...) -> int:
        """Make ``version`` the current one; with ``expected`` only if that is the current one now."""
        while True:
            numbers = self.entries()
            before = self.current()
            if expected is not ... and before != expected:
                raise Conflict(f"{before} was committed after {expected}")
            number = (numbers[-1] if numbers else 0) + 1
            if self._put(f"_log/{number:012d}", f"{version}\n{before or ''}"):
                return number

    def abandon(self, version: str) -> None:
        """Delete an uncommitted version and end its lease."""
        delete_path(self.spark, f"{self.root}/{version}")
        delete_path(self.spark, f"{self.root}/_leases/{version}")

    def leased(self) -> set[str]:
        """Versions whose lease is running."""
        now = time.time()
        return {v for v in self._names("_leases") if int(self._read(f"_leases/{v}") or 0) > now}

    def clean(self) -> list[str]:
        """Delete versions that nobody needs; returns their names."""
        folders = [n for n in self._names("") if n.startswith("v-")]
        # leases are read before the log: a version committed in between is still seen as leased
        leased, numbers = self.leased(), self.entries()
        kept = {found[0] for n in numbers[-self.keep:] if (found := self.entry(n))}
        old = [v for v in folders if v not in kept and v not in leased]
        for v in old:
            delete_path(self.spark, f"{self.root}/{v}")
        for v in set(self._names("_leases")) - leased:
            delete_path(self.spark, f"{self.root}/_leases/{v}")
        for n in numbers[:-self.keep]:
            delete_path(self.spark, f"{self.root}/_log/{n:012d}")
        return old

    def release(self, version: str) -> None:
        """End the lease of a committed version: from now on the log keeps it."""
        delete_path(self.spark, f"{self.root}/_leases/{version}")
