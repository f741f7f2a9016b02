"""A registry of stages: tables that are built once and found again by what they were made from.

A stage's place is named by a fingerprint of its plan, without the numbers that Spark gives to columns, of the files that
the plan reads (path, size, time of change), and of a version that the caller gives (for code inside Python functions,
which a plan doesn't show).  An equal fingerprint means an equal table: it is read and nothing runs.  A changed input or
plan has another place.

A builder takes a lease on the place, a file that only one can create, and renews it by time; others wait for the table, or take
over once the lease has run out.  A stage counts as there when its write was committed.  Every use is noted; ``expire``
removes stages that nobody has used for a time and nobody is building.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder

LEASE_SECONDS = 6 * 3600.0
#: A waiting builder looks again after so many seconds.
POLL_SECONDS = 2.0
_SHOWN = "spark.sql.debug.maxToStringFields"


@dataclass
class Stage:
    """A stage as it was found or made."""

    table: DataFrame
    path: str
    reused: bool


class Stages:
    """Stages below a folder that driver and executors share (default: below the session's shared folder)."""

    def __init__(self, spark: SparkSession, folder: str | None = None, lease_seconds: float = LEASE_SECONDS):
        self.spark, self.lease_seconds = spark, lease_seconds
        self.folder = (folder or f"{shared_folder(spark)}/threadloom-stages").rstrip("/")
        self.me = uuid.uuid4().hex
        self._files = spark._jvm.org.apache.hadoop.fs

    # --- small files of the registry ------------------------------------------

    def _at(self, path: str):
        place = self._files.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def _write(self, path: str, text: str, overwrite: bool) -> bool:
        """Whether the file could be created; without ``overwrite`` only one of several writers can."""
        system, place = self._at(path)
        try:
            out = system.create(place, overwrite)
        except Exception as error:
            if not overwrite and (self._exists(path) or "FileAlreadyExistsException" in str(error)):  # or was there and is gone meanwhile
                return False
            raise RuntimeError(f"cannot write {path}") from error
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _read(self, path: str) -> str | None:
        system, place = self._at(path)
        try:
            source = system.open(place)
        except Exception:
            if not self._exists(path):  # gone meanwhile
                return None
            raise
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    # --- fingerprints -----------------------------------------------------------

    def fingerprint(self, df: DataFrame, version: str = "") -> str:
        """Digest of the plan, its input files and ``version``."""
        fields = self.spark.conf.get(_SHOWN)
        self.spark.conf.set(_SHOWN, str(2 ** 31 - 1))  # a plan shows all its columns
        try:
            plan = df._jdf.queryExecution().optimizedPlan().canonicalized().toString()
        finally:
            self.spark.conf.set(_SHOWN, fields)
        digest = hashlib.sha256(f"{version}\n{df.schema.json()}\n{plan}".encode())
        for path in sorted(df.inputFiles()):
            system, place = self._at(path)
            status = system.getFileStatus(place)
            digest.update(f"\n{path} {status.getLen()} {status.getModificationTime()}".encode())
        return digest.hexdigest()[:32]

    # --- building and using -------------------------------------------------------

    def _lease(self, path: str) -> bool:
        """Take the lease of a place, if it is free or has run out."""
        text = f"{self.me} {time.time() + self.lease_seconds}"
        if self._write(f"{path}.lease", text, False):
            return True
        held = self._read(f"{path}.lease")
        if held is not None and float(held.split(" ")[1]) > time.time():
            return False
        if held is not None:
            system, place = self._at(f"{path}.lease")
            if self._read(f"{path}.lease") == held:  # not renewed meanwhile
                system.delete(place, False)
        return self._write(f"{path}.lease", text, False)

    def _release(self, path: str) -> None:
        if (self._read(f"{path}.lease") or "").startswith(self.me):
            system, place = self._at(f"{path}.lease")
            system.delete(place, False)

    def keep(self, name: str, df: DataFrame, version: str = "") -> Stage:
        """The table of ``df``: read if a stage of the same fingerprint is there, else built and written."""
        return self._found(f"{self.folder}/{name}/{self.fingerprint(df, version)}", lambda: df)

    def named(self, name: str, known: str, make: Callable[[], DataFrame]) -> Stage:
        """The table that ``make`` makes from what ``known`` describes in full; it is called only if there is none.

        For tables whose making runs jobs of its own, so that asking for their plan would be work already.
        """
        return self._found(f"{self.folder}/{name}/{hashlib.sha256(known.encode()).hexdigest()[:32]}", make)

    def _found(self, path: str, make: Callable[[], DataFrame]) -> Stage:
        reused = True
        while not self._exists(f"{path}/_SUCCESS"):
            if not self._lease(path):
                time.sleep(POLL_SECONDS)
                continue
            try:
                if not self._exists(f"{path}/_SUCCESS"):
                    make().write.mode("overwrite").parquet(path)
                    reused = False
            finally:
                self._release(path)
        self._write(f"{path}.used", str(time.time()), True)
        return Stage(self.spark.read.parquet(path), path, reused)

    def expire(self, seconds: float) -> list[str]:
        """Remove the stages that were not used for ``seconds`` and are not being built; their paths."""
        system, root = self._at(self.folder)
        gone = []
        for name in system.listStatus(root) if system.exists(root) else []:
            for entry in system.listStatus(name.getPath()) if name.isDirectory() else []:
                path = entry.getPath().toString()
                used = self._read(f"{path}.used") if entry.isDirectory() else None
                leased = self._read(f"{path}.lease") if entry.isDirectory() else None
                last = float(used) if used else entry.getModificationTime() / 1000
                if not entry.isDirectory() or time.time() - last < seconds or (leased and float(leased.split(" ")[1]) > time.time()):
                    continue
                system.delete(entry.getPath(), True)
                for mark in ("used", "lease"):
                    system.delete(self._at(f"{path}.{mark}")[1], False)
                gone.append(path)
        return gone
