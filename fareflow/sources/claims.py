"""Exclusive claims through the file system: whoever creates the next number holds the claim.

A claim is a folder of numbered files. The newest file says who holds it and until when; a
holder extends that while it works. Once it is released, or its time has run out, the next
claimant creates the next number, which the file system lets only one of them do. How firm that
is depends on the store: HDFS creates atomically, an object store needs conditional writes.
Clocks of claimants must agree to well within ``LASTS``.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Seconds that a claim outlives the last sign of its holder.
LASTS = 600.0
# Seconds between two looks at a claim that another one holds.
EVERY = 0.5

_RELEASED = ".released"


class ClaimLost(RuntimeError):
    """Another claimant has taken over, because this one gave no sign for too long."""


class Claim:
    """One claim on ``name`` beside ``root``; see ``claimed``."""

    def __init__(self, spark: SparkSession, root: str, name: str, lasts: float = LASTS) -> None:
        self._jvm = spark.sparkContext._jvm
        self.folder = f"{root.rstrip('/')}-claims/{name}"
        system = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._is_local = system.getScheme() == "file"
        self._system = system.getRaw() if self._is_local else system
        self._new_array = spark.sparkContext._gateway.new_array
        self.owner, self.lasts, self.number = uuid.uuid4().hex, lasts, 0

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _names(self) -> list[str]:
        if not self._system.exists(self._path("")):
            return []
        return sorted(entry.getPath().getName() for entry in self._system.listStatus(self._path("")))

    def _content(self) -> bytearray:
        return bytearray(f"{self.owner} {time.time() + self.lasts}".encode())

    def _write(self, name: str, overwrite: bool) -> None:
        out = self._system.create(self._path(name), overwrite)
        try:
            out.write(self._content())
        finally:
            out.close()

    def _create(self, name: str) -> bool:
        """Write a file that must not be there yet."""
        try:
            if self._is_local:
                self._create_local(name)
            else:
                self._write(name, overwrite=False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _create_local(self, name: str) -> None:
        """Hadoop looks first and creates then on a local disk; Java creates in one step."""
        files = self._jvm.java.nio.file
        options = self._new_array(files.OpenOption, 2)
        options[0], options[1] = files.StandardOpenOption.CREATE_NEW, files.StandardOpenOption.WRITE
        self._system.mkdirs(self._path(""))
        files.Files.write(self._system.pathToFile(self._path(name)).toPath(), self._content(), options)

    def _read(self, name: str) -> tuple[str, float]:
        """Who holds a number and until when; one that is being written, or has gone, is held."""
        try:
            source = self._system.open(self._path(name))
        except Py4JJavaError as error:
            if "FileNotFound" in error.java_exception.getClass().getName():
                return "", time.time() + self.lasts
            raise
        try:
            text = bytes(source.readAllBytes()).decode()
        finally:
            source.close()
        owner, _, until = text.partition(" ")
        return owner, float(until) if until else time.time() + self.lasts

    def newest(self) -> int:
        return max((int(n) for n in self._names() if n.isdigit()), default=0)

    def try_take(self) -> bool:
        """Take the claim if nobody holds it."""
        names = self._names()
        last = max((int(n) for n in names if n.isdigit()), default=0)
        if last and f"{last:012d}{_RELEASED}" not in names and self._read(f"{last:012d}")[1] > time.time():
            return False
        if not self._create(f"{last + 1:012d}"):
            return False
        if self._read(f"{last + 1:012d}")[0] != self.owner:
            return False
        self.number = last + 1
        for name in names:
            self._system.delete(self._path(name), False)
        return True

    def check(self) -> None:
        """Fail if another claimant has taken over. Call it right before what must happen once."""
        if self.newest() != self.number or self._read(f"{self.number:012d}")[0] != self.owner:
            raise ClaimLost(f"{self.folder} is held by another claimant")

    def renew(self) -> None:
        self.check()
        self._write(f"{self.number:012d}", overwrite=True)

    def release(self) -> None:
        if self.newest() == self.number:
            self._write(f"{self.number:012d}{_RELEASED}", overwrite=True)


@contextmanager
def claimed(
    spark: SparkSession, root: str, name: str, wait: float | None = None, lasts: float = LASTS
) -> Iterator[Claim]:
    """Hold the claim for the block; ``wait`` seconds for it at most, None for as long as it takes."""
    claim = Claim(spark, root, name, lasts)
    give_up = None if wait is None else time.time() + wait
    while not claim.try_take():
        if give_up is not None and time.time() >= give_up:
            raise TimeoutError(f"{claim.folder} is still held by another claimant")
        time.sleep(EVERY)
    done = threading.Event()

    def keep() -> None:
        while not done.wait(lasts / 4):
            try:
                claim.renew()
            except ClaimLost:
                return

    keeper = threading.Thread(target=keep, daemon=True)
    keeper.start()
    try:
        yield claim
    finally:
        done.set()
        keeper.join()
        claim.release()
