"""Versions of a table: which directory holds each snapshot.

A table's folder has runs, the directories that writes have made, and version
files.  Readers follow the version file with the largest number.  A version is
published by renaming its complete file into place, so it is there as a whole or
not at all; the directories that it names are complete before that.

    <table>/run=<id>/snapshot_date=2023-01-01/part-....parquet
    <table>/_versions/0000000007.json

The folder must therefore be read through :func:`~ledgerloom.sources.snapshots.read_snapshots`:
its directories alone do not say which of them are current.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

RUN = "run="
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
KEPT = 2  # versions whose directories are kept, for readers that opened them
ABANDONED_DAYS = 7  # age of a run that no version names, from which it is removed
ATTEMPTS = 20


@dataclass
class Version:
    number: int = 0
    directories: dict[str, str] = field(default_factory=dict)  # snapshot to directory
    schema: T.StructType | None = None


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, snapshot: str):
        self.spark, self.root, self.prefix = spark, path.rstrip("/"), f"{snapshot}="
        self.files = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _listed(self, name: str = "") -> dict[str, int]:
        """Names in a folder and when they were changed, in milliseconds."""
        path = self._path(name)
        if not self.files.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.files.listStatus(path)}

    def _snapshots_in(self, run: str = "") -> dict[str, str]:
        """Snapshot directories in a run, or in the folder itself."""
        inside = f"{run}/" if run else ""
        return {
            name.removeprefix(self.prefix): inside + name for name in self._listed(run) if name.startswith(self.prefix)
        }

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._listed("_versions") if n.endswith(".json"))

    @staticmethod
    def _file(number: int) -> str:
        return f"_versions/{number:010}.json"

    def _read(self, number: int) -> Version:
        stream = self.files.open(self._path(self._file(number)))
        try:
            stored = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, stored["directories"], T.StructType.fromJson(stored["schema"]))

    def current(self) -> Version:
        """The latest version; of a folder without versions, its own directories."""
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else Version(directories=self._snapshots_in())

    def new_run(self) -> str:
        return f"{RUN}{uuid.uuid4().hex}"

    def publish(self, run: str, emptied: set[str], schema: T.StructType) -> Version:
        """Make the snapshots of ``run`` current, and those of ``emptied`` that it does
        not hold absent.

        If another writer publishes meanwhile, its version is the base instead.
        """
        written = self._snapshots_in(run)
        for _ in range(ATTEMPTS):
            base = self.current()
            if base.number == 0 and base.directories:
                # a folder of plain snapshot directories: its state is the first version
                base = Version(1, base.directories, schema)
                if not self._renamed(base):
                    continue
            kept = {d: at for d, at in base.directories.items() if d not in emptied}
            version = Version(base.number + 1, {**kept, **written}, schema)
            if self._renamed(version):
                return version
        raise RuntimeError(f"{self.root}: other writers published {ATTEMPTS} versions meanwhile")

    def _renamed(self, version: Version) -> bool:
        """Write the version's file aside and rename it; False if its number is taken."""
        draft = self._path(f"_versions/.{uuid.uuid4().hex}")
        stored = {"directories": version.directories, "schema": version.schema.jsonValue()}
        stream = self.files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(stored, indent=1).encode()))
        finally:
            stream.close()
        final = self._path(self._file(version.number))
        # some file systems' rename replaces an existing file
        if not self.files.exists(final) and self.files.rename(draft, final):
            return True
        self.files.delete(draft, False)
        return False

    def remove_superseded(self) -> None:
        """Remove directories that only versions before the last ``KEPT`` name, these
        versions' files, and runs that were abandoned long ago.

        A run that no version names may be one that is being written.
        """
        numbers = self._numbers()
        old, kept = numbers[:-KEPT], numbers[-KEPT:]
        used = {at for n in kept for at in self._read(n).directories.values()}
        for number in old:
            for at in sorted(set(self._read(number).directories.values()) - used):
                self.files.delete(self._path(at), True)
            self.files.delete(self._path(self._file(number)), False)
        runs = {at.split("/")[0] for at in used}
        before = (time.time() - ABANDONED_DAYS * 86_400) * 1000
        for name, changed in self._listed().items():
            if name.startswith(RUN) and name not in runs and (changed < before or not self._snapshots_in(name)):
                self._remove_run(name, changed < before)

    def _remove_run(self, name: str, abandoned: bool) -> None:
        """An abandoned run, or one whose snapshots are all removed."""
        finished = "_SUCCESS" in self._listed(name)
        if abandoned or finished:
            self.files.delete(self._path(name), True)
