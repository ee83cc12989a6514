"""Several outputs as one commit, with resume (K3, K6).

A job writes its parts one after the other into one folder. A part that is done gets a small
marker with the job's fingerprint; the manifest, written last, says that all are done. So

* a folder without anything of ours that is not empty is refused, as is a finished one;
* a job that stopped is gone on with: parts done by the same job are kept, half-written
  ones are written anew, and parts of another job (other settings or inputs) are an error;
* readers that look for the manifest never see part of a job.

``overwrite`` starts anew: the manifest goes first, the parts are replaced one by one.
Markers go through the store's own file system, so any store that Spark writes to will do.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

MANIFEST, MARKERS = "_MANIFEST.json", "_parts"


class Folder:
    """A folder of a store that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> dict | None:
        at = self._at(name)
        if not self.fs.exists(at):
            return None
        stream = self.fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, name: str, value: dict) -> None:
        """Whole or not at all: written under another name first."""
        held = self._at(f"{name}.writing")
        out = self.fs.create(held, True)
        out.write(bytearray(json.dumps(value, sort_keys=True, indent=1).encode()))
        out.close()
        self.fs.delete(self._at(name), False)
        if not self.fs.rename(held, self._at(name)):
            raise OSError(f"{name} could not be written in {self.path}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def input_files(spark: SparkSession, path: str | None) -> list:
    """``[path, bytes, time of change]`` of the file or of a folder's files: what a resumed job must find as it was."""
    if path is None:
        return []
    jvm = spark.sparkContext._jvm
    found = []
    for one in path.split(","):
        at = jvm.org.apache.hadoop.fs.Path(one)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(at):
            continue
        files = fs.listFiles(at, True)
        while files.hasNext():
            s = files.next()
            found.append([s.getPath().toString(), s.getLen(), s.getModificationTime()])
    return sorted(found)


class Outputs:
    """The outputs of one job in ``path``; ``settings`` (plain values) tell it from other jobs."""

    def __init__(self, spark: SparkSession, path: str, settings: dict, overwrite: bool = False):
        self.folder = Folder(spark, path)
        self.path = self.folder.path
        text = json.dumps(settings, sort_keys=True, default=str)
        self.job = hashlib.sha256(text.encode()).hexdigest()
        self.done: list = []
        self.kept: list = []
        if overwrite:
            self.folder.delete(MANIFEST)
            self.folder.delete(MARKERS)
        elif self.folder.read(MANIFEST) is not None:
            raise FileExistsError(f"{path} holds a finished job; use overwrite")
        elif self.folder.names() and MARKERS not in self.folder.names():
            raise FileExistsError(f"{path} already exists and is not empty; use overwrite")
        held = self.folder.read(f"{MARKERS}/job.json")
        if held is not None and held["job"] != self.job:
            raise FileExistsError(f"{path} holds parts of another job (other settings or inputs); use overwrite")
        self.folder.write(f"{MARKERS}/job.json", {"job": self.job, "settings": text})

    def part(self, name: str, write: Callable[[str], None]) -> str:
        """Path of the part ``name``; ``write(path)`` makes it, replacing what may be there, unless it is done."""
        marker = f"{MARKERS}/{name.replace('/', '-')}.json"
        path = f"{self.path}/{name}"
        if self.folder.read(marker) == {"job": self.job, "part": name}:
            self.kept.append(name)
        else:
            write(path)
            self.folder.write(marker, {"job": self.job, "part": name})
        self.done.append(name)
        return path

    def commit(self) -> None:
        """All parts are there: the manifest is written, the markers go."""
        self.folder.write(MANIFEST, {"job": self.job, "parts": self.done})
        self.folder.delete(MARKERS)


def finished_parts(spark: SparkSession, path: str) -> list[str]:
    """The parts of a finished job; an error if the job is not done."""
    manifest = Folder(spark, path).read(MANIFEST)
    if manifest is None:
        raise FileNotFoundError(f"no finished job in {path}")
    return manifest["parts"]
