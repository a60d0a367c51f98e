"""Versions of a table: which directories make it up, switched from one to the next in one step.

`<root>/manifests/<table>/<version>.json` names the directories of each partition value. Data are written first, into directories of their own; then the next manifest appears by a rename that fails if it is there already. Readers take
the manifest with the greatest number, so that they see the table before or after a write and nothing between, and a job
that ends in between leaves directories that nobody reads. Files are never changed: a reader that has begun goes on with its version.

A manifest has a line for each partition value (a day or a month), and is read and written by the driver.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Where a table has no partition column, its directories go by this value.
WHOLE = ""
#: Attempts of a writer whose manifest another writer's has come before.
ATTEMPTS = 10


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    #: Partition value to its directories, below the table's own.
    parts: dict[str, list[str]] = field(default_factory=dict)

    @property
    def directories(self) -> list[str]:
        return [d for value in sorted(self.parts) for d in self.parts[value]]

    @property
    def newest(self) -> str | None:
        """The greatest partition value."""
        return max(self.parts, default=None)

    def replaced(self, parts: dict[str, list[str]]) -> Manifest:
        """These partition values instead of what they were."""
        return Manifest(self.version + 1, {**self.parts, **parts})

    def overwritten(self, parts: dict[str, list[str]]) -> Manifest:
        return Manifest(self.version + 1, parts)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _folder(root: str, name: str) -> str:
    return f"{root}/manifests/{name}"


def _versions(spark: SparkSession, root: str, name: str) -> list[int]:
    fs, folder = _file_system(spark, _folder(root, name))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _load(spark: SparkSession, root: str, name: str, version: int) -> Manifest:
    fs, at = _file_system(spark, f"{_folder(root, name)}/{version}.json")
    stream = fs.open(at)
    try:
        return Manifest(version, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def current(spark: SparkSession, root: str, name: str) -> Manifest | None:
    """The newest manifest; None if the table has none."""
    versions = _versions(spark, root, name)
    return _load(spark, root, name, versions[-1]) if versions else None


def commit(spark: SparkSession, root: str, name: str, change: Callable[[Manifest], Manifest]) -> Manifest:
    """Make `change` of the newest manifest the next one. If another writer was faster, its manifest is the one that is changed."""
    fs, folder = _file_system(spark, _folder(root, name))
    fs.mkdirs(folder)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    never_over = spark.sparkContext._gateway.new_array(rename, 1)
    never_over[0] = rename.NONE
    for _ in range(ATTEMPTS):
        new = change(current(spark, root, name) or Manifest())
        made = jvm.org.apache.hadoop.fs.Path(folder, f"{new.version}.{time.time_ns()}.new")
        stream = fs.create(made, False)
        stream.write(bytearray(json.dumps(new.parts, indent=1).encode()))
        stream.close()
        try:
            context.rename(made, jvm.org.apache.hadoop.fs.Path(folder, f"{new.version}.json"), never_over)
            return new
        except Py4JJavaError as lost:
            fs.delete(made, False)
            if "FileAlreadyExists" not in lost.java_exception.getClass().getName():
                raise
    raise RuntimeError(f"{name}: other writers came first {ATTEMPTS} times")


def remove_unread(spark: SparkSession, root: str, name: str, keep: int = 2, older_than_hours: float = 48.0) -> list[str]:
    """Delete manifests before the last `keep`, and writes of which those name nothing and that have lain for `older_than_hours`
    (a writer may not have committed yet). Gives the directories."""
    versions = _versions(spark, root, name)
    named = {d.split("/")[0] for v in versions[-keep:] for d in _load(spark, root, name, v).directories}
    for v in versions[:-keep]:
        fs, at = _file_system(spark, f"{_folder(root, name)}/{v}.json")
        fs.delete(at, False)
    fs, writes = _file_system(spark, f"{root}/{name}/v=*")
    before, gone = time.time() * 1000 - older_than_hours * 3_600_000, []
    for status in fs.globStatus(writes) or []:
        if status.getPath().getName() not in named and status.getModificationTime() <= before:
            fs.delete(status.getPath(), True)
            gone.append(status.getPath().getName())
    return sorted(gone)
