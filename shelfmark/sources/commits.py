"""Tables whose writes count only once they are finished.

A write goes to a folder of its own. A small file in ``_commits``, put there in one
step, then says that it counts and which folders the table consists of. Readers look at
the files of ``_commits`` alone, so they see the table before a write or after it and
never a part of it, and what a failed write left is not read. One writer at a time is
assumed; a second one that ends later is told so.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLDER = "_commits"


class Commits:
    """The finished writes of a table at ``path``, each with a name and what was said of it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        root = self._path(self.path)
        self._files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _file(self, name: str):
        return self._path(f"{self.path}/{FOLDER}/{quote(name, safe='')}.json")

    def names(self) -> list[str]:
        """The names of all finished writes, sorted."""
        folder = self._path(f"{self.path}/{FOLDER}")
        if not self._files.exists(folder):
            return []
        found = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(unquote(n.removesuffix(".json")) for n in found if n.endswith(".json"))

    def get(self, name: str) -> dict | None:
        """What was said of a finished write; None if there is none of that name."""
        file = self._file(name)
        if not self._files.exists(file):
            return None
        stream = self._files.open(file)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, name: str, said: dict) -> bool:
        """Declare a write finished; False if one of that name is already."""
        file = self._file(name)
        if self._files.exists(file):
            return False
        draft = self._path(f"{self.path}/{FOLDER}/.{uuid.uuid4().hex}")
        stream = self._files.create(draft, True)
        stream.write(bytearray(json.dumps(said, sort_keys=True).encode()))
        stream.close()
        if self._files.rename(draft, file):
            return True
        self._files.delete(draft, False)
        return False

    def new_folder(self, kind: str) -> str:
        """A folder below the table that no write has used."""
        return f"{self.path}/{kind}={uuid.uuid4().hex}"

    def drop_folder(self, folder: str) -> None:
        self._files.delete(self._path(folder), True)


def _numbered(log: Commits) -> list[str]:
    return [n for n in log.names() if n.isdigit()]


def publish(df: DataFrame, path: str, keep: int = 2) -> int:
    """Replace the table at ``path`` by ``df`` in one step; its new version number.

    Readers go on reading the version they began with; the last ``keep`` versions stay.
    """
    log = Commits(df.sparkSession, path)
    versions = _numbered(log)
    number = int(versions[-1]) + 1 if versions else 0
    folder = log.new_folder("version")
    df.write.parquet(folder)
    if not log.put(f"{number:012d}", {"folders": [folder], "schema": df.schema.jsonValue()}):
        log.drop_folder(folder)
        raise RuntimeError(f"version {number} of {path} was written by somebody else in the meantime")
    if keep < 1:
        raise ValueError("at least the new version is kept")
    for old in versions[:len(versions) - keep + 1]:
        # Cheap to ask again: a folder that is gone stays gone.
        for folder in (log.get(old) or {}).get("folders", []):
            log.drop_folder(folder)
    return number


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of a published table, or a named one that is still kept."""
    log = Commits(spark, path)
    versions = _numbered(log)
    name = f"{version:012d}" if version is not None else versions[-1] if versions else None
    said = log.get(name) if name is not None else None
    if said is None:
        raise FileNotFoundError(f"no published table at {path}" + ("" if version is None else f" of version {version}"))
    return spark.read.schema(T.StructType.fromJson(said["schema"])).parquet(*said["folders"])


def publish_all(df: DataFrame, paths: Sequence[str], keep: int = 2) -> None:
    """Publish the same table at every path; computed once, the others are copies of the first."""
    first, *others = paths
    publish(df, first, keep)
    for path in others:
        publish(read_published(df.sparkSession, first), path, keep)
