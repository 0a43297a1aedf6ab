"""Shared storage used to cut lineage and to hand tables from one job to the next."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="clickloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/clickloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and return the stored table.

    Iterative fits read the stored copy, so a lost executor costs one re-read and not the whole
    lineage.
    """
    return _stored(df, shared_path(df.sparkSession, name))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


class Files:
    """Small files and folders of any file system that Spark can reach."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def _at(self, path: str):
        return _file_system(self._spark, path)

    def exists(self, path: str) -> bool:
        folder, files = self._at(path)
        return files.exists(folder)

    def children(self, path: str) -> list[str]:
        """Names of files and folders directly below ``path``, sorted."""
        folder, files = self._at(path)
        if not files.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(folder))

    def delete(self, path: str) -> None:
        """Delete a file or folder; nothing happens when it is gone already."""
        folder, files = self._at(path)
        files.delete(folder, True)

    def move(self, source: str, target: str) -> None:
        """Rename a file or folder to a place where nothing is."""
        place, files = self._at(source)
        goal = self._spark._jvm.org.apache.hadoop.fs.Path(target)
        files.mkdirs(goal.getParent())
        if not files.rename(place, goal):
            raise OSError(f"cannot move {source} to {target}")

    def read(self, path: str) -> str:
        place, files = self._at(path)
        stream = files.open(place)
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a small file whole: readers find nothing or all of it under its name."""
        draft = f"{path}.{uuid.uuid4().hex}.draft"
        place, files = self._at(draft)
        stream = files.create(place, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(draft, path)


class Ledger:
    """Numbered entries of JSON in a folder; the newest one holds.

    An entry appears whole or not at all, so it is the point at which a change that took several
    steps counts. The entry before stays until the next one stands. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._files = Files(spark)
        self._path = path

    def _numbers(self) -> list[int]:
        names = (n.removesuffix(".json") for n in self._files.children(self._path))
        return sorted(int(n) for n in names if n.isdigit())

    def newest(self) -> tuple[int, dict]:
        """Number and content of the newest entry; ``(-1, {})`` before the first."""
        numbers = self._numbers()
        if not numbers:
            return -1, {}
        return numbers[-1], json.loads(self._files.read(f"{self._path}/{numbers[-1]}.json"))

    def append(self, content: dict, number: int | None = None) -> None:
        """Add an entry, by default under the next number, and drop all but the last two."""
        numbers = self._numbers()
        if number is None:
            number = numbers[-1] + 1 if numbers else 0
        self._files.create(f"{self._path}/{number}.json", json.dumps(content, sort_keys=True))
        for old in numbers[:-1]:
            self._files.delete(f"{self._path}/{old}.json")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a stored table; nothing happens when it is gone already."""
    folder, files = _file_system(spark, path)
    files.delete(folder, True)


class Workspace:
    """Owner of staged tables: they are deleted when the ``with`` block ends.

    Results that outlive the block must not read them; ``keep`` hands a table over to the caller.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._stored: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Workspace:
        return self

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self._spark, name)
        stored = _stored(df, path)
        self._stored.append((stored, path))
        return stored

    def keep(self, *tables: DataFrame) -> None:
        """Leave these staged tables to the caller."""
        self._stored = [(d, p) for d, p in self._stored if all(d is not t for t in tables)]

    def drop(self, *tables: DataFrame) -> None:
        """Delete staged tables that no later step reads."""
        for stored, path in self._stored:
            if any(stored is t for t in tables):
                delete_path(self._spark, path)
        self.keep(*tables)

    def __exit__(self, *_) -> None:
        self.drop(*[stored for stored, _ in self._stored])


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; empty when ``path`` is missing."""
    folder, files = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory())
