"""Tables in the folder that driver and executors share, and the versioned store of quads."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.terms import SCHEMA


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only where it is unset and Spark runs in one process (tests), a local folder is made and set; on a cluster that is an error, as executors would not find it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = found.get() if found.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="quadrille-")
        spark.sparkContext.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quadrille-{spark.sparkContext.applicationId}"


class _Scopes(threading.local):
    def __init__(self):
        self.open: list[list[str]] = []


_scopes = _Scopes()
_tables: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder, read again: lineage ends here, and a lost executor costs only its tasks. :func:`scratch`, :func:`drop` and :func:`release` delete such tables."""
    path = f"{_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if _scopes.open:
        _scopes.open[-1].append(path)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _tables[table] = path
    return table


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that :func:`written` makes inside are deleted at the end, but those given to the function that this yields. Nothing that reads the others may be used after it."""
    own: list[str] = []
    _scopes.open.append(own)

    def keep(table: DataFrame) -> DataFrame:
        own.remove(_tables[table])
        if len(_scopes.open) > 1:
            _scopes.open[-2].append(_tables[table])
        return table

    try:
        yield keep
    finally:
        _scopes.open.remove(own)
        for path in own:
            _delete(spark, path)


def drop(table: DataFrame) -> None:
    """Deletes a table that :func:`written` made; other DataFrames are left alone."""
    if path := _tables.pop(table, None):
        _delete(table.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Deletes every table that :func:`written` made in this application; call it once results are stored."""
    _delete(spark, _root(spark))


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    if not fs.delete(at, True) and fs.exists(at):
        raise OSError(f"{path} could not be deleted")


def _rename(spark: SparkSession, path: str, to: str) -> None:
    fs, at = _at(spark, path)
    _, target = _at(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.exists(at) or fs.exists(target) or not fs.rename(at, target):
        raise OSError(f"{path} could not become {to}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def shared_copy(spark: SparkSession, local: str, name: str) -> str:
    """A file of the driver as a file of the shared folder; :func:`release` deletes it. Returns its path there, which is complete once it exists."""
    path = f"{_root(spark)}/files/{name}"
    part = f"{path}-{uuid.uuid4().hex}"
    fs, at = _at(spark, part)
    fs.copyFromLocalFile(False, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path("file://" + local), at)
    if exists(spark, path):
        _delete(spark, part)
    else:
        _rename(spark, part, path)
    return path


def _names(spark: SparkSession, path: str) -> list[str]:
    """Folders under ``path``, without those that begin with '_' or '.'."""
    fs, at = _at(spark, path)
    found = [(x.isDirectory(), x.getPath().getName()) for x in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n for folder, n in found if folder and n[0] not in "_.")


def folder_name(name: str) -> str:
    """A name as a folder: ASCII letters, digits and '-' stay, other bytes become '_' and two hex digits, so no file system and no reader changes it. It begins with 'n'."""
    return "n" + "".join(chr(b) if re.match(rb"[A-Za-z0-9-]", bytes([b])) else f"_{b:02x}" for b in name.encode())


def name_of(folder: str) -> str:
    return re.sub(rb"_([0-9a-f]{2})", lambda m: bytes.fromhex(m[1].decode()), folder[1:].encode()).decode()


_STORED = T.StructType([*SCHEMA.fields, T.StructField("source", T.StringType()), T.StructField("version", T.StringType())])


class Held(NamedTuple):
    source: str
    version: str
    generation: int
    path: str


class QuadStore:
    """Quads under ``path`` by source and version, any strings; versions sort as strings, such as timestamps.

    A version is a folder of generations, a generation a folder of parts; readers take the highest generation. What is written goes to a folder that readers don't see and
    takes effect by one rename: as a further part (``append``) or as the next generation (``replace``, ``remove``, ``swap``). Older generations are deleted
    after that, so whenever a run ends, a version has its old statements or its new ones.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def held(self, source: str | None = None, version: str | None = None) -> list[Held]:
        """The current generation of each version; a row a version, so few."""
        found = []
        for s in _names(self.spark, self.path) if source is None else [folder_name(source)]:
            for v in _names(self.spark, f"{self.path}/{s}") if version is None else [folder_name(version)]:
                if generations := _names(self.spark, f"{self.path}/{s}/{v}"):
                    found.append(Held(name_of(s), name_of(v), int(generations[-1][1:]), f"{self.path}/{s}/{v}/{generations[-1]}"))
        return found

    def read(self, source: str | None = None, version: str | None = None) -> DataFrame:
        """Statements with source and version; none if there is no such version."""
        paths = [f"{x.path}/{part}" for x in self.held(source, version) for part in _names(self.spark, x.path)]
        return self.spark.read.schema(_STORED).parquet(*paths) if paths else self.spark.createDataFrame([], _STORED)

    def sources(self) -> list[str]:
        return sorted({x.source for x in self.held()})

    def versions(self, source: str) -> list[str]:
        """The versions of a source, oldest first."""
        return sorted(x.version for x in self.held(source))

    def latest(self, source: str) -> DataFrame:
        versions = self.versions(source)
        if not versions:
            raise LookupError(f"no version of {source}")
        return self.read(source, versions[-1])

    def _staged(self, quads: DataFrame, source: str, version: str) -> str:
        path = f"{self.path}/_staged-{uuid.uuid4().hex}"
        quads.select(*SCHEMA.names, F.lit(source).alias("source"), F.lit(version).alias("version")).write.parquet(path)
        return path

    def _version(self, source: str, version: str) -> str:
        return f"{self.path}/{folder_name(source)}/{folder_name(version)}"

    def append(self, quads: DataFrame, source: str, version: str) -> None:
        now = self.held(source, version)
        at = now[0].path if now else f"{self._version(source, version)}/g{0:09d}"
        _rename(self.spark, self._staged(quads, source, version), f"{at}/p{uuid.uuid4().hex}")

    def _replace(self, staged: str, source: str, version: str) -> None:
        now = self.held(source, version)
        whole = f"{self.path}/_whole-{uuid.uuid4().hex}"
        _rename(self.spark, staged, f"{whole}/p{uuid.uuid4().hex}")
        next_ = f"g{now[0].generation + 1 if now else 0:09d}"
        _rename(self.spark, whole, f"{self._version(source, version)}/{next_}")
        for generation in _names(self.spark, self._version(source, version)):
            if generation < next_:
                _delete(self.spark, f"{self._version(source, version)}/{generation}")

    def replace(self, quads: DataFrame, source: str, version: str) -> None:
        """Writes a version in place of what it had, if anything. ``quads`` may read that."""
        self._replace(self._staged(quads, source, version), source, version)

    def clear(self, source: str, version: str | None = None) -> None:
        """Drops a version, or all of a source."""
        _delete(self.spark, f"{self.path}/{folder_name(source)}" if version is None else self._version(source, version))

    def remove(self, quads: DataFrame, source: str, version: str) -> None:
        """Deletes statements, by subject, predicate and object, from a version."""
        keys = ["s", "p", "o_key"]
        if self.held(source, version):
            self.replace(self.read(source, version).join(quads.select(*keys), keys, "left_anti"), source, version)

    def swap(self, quads: DataFrame, source: str, version: str, expected: int | None = None, errors: int = 0) -> int:
        """Writes a version and drops the others; returns its number of rows.

        If nothing was written, there is no new version; and the others stay while the source's size is unknown or more than a fifth of its records failed.
        """
        before = self.versions(source)
        staged = self._staged(quads, source, version)
        n = self.spark.read.schema(_STORED).parquet(staged).count()
        if n:
            self._replace(staged, source, version)
        else:
            _delete(self.spark, staged)
        if n or not (expected is None or errors > expected / 5):
            for old in before:
                if old != version or not n:
                    self.clear(source, old)
        return n

    def clean_up(self, sources: list[str], spare: tuple[str, ...] = ()) -> list[str]:
        """Drops every source that is neither among ``sources`` nor spared; returns their names."""
        gone = sorted(set(self.sources()) - set(sources) - set(spare))
        for source in gone:
            self.clear(source)
        return gone

    def sweep(self) -> None:
        """Deletes staged writes that never took effect. Only to be called while nothing is being written."""
        fs, at = _at(self.spark, self.path)
        for x in fs.listStatus(at) if fs.exists(at) else []:
            if x.getPath().getName().startswith(("_staged-", "_whole-")):
                _delete(self.spark, x.getPath().toString())
