"""A dimension kept as versions: a base and dated changes, named by a manifest that is put in place in one step.

A table is a folder. ``data/`` holds folders of rows that are never changed once written; ``versions/`` holds one small
JSON file for each version, which lists the base and the changes it consists of, oldest first. A version exists when
its file does: the file is written under another name and renamed, which either happens or does not, and fails
if another writer took the number. A job that dies before that leaves folders that no version names, and readers of
the version before notice nothing.

* :func:`refresh` writes only the latest row of each key among the updates, so it costs what the updates cost;
* :func:`read` resolves base and changes: keys that no change mentions pass straight through, the others are
  compared by the order columns. A version or a day of the past can be asked for;
* :func:`compact` writes a new base, as a version of its own;
* :func:`vacuum` removes folders that none of the newest versions names.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.operators.quality import latest_per_key


class ConflictError(RuntimeError):
    """Another writer put a version in place first. Nothing was changed; the refresh can be repeated."""


@dataclass(frozen=True)
class Change:
    """A folder of rows and the day they are from."""

    folder: str
    day: str
    rows: int


@dataclass(frozen=True)
class Version:
    """What a table consists of at one time. ``schema`` is the rows' schema as JSON."""

    number: int
    key: str
    order: tuple[str, ...]
    schema: str
    base: Change | None = None
    changes: tuple[Change, ...] = field(default=())

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> Version:
        d = json.loads(text)
        change = lambda x: Change(**x) if x else None
        return Version(d["number"], d["key"], tuple(d["order"]), d["schema"], change(d["base"]), tuple(change(x) for x in d["changes"]))


class _Folder:
    """Small files and renames through Spark's own file systems, so any path that Spark reads will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = path.rstrip("/")
        self.root = self.jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = self.root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        where = self.at(name)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a file under another name and rename it; False if there is one of that name."""
        self.fs.mkdirs(self.at(name).getParent())
        beside = self.at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(beside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.at(name)) or not self.fs.rename(beside, self.at(name)):
            self.fs.delete(beside, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all versions, oldest first."""
    return sorted(int(n.removesuffix(".json")) for n in _Folder(spark, path).names("versions") if n.endswith(".json"))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, by default the newest; None where the table has none yet."""
    known = versions(spark, path)
    if number is None and not known:
        return None
    return Version.of(_Folder(spark, path).text(f"versions/{known[-1] if number is None else number:09d}.json"))


def _commit(spark: SparkSession, path: str, new: Version) -> Version:
    if not _Folder(spark, path).put(f"versions/{new.number:09d}.json", new.text()):
        raise ConflictError(f"version {new.number} of {path} exists")
    return new


def _write(rows: DataFrame, path: str, day: dt.date) -> Change:
    folder = f"data/{uuid.uuid4().hex}"
    where = f"{path.rstrip('/')}/{folder}"
    rows.write.parquet(where)
    return Change(folder, day.isoformat(), rows.sparkSession.read.schema(rows.schema).parquet(where).count())


def refresh(path: str, updates: DataFrame, key: str, order: Sequence[str], day: dt.date) -> Version:
    """Add the updates of a day as a version: the first one is the base, later ones are changes.

    Of rows that share a key the one with the greatest ``order`` columns counts, then the other columns decide; rows
    without key are left out. No updates make no version. A later refresh may have other columns only if it keeps the schema.
    """
    spark = updates.sparkSession
    now = version(spark, path)
    if now and now.schema != updates.schema.json():
        raise ValueError(f"{path} has other columns: {now.schema}")
    change = _write(latest_per_key(updates, key, order), path, day)
    if now and not change.rows:
        return now
    if now is None:
        return _commit(spark, path, Version(1, key, tuple(order), updates.schema.json(), change))
    return _commit(spark, path, Version(now.number + 1, now.key, now.order, now.schema, now.base, (*now.changes, change)))


def _rows(spark: SparkSession, path: str, change: Change, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{change.folder}")


def read(spark: SparkSession, path: str, number: int | None = None, as_of: dt.date | None = None) -> DataFrame:
    """The rows of a version, by default the newest, one per key; with ``as_of`` only what was known by that day.

    Keys of the base that no change mentions pass straight through. The keys of the changes are as many as the
    changes have rows; the planner broadcasts them by their bytes, and shuffles the base only where they are too many.
    """
    from pyspark.sql.types import StructType

    found = version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"no version in {path}")
    schema = StructType.fromJson(json.loads(found.schema))
    day = "9999-12-31" if as_of is None else as_of.isoformat()
    changes = [_rows(spark, path, c, schema) for c in found.changes if c.day <= day and c.rows]
    base = _rows(spark, path, found.base, schema)
    if found.base.day > day:
        base = base.limit(0)
    if not changes:
        return base
    changed = reduce(DataFrame.unionByName, changes)
    keys = changed.select(F.col(found.key).alias("_key"))
    mentioned = base[found.key] == keys["_key"]
    same = base.join(keys, mentioned, "left_anti")
    newest = latest_per_key(base.join(keys, mentioned, "left_semi").unionByName(changed), found.key, found.order)
    return same.unionByName(newest)


def compact(spark: SparkSession, path: str) -> Version:
    """A version with the same rows whose base holds them all. The folders of earlier versions stay until ``vacuum``."""
    now = version(spark, path)
    if now is None:
        raise FileNotFoundError(f"no version in {path}")
    if not now.changes:
        return now
    last = max(c.day for c in (now.base, *now.changes))
    base = _write(read(spark, path, now.number), path, dt.date.fromisoformat(last))
    return _commit(spark, path, Version(now.number + 1, now.key, now.order, now.schema, base))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove versions but for the newest ``keep``, and data folders that none of those names; returns the folders.

    Folders of a refresh under way are not named yet: run it while nobody writes.
    """
    folder = _Folder(spark, path)
    known = versions(spark, path)
    for number in known[: max(0, len(known) - max(1, keep))]:
        folder.delete(f"versions/{number:09d}.json")
    left = [version(spark, path, n) for n in versions(spark, path)]
    named = {c.folder for v in left for c in (v.base, *v.changes)}
    gone = [f"data/{n}" for n in folder.names("data") if f"data/{n}" not in named]
    for name in gone:
        folder.delete(name)
    return gone


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per version: number, day of its newest rows, changes, and the rows it wrote."""
    rows = []
    for n in versions(spark, path):
        v = version(spark, path, n)
        newest = v.changes[-1] if v.changes else v.base
        rows.append((v.number, dt.date.fromisoformat(newest.day), len(v.changes), newest.rows))
    return spark.createDataFrame(rows, "version int, day date, changes int, rows_written long")
