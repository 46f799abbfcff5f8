"""Stages that are written, checked, then published.

A versioned stage is a folder:

* ``data/<name>/``  one folder of files per write, never changed afterwards;
* ``log/<number>``  one small text file per published version: a JSON line
  with the data folder, its row count and schema.

The current version is the largest number in the log. A write goes to a fresh
data folder, is read back and checked; only then a log file is created, by one call
that fails if the number is taken. So readers see the old version or the new one
whole, a failed write changes nothing, and of two publishers at the same time one
gets the number and the other the next. A frame that was opened before keeps
reading its own folder. Rolling back publishes an old folder again under a new number.
``expire`` deletes data that no recent version names.

The log file is created by the file system's exclusive create, which HDFS and
local disks have and object stores with conditional writes offer.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera.operators.quality import expect_schema
from tessera.sources.io import remove


class Unpublished(ValueError):
    """A write that failed its checks; the stage is as it was."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    rows: int
    schema: str
    published: float
    note: str = ""


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file unless it is there; true if it was created.

    Written under another name first and renamed, which never replaces a file,
    so a reader cannot meet a half-written one.
    """
    fs, where = _files(spark, path)
    _, draft = _files(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    claim = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.claim")
    try:
        # The exclusive step: of several publishers, one creates the claim.
        fs.create(claim, False).close()
    except Exception:  # noqa: BLE001 - the file system's own "already exists"
        fs.delete(draft, False)
        return False
    return bool(fs.rename(draft, where))


def history(spark: SparkSession, root: str) -> list[Version]:
    """The published versions, oldest first."""
    fs, _ = _files(spark, root)
    out = []
    for name in _names(spark, f"{root}/log"):
        if name.isdigit():
            _, where = _files(spark, f"{root}/log/{name}")
            stream = fs.open(where)
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            out.append(Version(int(name), **json.loads(text)))
    return out


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A published version, the current one without ``number``."""
    found = [v for v in history(spark, root) if number is None or v.number == number]
    if not found:
        raise LookupError(f"{root} has no published version{'' if number is None else f' {number}'}")
    return found[-1]


def read(spark: SparkSession, root: str, number: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A published version as it is; publishing others meanwhile does not change the frame."""
    v = version(spark, root, number)
    return spark.read.schema(StructType.fromJson(json.loads(v.schema))).format(fmt).load(f"{root}/data/{v.folder}")


def _enter(spark: SparkSession, root: str, entry: dict) -> Version:
    fs, where = _files(spark, f"{root}/log")
    fs.mkdirs(where)
    while True:
        taken = [int(n.removesuffix(".claim")) for n in _names(spark, f"{root}/log") if n.removesuffix(".claim").isdigit()]
        number = max(taken, default=0) + 1
        if _create(spark, f"{root}/log/{number:012d}", json.dumps(entry)):
            return Version(number, **entry)


def publish(df: DataFrame, root: str, schema: StructType | None = None, least_rows: int = 0, rows: int | None = None,
            checks: Sequence[Callable[[DataFrame], Sequence[str]]] = (), note: str = "", fmt: str = "parquet",
            partition_by: Sequence[str] = ()) -> Version:
    """Write ``df``, check what was written, and make it the current version.

    Checked on the files, not on the plan: the schema (``schema`` if given,
    else that of ``df``), the number of rows (``rows`` exactly if given,
    ``least_rows`` at least), and whatever ``checks`` say (each gets the
    written frame and returns problems as text). With a problem, the files are
    deleted and ``Unpublished`` is raised. An exception in the write itself
    leaves nothing published either.
    """
    spark = df.sparkSession
    folder = uuid.uuid4().hex
    path = f"{root}/data/{folder}"
    try:
        writer = df.write.format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
        there = spark.read.format(fmt).load(path)
        problems = expect_schema(there, schema or df.schema)
        n = there.count()
        if rows is not None and n != rows:
            problems.append(f"{n} rows instead of {rows}")
        if n < least_rows:
            problems.append(f"{n} rows, fewer than {least_rows}")
        for check in checks:
            problems += check(there)
        if problems:
            raise Unpublished("; ".join(problems))
    except Exception:
        remove(spark, path)
        raise
    entry = {"folder": folder, "rows": n, "schema": json.dumps(there.schema.jsonValue()), "published": time.time(), "note": note}
    return _enter(spark, root, entry)


def roll_back(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """Publish version ``number`` again, by default the one before the current."""
    past = history(spark, root)
    found = [v for v in past if v.number == number] if number is not None else past[-2:-1]
    if not found:
        raise LookupError(f"{root} has no version to go back to")
    entry = asdict(found[0]) | {"published": time.time(), "note": f"rolled back to {found[0].number}"}
    entry.pop("number")
    return _enter(spark, root, entry)


def expire(spark: SparkSession, root: str, keep: int = 2, older_than: float = 0.0) -> list[str]:
    """Delete the data that none of the last ``keep`` versions names; return the folders that went.

    Folders newer than ``older_than`` seconds stay: they may be writes that are
    not published yet, and frames opened a moment ago may still read them.
    Log entries of deleted data go first, so no version points to nothing.
    """
    past = history(spark, root)
    held = {v.folder for v in past[-max(1, keep):]}
    fs, where = _files(spark, f"{root}/data")
    if not fs.exists(where):
        return []
    limit = (time.time() - older_than) * 1000
    gone = [s.getPath().getName() for s in fs.listStatus(where)
            if s.getPath().getName() not in held and s.getModificationTime() <= limit]
    for v in past:
        if v.folder in gone:
            remove(spark, f"{root}/log/{v.number:012d}")
    for folder in gone:
        remove(spark, f"{root}/data/{folder}")
    return sorted(gone)
