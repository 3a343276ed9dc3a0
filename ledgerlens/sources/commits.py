"""Tables that change by one published list of folders.

A table is a folder of immutable parquet folders and numbered lists, ``_lists/000000000001.json`` and so
on; the newest list names the folders that are the table now.  A change writes its rows
into folders of its own first and then publishes the next list by a rename that fails if
that number is taken.  So

* a run that stops before the rename leaves rows that no list names: nobody reads them;
* of two runs that began from one list the second is refused, and looks again;
* readers see all of a change or nothing of it.

The rename is atomic where the file system's is (HDFS); a store without one needs its own
conditional put.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LISTS = "_lists"
#: Parts that a task writes at a time; rows of further ones are sorted first.  A scan's task reads fewer files:
#: each counts 4 MB at least of its 128.
_OPEN_PARTS = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class Refused(Exception):
    """Another run has published since the list was read."""


@dataclass(frozen=True)
class Version:
    """``number`` 0 is a table that nothing was published to; ``parts`` maps a part's name to its folder."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def current(spark: SparkSession, target: str) -> Version:
    """The newest published list of ``target``.  A plain parquet table that stands there without one is
    its first part."""
    numbers = [int(n[:-5]) for n in _names(spark, f"{target}/{_LISTS}") if n.endswith(".json") and n[:-5].isdigit()]
    if not numbers:
        plain = any(n.endswith(".parquet") for n in _names(spark, target))
        return Version(0, {"plain": "*.parquet"} if plain else {})
    # one small file, read as it is
    rows = spark.read.text(f"{target}/{_LISTS}/{max(numbers):012d}.json", wholetext=True).collect()
    return Version(max(numbers), json.loads(rows[0]["value"]))


def read(spark: SparkSession, target: str, schema: T.StructType, version: Version | None = None, parts: list[str] | None = None) -> DataFrame:
    """The rows of ``version`` (the newest by default), of all its parts or of ``parts``; empty if there are none."""
    version = version or current(spark, target)
    folders = [f for name, f in sorted(version.parts.items()) if parts is None or name in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{target}/{f}" for f in folders])


def file_count(spark: SparkSession, target: str, version: Version, part: str) -> int:
    """How many files the folder of ``part`` holds; 0 without that part."""
    if part not in version.parts:
        return 0
    fs, folder = _files(spark, f"{target}/{version.parts[part]}")
    return fs.getContentSummary(folder).getFileCount()


def new_folder() -> str:
    return f"rows-{uuid.uuid4().hex}"


def publish(spark: SparkSession, target: str, base: Version, parts: dict[str, str]) -> Version:
    """``parts`` as the list after ``base``; ``Refused`` if that place is taken."""
    number = base.number + 1
    fs, folder = _files(spark, f"{target}/{_LISTS}")
    fs.mkdirs(folder)
    _, beside = _files(spark, f"{target}/{_LISTS}/.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(bytearray(json.dumps(parts).encode()))
    out.close()
    _, place = _files(spark, f"{target}/{_LISTS}/{number:012d}.json")
    fs_of = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        fs_of.rename(beside, place, no_options)
    except Exception as e:
        if fs.exists(place):
            fs.delete(beside, False)
            raise Refused(f"{target}: list {number} was published by another run") from e
        raise
    return Version(number, dict(parts))


def append(df: DataFrame, target: str, base: Version) -> Version:
    """The rows of ``df`` added to ``base`` as one part."""
    folder = new_folder()
    df.write.mode("errorifexists").parquet(f"{target}/{folder}")
    return publish(df.sparkSession, target, base, {**base.parts, folder: folder})


def replace(df: DataFrame, target: str, base: Version, by: str, touched: list) -> Version:
    """The parts ``touched`` of ``base`` replaced by the rows of ``df``, one part per value of its column ``by``;
    a touched part without rows is gone, all others stay as they are."""
    spark = df.sparkSession
    folder = new_folder()
    before = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, str(_OPEN_PARTS))  # else all rows are sorted by part
    try:
        df.write.mode("errorifexists").partitionBy(by).parquet(f"{target}/{folder}")
    finally:
        spark.conf.unset(_WRITERS) if before is None else spark.conf.set(_WRITERS, before)
    written = {n.split("=", 1)[1]: f"{folder}/{n}" for n in _names(spark, f"{target}/{folder}") if n.startswith(f"{by}=")}
    kept = {n: f for n, f in base.parts.items() if n not in {str(t) for t in touched}}
    return publish(spark, target, base, {**kept, **written})
