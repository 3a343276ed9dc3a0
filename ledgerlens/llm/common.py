"""Helpers shared by the operators: table reads, shared-folder tables, text columns."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import shared_dir

#: Rows of an Arrow batch handled at a time, so Python lists stay small.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Shuffle files are of no use once their result is written; without this they stay until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of the materialized tables.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: later jobs reread the files, also after executors are lost.  The shuffle files of the
    write go with it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more: all that was made of them is written itself."""
    for df in tables:
        path = _folders.pop(df)
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def raw_texts(column: pa.Array) -> list:
    """A string column as UTF-8 bytes; an array of binaries as lists of them."""
    return (column if pa.types.is_list(column.type) else column.cast(pa.binary())).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_text_columns(
    df: DataFrame,
    text: str,
    make: Callable[[], Callable[[list[bytes | None]], list[list]]],
    fields: list[tuple[str, str, pa.DataType]],
    drop_text: bool = False,
) -> DataFrame:
    """``df`` with columns computed from the string column ``text``, row by row.

    ``make`` runs once a task and gives a function from a list of texts (UTF-8
    bytes or None) to one list of values for each of ``fields`` (name, Spark
    type, Arrow type).  No shuffle; all other columns pass through untouched.
    """
    kept = [f for f in df.schema.fields if not (drop_text and f.name == text)]
    added = [T.StructField(name, T.StructType.fromDDL(f"x {ddl}")[0].dataType) for name, ddl, _ in fields]
    names = [f.name for f in kept] + [f.name for f in added]
    arrow = [kind for _, _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for part in slices(batches):
            place = part.schema.get_field_index(text)
            values = compute(raw_texts(part.column(place)))
            old = [part.column(part.schema.get_field_index(f.name)) for f in kept]
            new = [pa.array(v, type=kind) for v, kind in zip(values, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(old + new, names=names)

    return df.mapInArrow(run, T.StructType(kept + added))
