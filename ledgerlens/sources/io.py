"""Sources and sinks used by the jobs.

Plain ``DataFrameReader`` / ``DataFrameWriter`` calls.  Writes go straight
from executors to the target (no staging object).
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..operators.landing import HEADER
from ..session import written

# Daily rate table (fixed DDL of the original job).
RATES_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("currency", T.StringType()),
    T.StructField("rate", T.DoubleType()),
])
RATE_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("rates", T.MapType(T.StringType(), T.DoubleType())),
])
FLAG_LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("form_id", T.LongType()),
    T.StructField("pp_enabled", T.IntegerType()),
    T.StructField("date_created", T.TimestampType()),
])


def _names(head: str) -> list[str]:
    return [n.strip().lstrip("\ufeff") for n in next(csv.reader([head]), [])]


def _read_csv_landing(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """Every line of every file under its own header, by one scan.

    The lines are read once as text and kept in the shared folder; the line at the start of a file
    is its header.  Distinct headers (not files) reach the driver, to name the columns; each line gets
    its file's header by a join and is split once, under positions as many as the widest header has."""
    r = spark.read.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    lines = r.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"), "value",
    )
    lines = written(lines.where("value <> ''"), "landing")
    heads = lines.where("at = 0").groupBy("file").agg(F.min(F.struct("line", "value")).alias("head")).select(
        F.col("file").alias("source_file"), F.col("head.line").alias("first"), F.col("head.value").alias("head")
    )
    headers = {row["head"]: _names(row["head"]) for row in heads.select("head").distinct().collect()}
    if not headers:
        return spark.createDataFrame([], f"{HEADER} array<string>, source_file string")
    # names that differ in case alone are one column, spelled as it sorts first
    columns = {n.lower(): n for h in sorted(headers, reverse=True) for n in reversed(headers[h])}
    width = max(map(len, headers.values()))
    named = spark.createDataFrame([(h, ns, [n.lower() for n in ns]) for h, ns in headers.items()], f"h string, {HEADER} array<string>, names array<string>")
    heads = heads.join(named, F.col("head") == F.col("h")).drop("h", "head")
    rows = lines.join(heads, F.col("file") == F.col("source_file")).where("line <> first")
    split = F.from_csv("value", ", ".join(f"_c{i} string" for i in range(width)))
    values = rows.select("names", HEADER, "source_file", split.alias("row")).select(
        "names", HEADER, "source_file", F.array(*[F.col(f"row._c{i}") for i in range(width)]).alias("row")
    )
    at = lambda n: F.array_position("names", n).cast("int")
    ordered = sorted(columns, key=lambda n: min((i, h) for h, ns in headers.items() for i, x in enumerate(ns) if x.lower() == n))
    return values.select(
        *[F.when(at(n) > 0, F.get("row", at(n) - 1)).alias(columns[n]) for n in ordered], HEADER, "source_file"
    )


def read_landing(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    glob: str | None = "*.csv",
) -> DataFrame:
    """Every landing file under ``path`` (recursive, glob-filtered), all
    values as text, plus the source file path and ``_header``, the column names of
    its file.

    CSV files may differ in their headers: a value always goes to the column it stands
    under, whatever other files say, and a column that a file lacks is NULL there.  Each
    file is read once, by one scan for any number of headers."""
    if fmt == "csv":
        return _read_csv_landing(spark, path, glob)
    r = spark.read.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if fmt == "json":
        df = r.option("primitivesAsString", "true").json(path)
    else:
        df = r.format(fmt).load(path)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_rate_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed rate payloads (JSON lines ``{"date": .., "rates": {..}}``)."""
    return spark.read.schema(RATE_PAYLOAD_SCHEMA).json(path)


def read_ranged_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel range scan of a database table.  Pass the real min/max of
    ``column`` (not a row count) so no id range is skipped; the last range
    is open-ended."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper + 1,
        numPartitions=partitions, properties=properties or {},
    )


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, overwrite."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row skipped, comma separated, fixed schema."""
    return spark.read.schema(schema).option("header", "true").option("sep", ",").csv(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """S15 for path tables: False only if nothing is at ``path``.  A path that holds
    something else than a parquet table raises."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Create an empty table with a fixed schema if nothing is there; True if
    created.  Never overwrites."""
    if table_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
    return True


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    """S15 for catalog tables; True if created."""
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], schema).write.mode("errorifexists").format("parquet").saveAsTable(name)
    return True


def append_table(df: DataFrame, name: str) -> None:
    """S13 for catalog tables: append by column name."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def overwrite_table(df: DataFrame, name: str) -> None:
    """S14 for catalog tables: replace the rows."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
