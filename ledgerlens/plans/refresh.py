"""Job flows that read and write tables (the entry points of the batch jobs).

Each returns a small dict describing what it did (counts come from Spark
aggregates, nothing is collected row by row).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import flaglog as FL
from ..operators import landing as LD
from ..operators import rates as RT
from ..session import written
from ..sources import commits, io


def read_rates(spark: SparkSession, target: str) -> DataFrame:
    """The rate table as it is published at ``target``; empty if nothing was."""
    return commits.read(spark, target, io.RATES_SCHEMA)


def refresh_rates(
    spark: SparkSession,
    payloads: DataFrame,
    target: str,
    rejects_target: str | None = None,
    tries: int = 5,
) -> dict:
    """C2 + S13/S15: append new (date, currency) rows to the rate table, never twice; an
    absent table is an empty one.  Rejected quotes are appended to
    ``rejects_target`` when given.

    The rows are checked against the published table and published as one list
    (``sources.commits``).  A run that stops before leaves nothing that is read; when another run
    publishes first, the keys are checked again against what it added, up to ``tries`` times."""
    for left in range(tries, 0, -1):
        base = commits.current(spark, target)
        good, rejects = RT.ingest_rates(payloads, commits.read(spark, target, io.RATES_SCHEMA, base))
        good = written(good.select("date", "currency", "rate"), "refresh")
        n_good = good.count()
        if n_good:
            try:
                commits.append(good, target, base)
            except commits.Refused:
                if left == 1:
                    raise
                continue
        break
    n_rej = 0
    if rejects_target is not None:
        rejects = written(rejects, "refresh")
        n_rej = rejects.count()
        if n_rej:
            io.append(rejects, rejects_target)
    return {"appended": n_good, "rejected": n_rej}


def rate_gaps(spark: SparkSession, target: str, start: dt.date, end: dt.date) -> DataFrame:
    """C1 on the rate table: days in [start, end] with no rate at all."""
    return RT.missing_dates(read_rates(spark, target), "date", start, end)


def load_landing(
    spark: SparkSession,
    landing_path: str,
    target: str,
    rejects_target: str | None = None,
    fmt: str = "csv",
    glob: str | None = "*.csv",
) -> dict:
    """C3 + S5-S7 + S14: read every landed file, clean, overwrite the table."""
    raw = io.read_landing(spark, landing_path, fmt=fmt, glob=glob)
    good, rejects = LD.clean_landing(raw, keep=["source_file"])
    io.overwrite(good, target)
    out = {"written": spark.read.parquet(target).count()}
    if rejects_target is not None:
        io.overwrite(rejects, rejects_target)
        out["rejected"] = spark.read.parquet(rejects_target).count()
    return out


def load_landing_tables(spark: SparkSession, tables: dict[str, str], rejects: str | None = None) -> dict[str, dict]:
    """C3 for several tables, target -> landing path; rejects go to ``rejects`` / the target's last name.  Each
    table is loaded on its own: one that fails leaves those before it loaded."""
    return {
        target: load_landing(spark, path, target, rejects and f"{rejects}/{target.rstrip('/').rsplit('/', 1)[-1]}")
        for target, path in tables.items()
    }


def refresh_flag_log(
    spark: SparkSession,
    versions: DataFrame,
    target: str,
    marker: str = FL.DEFAULT_MARKER,
) -> dict:
    """C12 + S10/S13/S14: rebuild the log when it is missing or empty (max
    id 0), else append the versions above its max id."""
    log = spark.read.parquet(target) if io.table_exists(spark, target) else None
    mode, rows = FL.flag_log_increment(versions, log, marker)
    rows = rows.select(
        F.col("id").cast("long").alias("id"),
        F.col("form_id").cast("long").alias("form_id"),
        F.col("pp_enabled").cast("int").alias("pp_enabled"),
        F.col("date_created").cast("timestamp").alias("date_created"),
    )
    if mode == "full":
        io.overwrite(rows, target)
    else:
        io.append(rows, target)
    return {"mode": mode}
