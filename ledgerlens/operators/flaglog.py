"""Feature-flag log per published form version, full or incremental.

The flag is a substring test on the published form text (NULL text -> 0).
A rebuild projects every version; an increment projects versions above the
log's high watermark (its max id).  The watermark is one scalar, pulled as a
literal so ``id > hw`` is pushed to the source scan (parquet row-group
statistics skip everything already loaded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Marker searched for in the published form text (fixed value of the original job).
DEFAULT_MARKER = "purchaseProtection"

LOG_COLUMNS = ["id", "form_id", "pp_enabled", "date_created"]


def flag_rows(versions: DataFrame, marker: str = DEFAULT_MARKER,
              case_sensitive: bool = True) -> DataFrame:
    """(id, form_id, pp_enabled 0/1, date_created) from (id, form_id, form, date_created)."""
    form = F.col("form")
    hit = form.contains(marker) if case_sensitive else F.lower(form).contains(marker.lower())
    return versions.select(
        "id", "form_id",
        F.coalesce(hit, F.lit(False)).cast("int").alias("pp_enabled"),
        "date_created",
    )


def high_watermark(log: DataFrame | None) -> int:
    """A10: max id of the log; a missing or empty log -> 0."""
    if log is None:
        return 0
    hw = log.agg(F.max("id")).first()[0]
    return int(hw) if hw is not None else 0


def flag_log_full(versions: DataFrame, marker: str = DEFAULT_MARKER) -> DataFrame:
    """Rebuild: every version.  No id chunking: Spark splits the scan itself."""
    return flag_rows(versions, marker)


def flag_log_increment(versions: DataFrame, log: DataFrame | None,
                       marker: str = DEFAULT_MARKER) -> tuple[str, DataFrame]:
    """('full', rows) when the log is missing/empty/max id 0, else ('append', rows above it)."""
    hw = high_watermark(log)
    if hw == 0:
        return "full", flag_log_full(versions, marker)
    return "append", flag_rows(versions.where(F.col("id") > F.lit(hw)), marker)


def delivered_in_time(deliveries: DataFrame, delay_ms: int) -> DataFrame:
    """X1 as a batch: the versions that a stream with a watermark of ``delay_ms`` keeps, each once.

    ``deliveries``: versions with ``drop``, the number (from 0) of the batch that brought them.  The watermark of a
    drop is the latest ``date_created`` of all drops before it, in whole milliseconds, less the delay; a delivery at or
    below it is late.  A version counts if one of its deliveries is in time.  Drops are few (one row each
    in the watermark's window); the versions are grouped by id."""
    latest = deliveries.groupBy("drop").agg(F.max(F.unix_millis("date_created")).alias("_latest"))
    before = Window.orderBy("drop").rowsBetween(Window.unboundedPreceding, -1)
    marks = latest.select(F.col("drop").alias("_drop"), (F.max("_latest").over(before) - delay_ms).alias("_mark"))
    met = deliveries.join(marks, F.col("drop") == F.col("_drop"))
    in_time = F.col("_mark").isNull() | (F.unix_micros("date_created") > F.col("_mark") * 1000)
    rows = [c for c in deliveries.columns if c not in ("id", "drop")]
    return met.where(in_time).groupBy("id").agg(F.min(F.struct("drop", *rows)).alias("_v")).select("id", *[F.col(f"_v.{c}") for c in rows])
