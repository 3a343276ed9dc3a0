"""Calendar gaps in a dated table and ingestion of rate payloads.

``missing_dates`` finds the calendar days (or months) in a range with no row,
optionally per key.  It never builds keys x calendar: per key the distinct
dates present are ordered and each gap between neighbours, before the first
and after the last is expanded with ``sequence``.  The table is read once; work
is linear in input dates + missing output; a key's window holds at most the
calendar length (the distinct pre-aggregate absorbs hot keys).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _unit_expr(unit: str):
    if unit == "day":
        return F.to_date, "INTERVAL 1 DAY", lambda c, n: F.date_add(c, n)
    if unit == "month":
        return (lambda c: F.trunc(c, "MM")), "INTERVAL 1 MONTH", lambda c, n: F.add_months(c, n)
    raise ValueError(f"unit must be 'day' or 'month', got {unit!r}")


def missing_dates(
    existing: DataFrame,
    date_col: str,
    start: dt.date,
    end: dt.date,
    keys: list[str] | tuple[str, ...] = (),
    unit: str = "day",
    out_col: str = "missing_date",
    newest_first: bool = False,
) -> DataFrame:
    """Days (``unit='day'``) or month starts (``unit='month'``) in
    ``[start, end]`` that have no row in ``existing``, per distinct key.

    NULL dates are ignored (a null-aware ``NOT IN`` would return nothing at
    all).  Keys come from ``existing``; a key with no row inside the range
    gets the whole range; a NULL key is one group, as in ``groupBy``.  ``newest_first`` sorts the result by date
    descending (O1, presentation only: a global sort).
    """
    to_unit, step, shift = _unit_expr(unit)
    keys = list(keys)
    lo, hi = F.lit(start), F.lit(end)
    if unit == "month":
        lo, hi = F.trunc(lo, "MM"), F.trunc(hi, "MM")
    d = to_unit(F.col(date_col))
    # one pass: each key's distinct dates in the range; NULL stands for all others
    # and keeps a key without any
    points = existing.select(*keys, F.when((d >= lo) & (d <= hi), d).alias("_d"))
    if not keys:  # an empty table lacks every date
        points = points.unionAll(existing.sparkSession.range(1).select(F.lit(None).cast("date")))
    w = Window.partitionBy(*keys).orderBy(F.col("_d").asc_nulls_first())
    near = points.distinct().select(
        *keys, "_d", F.lag("_d").over(w).alias("_before"), F.lead("_d").over(w).alias("_after")
    )
    # the dates between a point and the one before, and after the last point
    first = F.coalesce(shift(F.col("_before"), 1), lo)
    gap = lambda a, b: F.when(a <= b, F.sequence(a, b, F.expr(step))).otherwise(F.array().cast("array<date>"))
    ahead = F.when(F.col("_d").isNotNull(), gap(first, shift(F.col("_d"), -1)))
    tail = F.when(F.col("_after").isNull(), gap(F.coalesce(shift(F.col("_d"), 1), lo), hi))
    none = F.array().cast("array<date>")
    out = near.select(*keys, F.explode(F.concat(F.coalesce(ahead, none), F.coalesce(tail, none))).alias(out_col))
    return out.orderBy(F.col(out_col).desc()) if newest_first else out


def gap_summary(missing: DataFrame, keys: list[str] | tuple[str, ...] = (),
                out_col: str = "missing_date") -> DataFrame:
    """Count and first / last missing date (per key)."""
    return missing.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_missing"),
        F.min(out_col).alias("first_missing"),
        F.max(out_col).alias("last_missing"),
    )


def explode_rate_payloads(payloads: DataFrame) -> DataFrame:
    """(date, rates map) -> (date, currency, quoted).  A payload without
    a map yields no rows."""
    return payloads.select("date", F.explode("rates").alias("currency", "quoted"))


def ingest_rates(payloads: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to append and rejects.

    The payload quotes units per base unit; the stored rate is its
    reciprocal.  Zero or NULL quotes go to rejects (the reciprocal is
    undefined) instead of storing infinity, and so do quotes without a date.
    One row per (date, currency): of several quotes the largest one (the
    smallest rate) is stored, the others go to rejects as ``duplicate_key``;
    equal quotes count once.  A (date, currency) already in ``existing`` is
    never appended again, so a re-run adds nothing.
    """
    rows = explode_rate_payloads(payloads)
    quoted = F.col("quoted")
    best = Window.partitionBy("date", "currency").orderBy(quoted.desc())
    known = F.col("date").isNotNull() & quoted.isNotNull() & (quoted != 0)
    # equal quotes of one key meet first, so a hot key holds its distinct quotes only
    good = rows.where(known).distinct().withColumn("_rank", F.row_number().over(best))
    reason = (
        F.when(F.col("date").isNull(), F.lit("null_date"))
        .when(quoted.isNull(), F.lit("null_rate"))
        .otherwise(F.lit("zero_rate"))
    )
    rejects = rows.where(~F.coalesce(known, F.lit(False))).select("date", "currency", "quoted", reason.alias("reason")).unionAll(
        good.where(F.col("_rank") > 1).select("date", "currency", "quoted", F.lit("duplicate_key"))
    )
    new = good.where(F.col("_rank") == 1).select(
        "date", "currency", F.try_divide(F.lit(1.0), quoted.cast("double")).alias("rate")
    )
    have = existing.select("date", "currency").where(F.col("date").isNotNull()).distinct()
    return new.join(have, ["date", "currency"], "left_anti"), rejects
