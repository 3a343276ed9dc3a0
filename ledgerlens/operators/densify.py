"""Dense monthly series without a calendar join.

Each priced row knows the next month its series has data (``lead``).  It emits
its own month plus the empty months up to that next row; the last row of a
series emits ``tail_months`` more.  Everything is capped at ``as_of``.  The
output is linear in the number of spine rows: no cross join with a calendar,
no join back to the totals.

The caller partitions the input by (``account_id``, ``product``) once (see
``plans.retention``); the ``lead`` window and every later window run inside
that partitioning.  Rows per account and product after the monthly aggregate
are bounded by gateway groups x calendar months, so an account with a third
of all transactions, or with thousands of products, spreads over the tasks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import labels as L
from .pricing import SERIES_KEYS

# Fixed by the original base: numeric(20,5).
MONTHLY_TOTAL_TYPE = "decimal(20,5)"


def densify_months(
    totals: DataFrame,
    as_of: dt.date,
    tail_months: int = 24,
    calendar_start: dt.date | None = None,
    keys: list[str] = SERIES_KEYS,
) -> DataFrame:
    """One row per series and month from the first month with data to
    ``min(last month with data + tail_months, as_of)``.

    Input: ``keys`` + ``date`` (month start) + ``monthly_total`` (one row per
    series and month) and any per-row columns to carry.  Output adds ``month``,
    ``year`` (smallint), ``monthly_total`` rounded to 5 decimals with 0 on
    filled months, and ``first_positive_month``: the first month of the
    (account, product) whose unrounded priced total is > 0, over all priced
    months including those after ``as_of`` (the monthly cohort).  A series
    with a NULL key gets 0 on every month: a NULL key never matches its own
    totals.
    """
    spread = month_spans(totals, as_of, tail_months, calendar_start, keys).withColumn(
        "_month", F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH")))
    )
    own = F.col("_month") == F.col("date")
    value = (
        F.when(L.any_null(*keys), F.lit(0))
        .when(own, F.coalesce(F.col("monthly_total"), F.lit(0)))
        .otherwise(F.lit(0))
        .cast(MONTHLY_TOTAL_TYPE)
    )
    return (
        spread.withColumn("monthly_total", value)
        .withColumn("date", F.col("_month"))
        .withColumn("month", F.month("date").cast("smallint"))
        .withColumn("year", F.year("date").cast("smallint"))
        .drop("_hi", "_lo", "_month")
    )


def month_spans(
    totals: DataFrame,
    as_of: dt.date,
    tail_months: int = 24,
    calendar_start: dt.date | None = None,
    keys: list[str] = SERIES_KEYS,
) -> DataFrame:
    """The priced rows that open months of the dense series, with the first (``_lo``) and last (``_hi``) of them,
    and ``first_positive_month``.  The spans of a series follow one another without a gap."""
    w = Window.partitionBy(*keys).orderBy("date")
    as_of_lit = F.lit(as_of)
    upper = F.least(
        F.coalesce(F.add_months(F.lead("date").over(w), -1), F.add_months("date", tail_months)),
        as_of_lit,
    )
    lower = F.col("date") if calendar_start is None else F.greatest(F.col("date"), F.lit(calendar_start))
    first_positive = F.min(F.when(F.col("monthly_total") > 0, F.col("date"))).over(
        Window.partitionBy("account_id", "product")
    )
    # A month without a date (transaction without a timestamp) matches no
    # calendar month; drop it before it can open a spine.
    totals = totals.where(F.col("date").isNotNull())
    # the lead window comes first; the (account, product) window then reuses its sort
    return (
        totals.withColumn("_hi", upper)
        .withColumn("first_positive_month", first_positive)
        .withColumn("_lo", lower)
        .where(F.col("_lo") <= F.col("_hi"))
    )


def series_extent(totals: DataFrame, keys: list[str] = SERIES_KEYS) -> DataFrame:
    """A3: first and last month with data per series."""
    return totals.groupBy(*keys).agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )
