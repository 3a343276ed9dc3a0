"""Monthly, trailing-twelve-month and year-to-date metrics.

All metrics are differences of running sums, so the self joins of a warehouse
formulation disappear.  With C(m) the sum of a series' months up to m, and R(m)
that of its months rounded to 3 decimals:

* prior-year value          R(m - 12) - R(m - 13); TTM and YTD at m - 12
* TTM                       C(m) - C(m - 12)
* YTD                       R(m) - R(last December)
* "new" amounts in the cohort's first year / the following calendar year
                            C(11 months after the cohort) - C(m - 12) or C(last December)

The sums are windows over the priced rows, of which a series has far fewer than months.
They are collected into one row per series, with arrays that have an entry a month
(bounded by the calendar); the cohorts are a window over these rows, and each month
then looks its sums up while the rows are made dense.  No window, sort or shuffle sees the dense rows,
and amounts are two longs (``functions.amounts``) until ``with_amounts``.

Everything is satisfied by a hash partitioning on (``account_id``, ``product``).
NULL keys follow join semantics: cohorts need account and product, per-row
metrics need all three series keys; otherwise they are NULL / 0.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import labels as L
from ..functions.amounts import Amount
from .densify import MONTHLY_TOTAL_TYPE, month_spans
from .pricing import SERIES_KEYS

HORIZON_COLUMNS = [
    "monthly_cohort", "monthly_trailing_total", "change_in_existing_monthly",
    "ttm_total", "ttm_cohort", "ttm_total_new", "ttm_total_existing", "ttm_trailing_total",
    "change_in_existing_ttm",
    "ytd_total", "ytd_cohort", "ytd_total_new", "ytd_total_existing", "ytd_trailing_total",
    "change_in_existing_ytd",
]

#: The amounts that ``add_horizons`` gives; ``DIFFERENCES`` follow from them.
AMOUNTS = [
    "monthly_total", "monthly_trailing_total", "ttm_total", "ttm_total_new", "ttm_trailing_total",
    "ytd_total", "ytd_total_new", "ytd_trailing_total",
]
DIFFERENCES = {
    "change_in_existing_monthly": ("monthly_total", "monthly_trailing_total"),
    "ttm_total_existing": ("ttm_total", "ttm_total_new"),
    "change_in_existing_ttm": ("ttm_total", "ttm_total_new", "ttm_trailing_total"),
    "ytd_total_existing": ("ytd_total", "ytd_total_new"),
    "change_in_existing_ytd": ("ytd_total", "ytd_total_new", "ytd_trailing_total"),
}

#: Zeros before the first month of the arrays: no metric looks back further.
_BEFORE = 24


def w_series():
    return Window.partitionBy(*SERIES_KEYS).orderBy("date")


def w_product():
    return Window.partitionBy("account_id", "product")


def _month_number(date) -> Column:
    return F.year(date) * 12 + F.month(date) - 1


def _month_date(number: Column) -> Column:
    return F.make_date(F.floor(number / 12).cast("int"), number % 12 + 1, F.lit(1))


def amount(name: str) -> Amount:
    """An amount of ``add_horizons``, or a difference of them."""
    first, *rest = DIFFERENCES.get(name, (name,))
    out = Amount.named(first)
    for c in rest:
        out = out - Amount.named(c)
    return out


def series_sums(
    totals: DataFrame, as_of: dt.date, tail_months: int = 24, calendar_start: dt.date | None = None
) -> DataFrame:
    """One row per series with a month in the calendar: its ``_first`` month (a number), the running sums of all of its
    months in arrays (``_sums_hi`` with ``_sums_lo``, and with ``_sums_lo3`` for the rounded ones), ``first_positive_month``
    and the other columns of ``totals``, which must be the same on all rows of a series."""
    spans = month_spans(totals, as_of, tail_months, calendar_start)
    # a month before the calendar opens a span but has no row of its own; a NULL key never matches its own totals
    own = F.when(~L.any_null(*SERIES_KEYS) & (F.col("date") == F.col("_lo")), F.coalesce("monthly_total", F.lit(0)))
    months = (_month_number("_hi") - _month_number("_lo") + 1).alias("_months")
    fitted = own.otherwise(F.lit(0)).cast(MONTHLY_TOTAL_TYPE)
    too_large = F.raise_error(F.lit(f"a monthly total does not fit {MONTHLY_TOTAL_TYPE}"))
    spans = spans.withColumn("_own", F.when(fitted.isNull(), too_large).otherwise(fitted))
    spans = spans.select("*", months, *Amount.of("_own").columns("own"))
    spans = spans.select("*", Amount.named("own").rounded().lo.alias("_lo3_own"))
    so_far = w_series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.select("*", *[F.sum(f"_{p}_own").over(so_far).alias(f"_{p}_sum") for p in ("hi", "lo", "lo3")])
    kept = [c for c in totals.columns if c not in (*SERIES_KEYS, "date", "monthly_total")]
    run = F.struct("_lo", *[F.array_repeat(f"_{p}_sum", F.col("_months")).alias(p) for p in ("hi", "lo", "lo3")])
    series = spans.groupBy(*SERIES_KEYS).agg(
        F.min(_month_number("_lo")).alias("_first"), F.sum("_months").cast("int").alias("_months"),
        F.sort_array(F.collect_list(run)).alias("_runs"),
        *[F.any_value(c).alias(c) for c in (*kept, "first_positive_month")],
    )
    before = F.array_repeat(F.lit(0).cast("bigint"), _BEFORE)
    return series.select(
        *SERIES_KEYS, *kept, "first_positive_month", "_first", "_months",
        *[F.concat(before, F.flatten(F.col(f"_runs.{p}"))).alias(f"_sums_{p}") for p in ("hi", "lo", "lo3")],
    )


def _sum_to(month: Column, rounded: bool = False) -> Amount:
    """The running sum of a series up to its ``month`` (0 is the first)."""
    at = month + _BEFORE
    return Amount(F.get("_sums_hi", at), F.get("_sums_lo3" if rounded else "_sums_lo", at))


def _since_december(month: Column) -> Column:
    """Month of the year, 1 to 12, of a series' ``month``: as many months lie since the last December."""
    return (F.col("_first") + month) % 12 + 1


def _first_month(condition) -> Column:
    """The number of the first month of a series for which ``condition`` holds."""
    found = F.filter(F.sequence(F.lit(0), F.col("_months") - 1), condition)
    return F.col("_first") + F.get(found, F.lit(0))


def add_horizons(
    totals: DataFrame, as_of: dt.date, tail_months: int = 24, calendar_start: dt.date | None = None
) -> DataFrame:
    """The dense series (``densify_months``) with the monthly, TTM and YTD metrics: cohorts, and ``AMOUNTS``
    as pairs of longs (``with_amounts`` makes decimals of them and adds ``DIFFERENCES``).

    Input: one row per series and month, as for ``densify_months``; other columns must be the same on all rows of a series.

    * monthly: cohort = first month with a positive unrounded priced total;
      trailing = the month a year earlier, rounded to 3 decimals.
    * TTM: sum of the last 12 months; cohort = first month with TTM > 0;
      trailing = TTM a year earlier (3 decimals); new = TTM under 12 months
      from the cohort, from 12 to 23 months the sum of this series' months
      both in the last 12 and in the cohort's first 12, else 0.
    * YTD: running sum of months rounded to 3 decimals within the calendar
      year; cohort, trailing as for TTM; new = YTD under 12 months from the
      cohort, from 12 months on and only in the year after the cohort's the
      sum of this series' months in the last 12, in the cohort's first 12
      and in that year, else 0.
    * existing = total - new; change = existing - trailing.
    """
    def ttm_at(i: Column) -> Amount:
        return _sum_to(i) - _sum_to(i - 12)

    def ytd_at(i: Column) -> Amount:
        return _sum_to(i, True) - _sum_to(i - _since_december(i), True)

    # the months of a series with a NULL key are all 0, so it has no cohort
    series = series_sums(totals, as_of, tail_months, calendar_start)
    series = series.select(
        "*",
        _first_month(lambda i: ttm_at(i).sign() > 0).alias("_t_first"),
        _first_month(lambda i: ytd_at(i).sign() > 0).alias("_y_first"),
    )
    series = series.select(
        "*", F.min("_t_first").over(w_product()).alias("_t_cohort"), F.min("_y_first").over(w_product()).alias("_y_cohort")
    ).drop("_t_first", "_y_first")

    dense = series.select("*", F.explode(F.sequence(F.lit(0), F.col("_months") - 1)).alias("_i"))
    i, m, of_year = F.col("_i"), F.col("_m"), F.col("month")
    dense = dense.withColumn("_m", F.col("_first") + i).withColumn("month", (m % 12 + 1).cast("smallint"))
    tc, yc = F.col("_t_cohort"), F.col("_y_cohort")
    # sums to the end of the cohorts' first years; where those are not wanted the place may lie outside
    t_year_end, y_year_end = (_sum_to(c + 11 - F.col("_first")) for c in (tc, yc))
    sums = {
        "monthly_total": _sum_to(i) - _sum_to(i - 1),
        "monthly_trailing_total": _sum_to(i - 12, True) - _sum_to(i - 13, True),
        "ttm_total": ttm_at(i),
        "t_prior": ttm_at(i - 12),
        "t_first_year": t_year_end - _sum_to(i - 12),
        "ytd_total": _sum_to(i, True) - _sum_to(i - of_year, True),
        "ytd_trailing_total": _sum_to(i - 12, True) - _sum_to(i - 12 - of_year, True),
        "y_first_year": y_year_end - _sum_to(i - of_year),
    }
    out = [c for c in series.columns if not c.startswith("_") and c != "first_positive_month"]
    dense = dense.select(
        *out, "first_positive_month", "_m", "_t_cohort", "_y_cohort", "month",
        *[c for name, a in sums.items() for c in a.columns(name)],
    )
    ttm, ytd = Amount.named("ttm_total"), Amount.named("ytd_total")
    later = (m - tc >= 12) & (m - tc < 24)
    next_year = (m - yc >= 12) & (F.floor(m / 12) == F.floor(yc / 12) + 1)
    new = {
        "ttm_total_new": ttm.if_else(m - tc < 12, Amount.named("t_first_year").only(later)),
        "ttm_trailing_total": Amount.named("t_prior").rounded(),
        "ytd_total_new": ytd.if_else(m - yc < 12, Amount.named("y_first_year").only(next_year)),
    }
    product_ok = ~L.any_null("account_id", "product")
    amounts = {**{name: Amount.named(name) for name in AMOUNTS if name not in new}, **new}
    return dense.select(
        *out, _month_date(m).alias("date"), "month", F.floor(m / 12).cast("smallint").alias("year"),
        F.when(product_ok, F.col("first_positive_month")).alias("monthly_cohort"),
        _month_date(tc).alias("ttm_cohort"), _month_date(yc).alias("ytd_cohort"),
        *[c for name in AMOUNTS for c in amounts[name].columns(name)],
    )


def with_amounts(df: DataFrame, *others: str) -> DataFrame:
    """The frame of ``add_horizons`` with its amounts, their differences and ``others`` as decimals."""
    plain = [c for c in df.columns if not c.startswith(("_hi_", "_lo_"))]
    decimals = {c: Amount.named(c).decimal() for c in (*AMOUNTS, *others)}
    # of the decimals: each is then made once a row, in a method of its own
    for name, (first, *rest) in DIFFERENCES.items():
        decimals[name] = decimals[first]
        for c in rest:
            decimals[name] = decimals[name] - decimals[c]
    return df.select(*plain, *[d.alias(c) for c, d in decimals.items()])
