"""Size bands, attribution, lookups and the wide report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels as L
from ..functions.amounts import Amount
from .horizons import AMOUNTS, amount, w_product, with_amounts
from .joins import unique_rows
from .status import PRODUCT_AMOUNTS

# Output money type: 5 decimals, as wide as decimals get.
MONEY_TYPE = "decimal(38,5)"

# The columns of the two reports, in their order.

AUX_COLUMNS = [
    "account_id", "account_name", "account_manager_name", "product", "gateway_group",
    "monthly_cohort", "ttm_cohort", "ytd_cohort", "organization_id", "date", "month", "year",
    "monthly_total", "monthly_trailing_total", "change_in_existing_monthly",
    "ttm_total", "ttm_total_new", "ttm_total_existing", "ttm_trailing_total",
    "change_in_existing_ttm",
    "ytd_total", "ytd_total_new", "ytd_total_existing", "ytd_trailing_total",
    "change_in_existing_ytd",
]

AUX_MONEY = [c for c in AUX_COLUMNS[12:]]

REPORT_COLUMNS = [
    "account_id", "account_name", "account_manager_name", "product",
    "monthly_cohort", "ttm_cohort", "ytd_cohort", "organization_id", "gateway_group",
    "industry", "date", "month", "year",
    "monthly_total", "monthly_trailing_total", "change_in_existing_monthly",
    "monthly_total_product", "monthly_trailing_total_product",
    "ttm_total", "ttm_total_new", "ttm_total_existing", "ttm_trailing_total",
    "change_in_existing_ttm", "ttm_total_product", "ttm_trailing_total_product",
    "ytd_total", "ytd_total_new", "ytd_total_existing", "ytd_trailing_total",
    "change_in_existing_ytd", "ytd_total_product", "ytd_trailing_total_product",
    "monthly_status", "ttm_status", "ytd_status",
    "attribution_type", "attribution_source",
    "product_max_ttm_size", "processing_max_ttm_size", "customer_size_py",
]

REPORT_MONEY = AUX_MONEY + [
    "monthly_total_product", "monthly_trailing_total_product",
    "ttm_total_product", "ttm_trailing_total_product",
    "ytd_total_product", "ytd_trailing_total_product",
]


def cast_money(df: DataFrame, cols: list[str], money_type: str = MONEY_TYPE) -> DataFrame:
    return df.select(
        *[F.col(c).cast(money_type).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def add_size_band(df: DataFrame) -> DataFrame:
    """Band of the largest TTM total of (account, product).

    The maximum (``max_total``) is over the gateway-group rows, as in the original report.
    A NULL account or product matches no band row -> non-active.
    Input: the frame of ``add_horizons``, with statuses or without.
    """
    ok = ~L.any_null("account_id", "product")
    peak = F.max(amount("ttm_total").decimal()).over(w_product())
    df = df.select("*", F.when(ok, peak).alias("max_total"))
    return df.select("*", _peak_band(F.col("max_total").cast("double")).alias("processing_max_ttm_size"))


def _peak_band(peak: Column) -> Column:
    """The band of a product's largest TTM total.

    Compared as double: exact here, because the thresholds are integers
    below 1e7 and the totals have 5 decimals, so any total above a
    threshold is at least 1e-5 above it, far more than double rounding."""
    ok = ~L.any_null("account_id", "product")
    return F.when(ok, L.size_band(peak)).otherwise(F.lit(L.NON_ACTIVE_BAND))


def attribution_columns(attribution: DataFrame) -> DataFrame:
    """(account_id, utm_medium, utm_source) -> (account_id, type, source)."""
    return attribution.select("account_id", "utm_medium", "utm_source")


def attach_attribution(df: DataFrame, attribution: DataFrame) -> DataFrame:
    a = unique_rows(
        attribution_columns(attribution).select(
            "account_id",
            L.attribution_type("utm_medium").alias("attribution_type"),
            L.attribution_source("utm_source").alias("attribution_source"),
        ),
        ["account_id"], "attribution",
    )
    # an account without an attribution row still gets the defaults
    joined = df.join(a, "account_id", "left")
    return joined.select(
        *[c for c in joined.columns if c not in ("attribution_type", "attribution_source")],
        F.coalesce("attribution_type", F.lit(L.DEFAULT_ATTRIBUTION_TYPE)).alias("attribution_type"),
        F.coalesce("attribution_source", F.lit(L.DEFAULT_ATTRIBUTION_SOURCE)).alias("attribution_source"),
    )


def attach_industry(df: DataFrame, industries: DataFrame) -> DataFrame:
    """Industry by account."""
    return df.join(unique_rows(industries.select("account_id", "industry"), ["account_id"], "industry"), "account_id", "left")


def attach_product_lookups(df: DataFrame, max_ttm: DataFrame, size_py: DataFrame) -> DataFrame:
    """J17 on monthly rows: ``product_max_ttm_size`` and ``sizes_by_year``, the bands of
    all years, by (account, product).

    One row per (account, product) on either side, so the join key is the
    partitioning of all windows; ``size_of_year`` then picks each row's band
    without another join."""
    keys = ["account_id", "product"]
    mt = unique_rows(max_ttm.select(*keys, "product_max_ttm_size"), keys, "max_ttm")
    years = unique_rows(
        size_py.select(*keys, F.col("year").cast("smallint").alias("year"), "customer_size_py").distinct(),
        [*keys, "year"], "customer_size_py",
    )
    # bounded by the years of a calendar
    sizes = years.groupBy(*keys).agg(F.collect_list(F.struct("year", "customer_size_py")).alias("sizes_by_year"))
    return df.join(mt, keys, "left").join(sizes, keys, "left")


def size_of_year(sizes: str = "sizes_by_year", year: str = "year") -> Column:
    own = F.filter(sizes, lambda s: s["year"] == F.col(year))
    return F.coalesce(F.get(own, F.lit(0))["customer_size_py"], F.lit(L.NON_ACTIVE_BAND))


def add_size_of_year(dense: DataFrame) -> DataFrame:
    """``customer_size_py`` of each dense row in place of the bands of all years, which no sort has to carry then."""
    return dense.select(*[c for c in dense.columns if c != "sizes_by_year"], size_of_year().alias("customer_size_py"))


def retention_report(classified: DataFrame) -> DataFrame:
    """C11: the 40-column report, in the original column order.

    ``classified`` carries the account and product lookups, attached to the
    monthly rows before they were made dense, and ``add_size_of_year``.  The window of ``add_size_band`` parts
    the statuses from the decimals: together they make a method that the JVM does not compile."""
    return _report(add_size_band(classified))


def compact_report(classified: DataFrame) -> DataFrame:
    """The report with its amounts as pairs of longs (``functions.amounts``) and without their differences: what is written
    and copied of a report that is kept.

    ``classified`` is that of ``retention_report`` with ``ttm_peak``."""
    banded = classified.withColumn("processing_max_ttm_size", _peak_band(F.col("ttm_peak")))
    return banded.select(
        *[c for c in REPORT_COLUMNS if c not in REPORT_MONEY],
        *[c for name in (*AMOUNTS, *PRODUCT_AMOUNTS) for c in Amount.named(name).columns(name)],
    )


def compact_schema(report: T.StructType) -> T.StructType:
    """The schema of ``compact_report`` for that of the report."""
    plain = [f for f in report.fields if f.name not in REPORT_MONEY]
    return T.StructType(plain + [T.StructField(f"_{p}_{name}", T.LongType()) for name in (*AMOUNTS, *PRODUCT_AMOUNTS) for p in ("hi", "lo")])


def whole_report(compact: DataFrame) -> DataFrame:
    """The 40-column report of ``compact_report``."""
    return _report(compact)


def _report(df: DataFrame) -> DataFrame:
    return cast_money(with_amounts(df, *PRODUCT_AMOUNTS).select(*REPORT_COLUMNS), REPORT_MONEY)
