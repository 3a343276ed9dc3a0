"""Views of the driver's test tables shaped like the report's inputs.

The mapping is FIXTURES.md section 2.  Every view is a lazy DataFrame over the
parquet tables, so work grows with the data; generated calendars are bounded
by their date range, and fixed lists (currencies, gateway groups) are short
configuration, exploded per row instead of cross joined.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import labels as L

AS_OF = dt.date(2001, 12, 1)
CALENDAR_START = dt.date(1995, 1, 1)
# Test fallbacks: the report's 16-digit defaults do not fit decimal(20,10).
TEST_FALLBACK_WEPAY = Decimal("0.005373")
TEST_FALLBACK_OTHER = Decimal("0.001075")
TEST_FALLBACK_TYPE = "decimal(20,10)"
# Fixture configuration.
CURRENCIES = ["1", "2", "3", "4", "5"]
GATEWAY_GROUPS = ["WePay", "Stripe", "Adyen", "Other"]
SEGMENT_TO_GATEWAY_TYPE = {"AUTOMOBILE": "wepay", "BUILDING": "stripe", "FURNITURE": "adyen"}
ORGANIZATION_LABELS = {1: "org_one", 2: "org_two", 3: "org_three"}
ATTRIBUTION_SOURCES = ["Facebook", "fb", "Instagram", "google", "Bing", None]  # by s_suppkey % 7
ATTRIBUTION_MEDIUMS = ["paid_social", "paid_social", "paid_social", "cpc", None, "email"]
INDUSTRIES = ["Education", "Nonprofit", "Religious"]  # by s_suppkey % 4; 3 -> no row
BAND_NAMES = [b for _, b in L.SIZE_BANDS] + [L.NON_ACTIVE_BAND]


class Tables:
    """Lazy access to ``{sf_dir}/{name}.parquet``.

    The schema is read once per session and path; the files are listed anew by every
    instance, so files that were added since are seen.
    """

    _schemas: dict[tuple[str, str], StructType] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.reads: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self.reads:
            path = f"{self.sf_dir}/{name}.parquet"
            key = (self.spark.sparkContext.applicationId, path)
            if key not in Tables._schemas:
                Tables._schemas[key] = self.spark.read.parquet(path).schema
            self.reads[name] = self.spark.read.schema(Tables._schemas[key]).parquet(path)
        return self.reads[name]


def _pick(values: list, index) -> F.Column:
    """values[index] as a CASE on an integer column (NULL entries stay NULL)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def _coded(column: str, codes: dict) -> F.Column:
    expr = F.when(F.lit(False), F.lit(None).cast("int"))
    for letter, code in codes.items():
        expr = expr.when(F.col(column) == letter, F.lit(code))
    return expr


def dim_dates(t: Tables, start: dt.date = CALENDAR_START, end: dt.date = AS_OF) -> DataFrame:
    """Calendar days [start, end] (full_date, month_day_number), distributed."""
    n = (end - start).days + 1
    return t.spark.range(n).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")
    ).withColumn("month_day_number", F.dayofmonth("full_date"))


#: Order status letter -> status code of a transaction.
ORDER_STATUS = {"F": 6, "O": 1, "P": 2}


def dim_transaction(t: Tables, status: int | None = None, orders: F.Column | None = None) -> DataFrame:
    """Transactions; ``status`` keeps those of one status, ``orders`` those of some orders, by
    filters on raw columns, which reach the scan."""
    li = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    if orders is not None:
        o = o.where(orders)
    if status is not None:
        o = o.where(F.col("o_orderstatus").isin([k for k, v in ORDER_STATUS.items() if v == status]))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_suppkey").alias("account_id"),
        F.col("l_partkey").alias("form_id"),
        F.col("o_custkey").alias("gateway_id"),
        F.substring("o_orderpriority", 1, 1).alias("currency"),
        F.col("l_shipdate").alias("date_created"),
        F.when(F.col("l_returnflag") == "R", F.lit(2)).otherwise(F.lit(1)).alias("transaction_type"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        _coded("o_orderstatus", ORDER_STATUS).alias("status"),
    )


def _supplier_geo(t: Tables) -> DataFrame:
    return t("supplier").select("s_suppkey", "s_name", "s_nationkey").join(
        t("nation").select("n_nationkey", "n_name", "n_regionkey"),
        F.col("s_nationkey") == F.col("n_nationkey"),
    )


def dim_account(t: Tables) -> DataFrame:
    return _supplier_geo(t).select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("n_regionkey").alias("organization_id"),
    )


def dim_form(t: Tables) -> DataFrame:
    return t("part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("product"))


def dim_gateway(t: Tables) -> DataFrame:
    seg = F.col("c_mktsegment")
    typ = seg
    for s, g in reversed(list(SEGMENT_TO_GATEWAY_TYPE.items())):
        typ = F.when(seg == s, F.lit(g)).otherwise(typ)
    return t("customer").select(F.col("c_custkey").alias("id"), typ.alias("type"))


def dim_account_managers_account(t: Tables) -> DataFrame:
    return t("supplier").select(
        F.col("s_suppkey").alias("account_id"), F.col("s_suppkey").alias("account_manager_id")
    )


def dim_account_managers(t: Tables) -> DataFrame:
    geo = _supplier_geo(t).join(
        t("region").select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return geo.select(
        F.col("s_suppkey").alias("id"),
        F.col("n_name").alias("first_name"),
        F.col("r_name").alias("last_name"),
    )


def currency_rate(currency="currency") -> F.Column:
    """Fixture rate of a currency code '1'..'5': 1 + digit/10 as decimal(4,1)."""
    c = F.col(currency) if isinstance(currency, str) else currency
    return (F.lit(1) + c.cast("int") * F.lit(Decimal("0.1"))).cast("decimal(4,1)")


def calendar_currencies(t: Tables) -> DataFrame:
    """(date, currency) for every calendar day and fixture currency."""
    days = dim_dates(t).select(F.col("full_date").alias("date"))
    return days.withColumn("currency", F.explode(F.array(*[F.lit(c) for c in CURRENCIES])))


def exchange_rates(t: Tables) -> DataFrame:
    """One rate per (day, currency); currency 5 has no rate on the last day
    of each month."""
    rows = calendar_currencies(t)
    rate = currency_rate()
    return rows.where(
        ~((F.col("currency") == "5") & (F.col("date") == F.last_day("date")))
    ).select("date", "currency", rate.alias("rate"))


def exchange_rates_double(t: Tables) -> DataFrame:
    """The days and currencies of ``exchange_rates`` with doubles of all their digits: the reciprocal of a
    quote that follows the day and the currency, as the rate job stores it."""
    quote = (F.lit(16345) + 10 * F.date_diff("date", F.lit(CALENDAR_START)) + F.col("currency").cast("int")) / F.lit(1000.0)
    return exchange_rates(t).select("date", "currency", (F.lit(1.0) / quote).alias("rate"))


def take_rates(t: Tables) -> DataFrame:
    """0.01 per (gateway group, month, product); group Other has no row in even months."""
    products = t("part").select(F.col("p_type").alias("product")).distinct()
    months = F.sequence(
        F.lit(CALENDAR_START), F.lit(AS_OF), F.expr("INTERVAL 1 MONTH")
    )
    rows = (
        products.withColumn("date", F.explode(months))
        .withColumn("gateway_group", F.explode(F.array(*[F.lit(g) for g in GATEWAY_GROUPS])))
    )
    return rows.where(
        ~((F.col("gateway_group") == "Other") & (F.month("date") % 2 == 0))
    ).select("gateway_group", "date", "product", F.lit(Decimal("0.01")).cast("decimal(20,10)").alias("rate"))


def account_attribution_pivot(t: Tables) -> DataFrame:
    k = F.col("s_suppkey") % 7
    return t("supplier").where(k != 6).select(
        F.col("s_suppkey").alias("account_id"),
        _pick(ATTRIBUTION_MEDIUMS, k).alias("utm_medium"),
        _pick(ATTRIBUTION_SOURCES, k).alias("utm_source"),
    )


def industries_master(t: Tables) -> DataFrame:
    k = F.col("s_suppkey") % 4
    return t("supplier").where(k != 3).select(
        F.col("s_suppkey").alias("account_id"), _pick(INDUSTRIES, k).alias("industry")
    )


def _supplier_product(t: Tables) -> DataFrame:
    """Each supplier with the product of the part sharing its key."""
    return t("supplier").select("s_suppkey").join(
        t("part").select("p_partkey", "p_type"), F.col("s_suppkey") == F.col("p_partkey")
    )


def max_ttm(t: Tables) -> DataFrame:
    return _supplier_product(t).select(
        F.col("s_suppkey").alias("account_id"),
        F.col("p_type").alias("product"),
        _pick(BAND_NAMES, F.col("s_suppkey") % 8).alias("product_max_ttm_size"),
    )


def processing_volume_retention(t: Tables) -> DataFrame:
    years = F.sequence(F.lit(CALENDAR_START.year), F.lit(AS_OF.year))
    rows = _supplier_product(t).withColumn("year", F.explode(years))
    return rows.select(
        F.col("s_suppkey").alias("account_id"),
        F.col("p_type").alias("product"),
        F.col("year").cast("int").alias("year"),
        _pick(BAND_NAMES, (F.col("s_suppkey") + F.col("year")) % 8).alias("customer_size_py"),
    )
