"""C4: priced monthly totals per (account, product, gateway group, month).

Two aggregates.  The raw rows are summed first, by (account, form, gateway,
currency, day): all rows of such a group have one product, one gateway group and
one day rate.  Only these sums meet form -> product, gateway -> group and the day
rate, and are multiplied; the second aggregate brings them to the monthly grain.
So raw rows cross one exchange, behind a partial aggregate, however large the dimensions
are.  The take rate depends on the keys of the monthly grain only, so it is joined to
the monthly sums and multiplied there.  Joins are left to Spark's size statistics and
AQE; dimension keys are checked to be unique inside the plan.

Products are exact (``functions.money``): day rates of any numeric type, doubles
included, count with up to 24 decimals.

Account attributes (name, organization, manager) are *not* group keys: they
are attached to the monthly rows by ``attach_account_attributes``, one manager
per account, so several managers can never multiply amounts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels as L
from ..functions import money as M
from .joins import unique_rows

SERIES_KEYS = ["account_id", "product", "gateway_group"]
KEPT_STATUS = 6
TOTAL_TYPE = M.PRODUCT_TYPE


def _dec_lit(value) -> F.Column:
    """Decimal literal with the exact digits given (no float round trip)."""
    return F.lit(Decimal(str(value)))


def gateway_groups(gateways: DataFrame) -> DataFrame:
    """(gateway_id, gateway_group) from a gateway dimension (id, type)."""
    return gateways.select(
        F.col("id").alias("gateway_id"), L.gateway_group("type").alias("gateway_group")
    )


def priced_monthly_totals(
    transactions: DataFrame,
    forms: DataFrame,
    gateways: DataFrame,
    exchange_rates: DataFrame,
    take_rates: DataFrame,
    *,
    fallback_wepay=L.DEFAULT_FALLBACK_WEPAY,
    fallback_other=L.DEFAULT_FALLBACK_OTHER,
    fallback_type: str | None = None,
    kept_status: int = KEPT_STATUS,
) -> DataFrame:
    """Signed, take-rate and currency converted sums by series and month.

    ``transactions``: account_id, form_id, gateway_id, currency, date_created,
    transaction_type (1 add, 2 subtract, other 0), amount, status.
    ``forms``: id, product.  ``gateways``: id, type.
    ``exchange_rates``: date, currency, rate; ``take_rates``: gateway_group, date
    (month start), product, rate.  Rates may have any numeric type; they are taken as
    decimals, so sums do not depend on the order of rows.  An amount that is no
    decimal counts with twelve decimals.  Totals may have 24 whole digits; a
    larger one stops the job.

    A missing day rate makes that transaction NULL (skipped by SUM); a month
    whose transactions all lack a rate has a NULL total.  A missing take rate
    falls back to ``fallback_wepay`` for WePay and ``fallback_other`` for any
    other or NULL group.  Pass ``fallback_type`` (e.g. ``decimal(20,10)``) to
    fix the literal type.  A dimension key that occurs twice stops the job.
    """
    kind = transactions.schema["amount"].dataType
    amount = F.col("amount") if isinstance(kind, T.DecimalType) else F.col("amount").cast(M.TOTAL_FACTOR)
    added = F.when(F.col("transaction_type") == 1, amount).when(F.col("transaction_type") == 2, -amount)
    # a row of another type counts 0, with a day rate or without
    other = F.coalesce(~F.col("transaction_type").isin(1, 2), F.lit(True))
    days = (
        transactions.where(F.col("status") == kept_status)
        .select(
            "account_id", "form_id", "gateway_id", "currency", F.to_date("date_created").alias("_day"),
            added.alias("_added"), F.when(other, F.lit(0)).alias("_zero"),
        )
        .groupBy("account_id", "form_id", "gateway_id", "currency", "_day")
        .agg(F.sum("_added").alias("_amount"), F.max("_zero").alias("_zero"))
    )
    form_dim = unique_rows(forms.select(F.col("id").alias("form_id"), "product"), ["form_id"], "form")
    gw_dim = unique_rows(gateway_groups(gateways), ["gateway_id"], "gateway")
    er = unique_rows(
        exchange_rates.select(
            F.col("date").alias("_day"), "currency",
            M.rate_factor(F.col("rate"), exchange_rates.schema["rate"].dataType).alias("_er_rate"),
        ),
        ["currency", "_day"], "exchange rate",
    )
    tr = unique_rows(
        take_rates.select(
            "gateway_group", "date", "product",
            M.rate_factor(F.col("rate"), take_rates.schema["rate"].dataType).alias("_tr_rate"),
        ),
        ["gateway_group", "date", "product"], "take rate",
    )

    fb_w, fb_o = _dec_lit(fallback_wepay), _dec_lit(fallback_other)
    if fallback_type:
        fb_w, fb_o = fb_w.cast(fallback_type), fb_o.cast(fallback_type)

    joined = (
        days.join(form_dim, "form_id", "left")
        .join(gw_dim, "gateway_id", "left")
        .join(er, ["currency", "_day"], "left")
        .withColumn("date", F.trunc("_day", "MM"))
    )
    priced = M.with_product(joined, "_amount", "_er_rate", "_converted")
    counted = F.coalesce(F.col("_converted"), F.col("_zero").cast(priced.schema["_converted"].dataType))
    monthly = priced.groupBy(*SERIES_KEYS, "date").agg(F.sum(counted).alias("_sum"))
    take = F.coalesce(
        F.col("_tr_rate").cast(M.RATE_FACTOR),
        F.when(F.col("gateway_group") == L.WEPAY_GROUP, fb_w.cast(M.RATE_FACTOR)).otherwise(fb_o.cast(M.RATE_FACTOR)),
    )
    met = monthly.join(tr, ["gateway_group", "date", "product"], "left").withColumn("_take", take)
    return M.with_product(met, "_sum", "_take", "monthly_total").select(
        *SERIES_KEYS, "date", F.col("monthly_total").cast(TOTAL_TYPE).alias("monthly_total")
    )


def account_attributes(
    accounts: DataFrame,
    manager_links: DataFrame,
    managers: DataFrame,
) -> DataFrame:
    """(account_id, account_name, organization_id, account_manager_name).

    One manager per account: the smallest manager id.  ``first || ' ' || last``
    is NULL when either name part is NULL.
    """
    mgr = manager_links.join(
        managers.select(
            F.col("id").alias("account_manager_id"),
            F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("_mname"),
        ),
        "account_manager_id",
        "left",
    )
    one = mgr.groupBy("account_id").agg(
        F.min(F.struct("account_manager_id", "_mname")).alias("_m")
    ).select("account_id", F.col("_m._mname").alias("account_manager_name"))
    acc = accounts.select(
        F.col("id").alias("account_id"),
        F.col("name").alias("account_name"),
        "organization_id",
    )
    return unique_rows(acc, ["account_id"], "account").join(one, "account_id", "left")


def attach_account_attributes(df: DataFrame, attrs: DataFrame) -> DataFrame:
    return df.join(attrs, "account_id", "left")
