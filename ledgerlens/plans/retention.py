"""The retention report as one lineage.

Physical shape (see README, "Plan"):

1. scan transactions (status filter pushed to the scan), joins to form /
   gateway / day rate, partial hash aggregate -> exchange on the monthly
   grain -> final aggregate, take rate on the monthly sums
2. account and product lookups joined to the monthly rows, the smallest frame
   that has their keys
3. dealt by (account_id, product): the last exchange of the main data; the lookups
   by that key are joined behind it
4. inside that partitioning: running sums of the priced rows, one row per series with its sums by
   month, cohorts of the products; then the months are spread, and two windows give the status

Rows per account and product after step 1 are bounded by gateway groups x
calendar months, so neither a hot account nor one with thousands of products
makes an oversized task.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import densify as D
from ..operators import horizons as H
from ..operators import pricing as P
from ..operators import report as R
from ..operators import status as S
from ..session import dealt
from ..sources import fixtures as FX


#: Tasks of the report's windows per shuffle partition: its rows are the widest, and each sort holds a task's share.
REPORT_TIMES = 4


@dataclass
class RetentionInputs:
    transactions: DataFrame
    forms: DataFrame
    gateways: DataFrame
    exchange_rates: DataFrame
    take_rates: DataFrame
    accounts: DataFrame
    manager_links: DataFrame
    managers: DataFrame
    attribution: DataFrame
    industries: DataFrame
    max_ttm: DataFrame
    size_py: DataFrame


@dataclass
class RetentionParams:
    as_of: dt.date
    tail_months: int = 24
    calendar_start: dt.date | None = None
    fallback_wepay: Decimal = L.DEFAULT_FALLBACK_WEPAY
    fallback_other: Decimal = L.DEFAULT_FALLBACK_OTHER
    fallback_type: str | None = None
    organization_labels: dict[int, str] = field(default_factory=dict)


def fixture_inputs(spark: SparkSession, sf_dir: str) -> RetentionInputs:
    t = FX.Tables(spark, sf_dir)
    return RetentionInputs(
        transactions=FX.dim_transaction(t, status=P.KEPT_STATUS),
        forms=FX.dim_form(t),
        gateways=FX.dim_gateway(t),
        exchange_rates=FX.exchange_rates(t),
        take_rates=FX.take_rates(t),
        accounts=FX.dim_account(t),
        manager_links=FX.dim_account_managers_account(t),
        managers=FX.dim_account_managers(t),
        attribution=FX.account_attribution_pivot(t),
        industries=FX.industries_master(t),
        max_ttm=FX.max_ttm(t),
        size_py=FX.processing_volume_retention(t),
    )


def fixture_params() -> RetentionParams:
    return RetentionParams(
        as_of=FX.AS_OF,
        calendar_start=FX.CALENDAR_START,
        fallback_wepay=FX.TEST_FALLBACK_WEPAY,
        fallback_other=FX.TEST_FALLBACK_OTHER,
        fallback_type=FX.TEST_FALLBACK_TYPE,
        organization_labels=FX.ORGANIZATION_LABELS,
    )


def monthly_totals(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """C4 without account attributes: (account_id, product, gateway_group, date, monthly_total)."""
    return P.priced_monthly_totals(
        inp.transactions, inp.forms, inp.gateways, inp.exchange_rates, inp.take_rates,
        fallback_wepay=prm.fallback_wepay, fallback_other=prm.fallback_other,
        fallback_type=prm.fallback_type,
    )


def account_attrs(inp: RetentionInputs) -> DataFrame:
    return P.account_attributes(inp.accounts, inp.manager_links, inp.managers)


def priced_with_accounts(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """Q1: priced monthly totals with account name, manager and organization id."""
    return P.attach_account_attributes(monthly_totals(inp, prm), account_attrs(inp))


def _labelled(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """Monthly totals with account name, manager and organization label."""
    df = priced_with_accounts(inp, prm)
    label = L.organization_label("organization_id", prm.organization_labels)
    return df.select(*[label.alias(c) if c == "organization_id" else F.col(c) for c in df.columns])


def _dense(totals: DataFrame, prm: RetentionParams) -> DataFrame:
    """C5 on the (account, product) partitioning."""
    # rows grow ~10x after this exchange (the spine)
    return D.densify_months(dealt(totals, "account_id", "product"), prm.as_of, prm.tail_months, prm.calendar_start)


def dense_base(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """Q3: the dense monthly series with account attributes."""
    return _dense(_labelled(inp, prm), prm)


def _horizons(dealt_totals: DataFrame, prm: RetentionParams) -> DataFrame:
    """C5 to C7 on the (account, product) partitioning, amounts as pairs of longs."""
    return H.add_horizons(dealt_totals, prm.as_of, prm.tail_months, prm.calendar_start)


def metric_frame(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """All horizon metrics on the dense series, without account attributes (uncast)."""
    return H.with_amounts(_horizons(dealt(monthly_totals(inp, prm), "account_id", "product"), prm))


def aux_frame(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """All horizon metrics on the dense base, with account attributes (uncast)."""
    return H.with_amounts(_horizons(dealt(_labelled(inp, prm), "account_id", "product"), prm))


def aux_report(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """Q12: the 25-column monthly / TTM / YTD frame."""
    return R.cast_money(aux_frame(inp, prm).select(*R.AUX_COLUMNS), R.AUX_MONEY)


def classified_frame(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """Horizons + product totals + later activity + statuses, without account attributes, amounts as pairs of longs."""
    return S.classify_status(_horizons(dealt(monthly_totals(inp, prm), "account_id", "product"), prm))


def _account_lookups(df: DataFrame, inp: RetentionInputs) -> DataFrame:
    return R.attach_industry(R.attach_attribution(df, inp.attribution), inp.industries)


def _report_months(inp: RetentionInputs, prm: RetentionParams, keys: DataFrame | None = None, buckets: int = 1) -> DataFrame:
    """The dense months of the report with its lookups, of all series or of those of ``keys`` (account_id, product), its
    tasks fitted to ``buckets`` of them (``session.dealt``)."""
    monthly = _labelled(inp, prm)
    if keys is not None:
        own = monthly.account_id.eqNullSafe(keys.account_id) & monthly["product"].eqNullSafe(keys["product"])
        monthly = monthly.join(keys, own, "left_semi")
    # dealt before the joins by (account, product): behind them Spark would drop the exchange
    monthly = dealt(_account_lookups(monthly, inp), "account_id", "product", times=REPORT_TIMES, buckets=buckets)
    return R.add_size_of_year(_horizons(R.attach_product_lookups(monthly, inp.max_ttm, inp.size_py), prm))


def compact_report(inp: RetentionInputs, prm: RetentionParams, keys: DataFrame | None = None, buckets: int = 1) -> DataFrame:
    """Q22 with amounts as pairs of longs; ``keys`` and ``buckets`` as for ``_report_months``."""
    return R.compact_report(S.classify_status(_report_months(inp, prm, keys, buckets), peak=True))


def retention_report(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """Q22: the 40-column report."""
    return R.retention_report(S.classify_status(_report_months(inp, prm)))


def _spine_keys(inp: RetentionInputs, prm: RetentionParams, *keys: str) -> DataFrame:
    """Distinct keys of the series that have a month in the report's range."""
    first = F.col("date") if prm.calendar_start is None else F.greatest("date", F.lit(prm.calendar_start))
    last = F.least(F.add_months("date", prm.tail_months), F.lit(prm.as_of))
    return monthly_totals(inp, prm).where(first <= last).select(*keys).distinct()


def attribution_by_account(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """J16 by account: attribution and industry of the accounts in the report."""
    return _account_lookups(_spine_keys(inp, prm, "account_id"), inp)


def size_py_by_year(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """J17 by (account, product, year): the size band of every year in the report."""
    spans = monthly_totals(inp, prm).groupBy(*P.SERIES_KEYS).agg(F.min("date").alias("low"), F.max("date").alias("high"))
    low = F.col("low") if prm.calendar_start is None else F.greatest("low", F.lit(prm.calendar_start))
    high = F.least(F.add_months("high", prm.tail_months), F.lit(prm.as_of))
    years = spans.where(low <= high).select(
        "account_id", "product",
        F.explode(F.sequence(F.year(low).cast("smallint"), F.year(high).cast("smallint"))).alias("year"),
    ).distinct()
    rows = R.attach_product_lookups(years, inp.max_ttm, inp.size_py)
    return rows.select("account_id", "product", "year", R.size_of_year().alias("customer_size_py"))


def status_counts(inp: RetentionInputs, prm: RetentionParams) -> DataFrame:
    """Q18: rows per month, horizon and status (partial aggregate, tiny output)."""
    statuses = [f"{h}_status" for h in S.HORIZONS]
    # by all three first: a row meets the hash table once, and few groups are taken apart
    groups = classified_frame(inp, prm).groupBy("date", *statuses).agg(F.count(F.lit(1)).alias("n_rows"))
    long = groups.select(
        "date",
        F.expr(
            "stack(3, 'monthly', monthly_status, 'ttm', ttm_status, 'ytd', ytd_status)"
            " AS (horizon, status)"
        ),
        "n_rows",
    )
    return long.groupBy("date", "horizon", "status").agg(F.sum("n_rows").alias("n_rows"))
