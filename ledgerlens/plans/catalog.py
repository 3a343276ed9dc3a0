"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the test tables through ``sources.fixtures`` and runs over
whole tables.  Output columns are aliased and typed like ``oracle_sql``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.amounts import Amount
from ..operators import densify as D
from ..operators import pricing as P
from ..operators import report as R
from ..operators import status as S
from ..session import shared_dir
from ..sources import fixtures as FX
from . import retention as RP

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["account_id", "product", "gateway_group", "date"]
PRODUCT_MONEY = [
    "monthly_total_product", "monthly_trailing_total_product", "ttm_total_product",
    "ttm_trailing_total_product", "ytd_total_product", "ytd_trailing_total_product",
]


def _ctx(spark: SparkSession, sf_dir: str):
    return RP.fixture_inputs(spark, sf_dir), RP.fixture_params()


def _money(*cols: str) -> list:
    return [F.col(c).cast(R.MONEY_TYPE).alias(c) for c in cols]


def q_priced_monthly_totals(spark, sf_dir):
    inp, prm = _ctx(spark, sf_dir)
    return RP.priced_with_accounts(inp, prm).select(
        "account_id", "account_name", "account_manager_name", "organization_id", "product",
        "gateway_group", "date", F.col("monthly_total").cast("decimal(38,13)").alias("monthly_total"),
    )


def q_priced_monthly_totals_double(spark, sf_dir):
    """C4 with day rates stored as doubles, all of their digits counted."""
    inp, prm = _ctx(spark, sf_dir)
    inp = replace(inp, exchange_rates=FX.exchange_rates_double(FX.Tables(spark, sf_dir)))
    return RP.monthly_totals(inp, prm).select(
        "account_id", "product", "gateway_group", "date", F.col("monthly_total").cast(R.MONEY_TYPE).alias("monthly_total")
    )


def q_series_extent(spark, sf_dir):
    inp, prm = _ctx(spark, sf_dir)
    return D.series_extent(RP.monthly_totals(inp, prm))


def q_dense_base(spark, sf_dir):
    inp, prm = _ctx(spark, sf_dir)
    return RP.dense_base(inp, prm).select(
        "account_id", "account_name", "account_manager_name", "product", "gateway_group",
        "organization_id", "month", "year", "date", "monthly_total",
    )


def _aux(spark, sf_dir) -> DataFrame:
    inp, prm = _ctx(spark, sf_dir)
    return RP.metric_frame(inp, prm)


def q_monthly_metrics(spark, sf_dir):
    return _aux(spark, sf_dir).select(
        *KEYS, "monthly_cohort", *_money("monthly_trailing_total", "change_in_existing_monthly")
    )


def _metric_query(*cols: str) -> Query:
    def q(spark, sf_dir):
        return _aux(spark, sf_dir).select(*KEYS, *_money(*cols))
    return q


def _cohort_query(col: str) -> Query:
    def q(spark, sf_dir):
        return (
            _aux(spark, sf_dir).where(F.col(col).isNotNull())
            .select("account_id", "product", col).distinct()
        )
    return q


def q_monthly_cohort(spark, sf_dir):
    """A2 on the priced totals: first positive month per (account, product),
    over all priced months (not cut by as_of)."""
    inp, prm = _ctx(spark, sf_dir)
    return (
        RP.monthly_totals(inp, prm).where(F.col("monthly_total") > 0)
        .groupBy("account_id", "product").agg(F.min("date").alias("monthly_cohort"))
    )


def q_aux_report(spark, sf_dir):
    inp, prm = _ctx(spark, sf_dir)
    return RP.aux_report(inp, prm)


def _classified(spark, sf_dir) -> DataFrame:
    inp, prm = _ctx(spark, sf_dir)
    return RP.classified_frame(inp, prm)


def q_product_totals(spark, sf_dir):
    c = _classified(spark, sf_dir).where(F.col("account_id").isNotNull() & F.col("product").isNotNull())
    # the rows of a product and month have the same longs, hashed faster than decimals
    pairs = [f"_{p}_{a}" for a in S.PRODUCT_AMOUNTS for p in ("hi", "lo")]
    rows = c.select("account_id", "product", "date", *pairs).distinct()
    return rows.select("account_id", "product", "date", *[Amount.named(a).decimal().alias(a) for a in PRODUCT_MONEY])


def q_future_activity(spark, sf_dir):
    return _classified(spark, sf_dir).select(
        "account_id", "product", "date", "monthly_future_date", "ttm_future_date", "ytd_future_date"
    ).distinct()


def _status_query(h: str) -> Query:
    def q(spark, sf_dir):
        return _classified(spark, sf_dir).select(*KEYS, f"{h}_status")
    return q


def q_status_counts(spark, sf_dir):
    inp, prm = _ctx(spark, sf_dir)
    return RP.status_counts(inp, prm)


def q_max_ttm_band(spark, sf_dir):
    c = R.add_size_band(_classified(spark, sf_dir))
    return c.where(F.col("account_id").isNotNull() & F.col("product").isNotNull()).select(
        "account_id", "product", *_money("max_total"), "processing_max_ttm_size"
    ).distinct()


def q_attribution(spark, sf_dir):
    inp, prm = _ctx(spark, sf_dir)
    return RP.attribution_by_account(inp, prm).select("account_id", "attribution_type", "attribution_source", "industry")


def q_size_py_distinct(spark, sf_dir):
    inp, prm = _ctx(spark, sf_dir)
    return RP.size_py_by_year(inp, prm)


def q_retention_report(spark, sf_dir):
    inp, prm = _ctx(spark, sf_dir)
    return RP.retention_report(inp, prm)


def q_retention_report_incremental(spark, sf_dir):
    """The report built without the latest orders, then refreshed by them; the published buckets."""
    from . import incremental as INC

    inp, prm = _ctx(spark, sf_dir)
    t = FX.Tables(spark, sf_dir)
    last = t("orders").agg(F.max("o_orderkey")).first()[0] or 0
    early, late = (FX.dim_transaction(t, P.KEPT_STATUS, keys) for keys in (F.col("o_orderkey") <= last * 98 // 100, F.col("o_orderkey") > last * 98 // 100))
    target = shared_dir(spark, f"retention_report/{uuid.uuid4().hex}")
    INC.refresh_report(spark, replace(inp, transactions=early), prm, target)
    INC.refresh_report(spark, inp, prm, target, changed=late.select("account_id", "form_id"))
    schema = RP.retention_report(inp, prm).schema
    return INC.read_report(spark, target, schema)


RETENTION_QUERIES: dict[str, Query] = {
    "priced_monthly_totals": q_priced_monthly_totals,
    "priced_monthly_totals_double": q_priced_monthly_totals_double,
    "series_extent": q_series_extent,
    "dense_base": q_dense_base,
    "monthly_metrics": q_monthly_metrics,
    "ttm_rolling": _metric_query("ttm_total"),
    "ttm_trailing": _metric_query("ttm_trailing_total"),
    "ttm_cohort": _cohort_query("ttm_cohort"),
    "ytd_cohort": _cohort_query("ytd_cohort"),
    "monthly_cohort": q_monthly_cohort,
    "ttm_new_existing": _metric_query("ttm_total_new", "ttm_total_existing"),
    "ytd_running": _metric_query("ytd_total"),
    "ytd_trailing": _metric_query("ytd_trailing_total"),
    "ytd_new_existing": _metric_query("ytd_total_new", "ytd_total_existing"),
    "aux_report": q_aux_report,
    "product_totals": q_product_totals,
    "future_activity": q_future_activity,
    "monthly_status": _status_query("monthly"),
    "ttm_status": _status_query("ttm"),
    "ytd_status": _status_query("ytd"),
    "status_counts": q_status_counts,
    "max_ttm_band": q_max_ttm_band,
    "attribution": q_attribution,
    "size_py_distinct": q_size_py_distinct,
    "retention_report": q_retention_report,
    "retention_report_incremental": q_retention_report_incremental,
}


def all_queries() -> dict[str, Query]:
    from .jobs import JOB_QUERIES

    out = dict(RETENTION_QUERIES)
    out.update(JOB_QUERIES)
    return out
