"""Scalar rules on inline rows: status truth table, bands, labels, dates."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import labels as L
from ledgerlens.functions.dates import floor_days_between, micros_of_day, month_boundaries
from ledgerlens.functions.status import classify


def _one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


STATUS_SCHEMA = "big_t double, big_p double, t double, p double, d double, m int, f date, n double"


def _status(spark, row, horizon_new=False):
    c = F.col
    expr = classify(c("big_t"), c("big_p"), c("t"), c("p"), c("d"), c("m"), c("f"),
                    n=c("n") if horizon_new else None)
    return _one(spark, expr, STATUS_SCHEMA, row)


LATER = dt.date(2000, 1, 1)


@pytest.mark.parametrize("horizon_new", [False, True])
@pytest.mark.parametrize("row,expected", [
    ((5.0, 0.0, 5.0, 0.0, 5.0, 3, None, 0.0), "new"),
    ((5.0, -1.0, 5.0, 0.0, 5.0, 11, None, 0.0), "new"),
    ((0.0, 4.0, 0.0, 4.0, -4.0, 20, None, 0.0), "lost"),
    ((0.0, 4.0, 0.0, 4.0, -4.0, 20, LATER, 0.0), "lapsed"),
    ((5.0, 0.0, 5.0, 0.0, 5.0, 12, None, 0.0), "recovered"),
    ((6.0, 4.0, 6.0, 4.0, 2.0, 30, None, 0.0), "upsell"),
    ((6.0, 4.0, 6.0, 4.0, 0.0, 30, None, 0.0), "upsell"),
    ((3.0, 4.0, 3.0, 4.0, -1.0, 30, None, 0.0), "downsell"),
    ((-2.0, -1.0, -2.0, -1.0, -1.0, 30, None, 0.0), "negative or null"),
    ((0.0, 0.0, 0.0, 0.0, 0.0, 30, None, 0.0), "negative or null"),
    # product positive, row total 0 and no trailing at row level -> unknown
    ((5.0, 4.0, 0.0, 0.0, 0.0, 30, None, 0.0), "unknown"),
    # NULL cohort: the month rules cannot fire
    ((5.0, 0.0, 5.0, 0.0, 5.0, None, None, 0.0), "unknown"),
])
def test_status_truth_table(spark, row, expected, horizon_new):
    assert _status(spark, row, horizon_new) == expected


def test_status_ttm_rules_use_new_amount(spark):
    # upsell through n > 0 although the product had no trailing total
    # (rules 1 and 4 do not fire because T <= 0 is false and P <= 0 is true but m is NULL)
    row = (5.0, 0.0, 5.0, 0.0, 1.0, None, None, 2.0)
    assert _status(spark, row, horizon_new=False) == "unknown"
    assert _status(spark, row, horizon_new=True) == "upsell"
    # downsell through t <= 0 with a positive new amount
    row = (5.0, 0.0, -1.0, 0.0, 1.0, None, None, 2.0)
    assert _status(spark, row, horizon_new=True) == "downsell"


@pytest.mark.parametrize("value,band", [
    (None, "8. Non Active (<= $0)"),
    (-5, "8. Non Active (<= $0)"),
    (0, "8. Non Active (<= $0)"),
    (Decimal("0.00001"), "7. Micro ($1 - $10k)"),
    (10000, "7. Micro ($1 - $10k)"),
    (Decimal("10000.00001"), "6. Very Small ($10k - $25k)"),
    (25000, "6. Very Small ($10k - $25k)"),
    (Decimal("25000.01"), "5. Small ($25k - $100k)"),
    (100000, "5. Small ($25k - $100k)"),
    (Decimal("100000.01"), "4. Medium ($100k - $250k)"),
    (250000, "4. Medium ($100k - $250k)"),
    (Decimal("250000.01"), "3. Large ($250k - $1m)"),
    (1000000, "3. Large ($250k - $1m)"),
    (Decimal("1000000.01"), "2. Very Large ($1m - $2.5m)"),
    (2500000, "2. Very Large ($1m - $2.5m)"),
    (Decimal("2500000.01"), "1. Strategic (>$2.5m)"),
])
def test_size_band_boundaries(spark, value, band):
    v = None if value is None else Decimal(value)
    assert _one(spark, L.size_band("x"), "x decimal(20,5)", (v,)) == band


@pytest.mark.parametrize("src,out", [
    ("FB", "meta"), ("fb", "meta"), ("Facebook", "meta"), ("Instagram", "meta"),
    ("Google", "Google"), ("bing", "bing"), (None, "unknown"),
])
def test_attribution_source(spark, src, out):
    assert _one(spark, L.attribution_source("s"), "s string", (src,)) == out


def test_attribution_type_default(spark):
    assert _one(spark, L.attribution_type("s"), "s string", (None,)) == "organic"
    assert _one(spark, L.attribution_type("s"), "s string", ("cpc",)) == "cpc"


@pytest.mark.parametrize("typ,group", [
    ("wepay", "WePay"), ("stripe", "Stripe"), ("adyen", "Adyen"), ("paypal", "Other"),
    ("WePay", "Other"), (None, None),
])
def test_gateway_group(spark, typ, group):
    assert _one(spark, L.gateway_group("t"), "t string", (typ,)) == group


def test_organization_label(spark):
    labels = {1: "one", 2: "two", 3: "three"}
    got = [
        _one(spark, L.organization_label("o", labels), "o int", (v,)) for v in (1, 2, 3, 4, None)
    ]
    assert got == ["one", "two", "three", "unknown", "unknown"]


@pytest.mark.parametrize("a,b,n", [
    (dt.date(1999, 1, 31), dt.date(1999, 2, 1), 1),
    (dt.date(1999, 1, 1), dt.date(1999, 12, 1), 11),
    (dt.date(1999, 1, 1), dt.date(2000, 1, 1), 12),
    (dt.date(1999, 1, 1), dt.date(2000, 12, 1), 23),
    (dt.date(1999, 1, 1), dt.date(2001, 1, 1), 24),
    (dt.date(2001, 1, 1), dt.date(1999, 1, 1), -24),
])
def test_month_boundaries(spark, a, b, n):
    assert _one(spark, month_boundaries("a", "b"), "a date, b date", (a, b)) == n


def test_floor_days_and_time_of_day(spark):
    schema = "a timestamp, b timestamp"
    later = dt.datetime(2024, 1, 31, 17, 0, 0)
    assert _one(spark, floor_days_between("a", "b"), schema, (later, later - dt.timedelta(hours=6))) == 0
    assert _one(spark, floor_days_between("a", "b"), schema, (later, later + dt.timedelta(hours=1))) == -1
    assert _one(spark, floor_days_between("a", "b"), schema, (later, later - dt.timedelta(hours=24))) == 1
    ts = dt.datetime(2024, 1, 1, 3, 0, 1)
    assert _one(spark, micros_of_day("a"), "a timestamp", (ts,)) == (3 * 3600 + 1) * 1_000_000


def test_default_take_rate_fallbacks(spark):
    """No take-rate row: WePay uses 0.0053729985439988, any other or NULL
    group 0.001074863799773 (the report's own 16-digit defaults)."""
    from ledgerlens.operators.pricing import priced_monthly_totals

    ts = dt.datetime(2001, 3, 5, 10)
    tx = spark.createDataFrame(
        [(1, 10, 100, "X", ts, 1, Decimal("1000.00"), 6),
         (1, 10, 101, "X", ts, 1, Decimal("1000.00"), 6),
         (1, 10, 102, "X", ts, 2, Decimal("1000.00"), 6)],
        "account_id long, form_id long, gateway_id long, currency string, date_created timestamp, "
        "transaction_type int, amount decimal(12,2), status int")
    forms = spark.createDataFrame([(10, "A")], "id long, product string")
    gateways = spark.createDataFrame([(100, "wepay"), (101, "paypal"), (102, None)], "id long, type string")
    rates = spark.createDataFrame([(dt.date(2001, 3, 5), "X", Decimal("1.0"))], "date date, currency string, rate decimal(4,1)")
    take = spark.createDataFrame([], "gateway_group string, date date, product string, rate decimal(20,10)")
    got = {r.gateway_group: r.monthly_total for r in
           priced_monthly_totals(tx, forms, gateways, rates, take).collect()}
    assert got["WePay"] == Decimal("5.3729985439988")
    assert got["Other"] == Decimal("1.074863799773")
    assert got[None] == Decimal("-1.074863799773")


def test_duplicate_dimension_keys(spark):
    from ledgerlens.operators.joins import duplicate_keys

    rates = spark.createDataFrame(
        [(dt.date(2020, 1, 1), "X", 1.0), (dt.date(2020, 1, 1), "X", 1.1), (dt.date(2020, 1, 2), "X", 1.0)],
        "date date, currency string, rate double")
    dup = duplicate_keys(rates, ["date", "currency"]).collect()
    assert [(r.date, r.currency, r.n_rows) for r in dup] == [(dt.date(2020, 1, 1), "X", 2)]


def test_fixture_dimensions_have_unique_keys(spark):
    """The test-data views used by the oracle checks cannot fan out."""
    from ledgerlens.operators.joins import duplicate_keys
    from ledgerlens.plans import retention as RP

    inp = RP.fixture_inputs(spark, "/root/testdata/sf0.01")
    assert duplicate_keys(inp.exchange_rates, ["date", "currency"]).count() == 0
    assert duplicate_keys(inp.take_rates, ["gateway_group", "date", "product"]).count() == 0
    assert duplicate_keys(inp.accounts, ["id"]).count() == 0
    assert duplicate_keys(inp.forms, ["id"]).count() == 0
    assert duplicate_keys(inp.gateways, ["id"]).count() == 0


def _pricing_inputs(spark, amounts, rate="1.5", rate_type="double", amount_type="decimal(16,2)"):
    ts = dt.datetime(2001, 3, 5, 10)
    tx = spark.createDataFrame(
        [(1, 10, 100, "X", ts, 1, Decimal(a), 6) for a in amounts],
        f"account_id long, form_id long, gateway_id long, currency string, date_created timestamp, "
        f"transaction_type int, amount {amount_type}, status int")
    forms = spark.createDataFrame([(10, "A")], "id long, product string")
    gateways = spark.createDataFrame([(100, "wepay")], "id long, type string")
    rates = spark.createDataFrame([(dt.date(2001, 3, 5), "X", rate)], "date date, currency string, rate string")
    rates = rates.withColumn("rate", rates.rate.cast(rate_type))
    take = spark.createDataFrame([("WePay", dt.date(2001, 3, 1), "A", Decimal("0.02"))], "gateway_group string, date date, product string, rate decimal(20,10)")
    return tx, forms, gateways, rates, take


def test_double_day_rate_gives_exact_sums(spark):
    from ledgerlens.operators.pricing import priced_monthly_totals

    got = priced_monthly_totals(*_pricing_inputs(spark, ["0.10"] * 1000, rate="1.1")).collect()
    assert got[0].monthly_total == Decimal("2.2")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_is_not_capped(spark, ansi):
    """A month of 2e13 and a product sum above it go through the whole lineage."""
    import dataclasses

    from ledgerlens.plans import retention as RP

    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        inp, prm = RP.fixture_inputs(spark, "/root/testdata/sf0.001"), RP.fixture_params()
        tx, forms, gateways, rates, take = _pricing_inputs(spark, ["99999999999999.99"] * 10, rate="1", rate_type="decimal(4,1)")
        inp = dataclasses.replace(inp, transactions=tx, forms=forms, gateways=gateways, exchange_rates=rates, take_rates=take)
        row = RP.retention_report(inp, prm).where("date = date'2001-03-01'").collect()[0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    want = Decimal("19999999999999.998")
    assert row.monthly_total == row.ttm_total == row.ttm_total_product == row.ytd_total == want
    assert row.monthly_status == "new"


def test_duplicate_dimension_keys_stop_the_job(spark):
    from ledgerlens.operators.pricing import priced_monthly_totals

    tx, forms, gateways, rates, take = _pricing_inputs(spark, ["1.00"])
    with pytest.raises(Exception, match="exchange rate: a key occurs more than once"):
        priced_monthly_totals(tx, forms, gateways, rates.unionAll(rates), take).collect()
