"""Exact products of totals and rates, and prices by rates stored as doubles."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import money as M
from ledgerlens.operators import pricing as P

getcontext().prec = 120


def rounded(x: Decimal, places: int = 13) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def products(spark, pairs):
    rows = [(i, str(t), str(r)) for i, (t, r) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, t string, r string").select(
        "i", F.col("t").cast(M.TOTAL_FACTOR).alias("t"), F.col("r").cast(M.RATE_FACTOR).alias("r")
    )
    return [row["x"] for row in M.with_product(df, "t", "r", "x").orderBy("i").collect()]


def test_products_equal_exact_arithmetic(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(400):
        t = Decimal(rng.randint(0, 10 ** rng.randint(1, 30))).scaleb(-rng.randint(0, 12)) % Decimal(10**18)
        r = Decimal(rng.randint(0, 10 ** rng.randint(1, 24))).scaleb(-24) + rng.choice([0, 0, 0, rng.randint(1, 99_999)])
        pairs.append((t.quantize(Decimal("1e-12")) * rng.choice([1, -1]), r * rng.choice([1, 1, -1])))
    assert products(spark, pairs) == [rounded(t * r) for t, r in pairs]


def test_totals_up_to_24_digits(spark):
    rate = Decimal(repr(1 / 16345))
    totals = [Decimal(10) ** 24 - 1, Decimal("-999999999999999999999999.999999999999"), Decimal("123456789012345678901234.560000000000"), Decimal(10) ** 9]
    assert products(spark, [(t, rate) for t in totals]) == [rounded(t * rate.quantize(Decimal("1e-24"))) for t in totals]
    assert rounded(products(spark, [(totals[3], rate)])[0], 5) == Decimal("61180.78923")


def test_halves_round_away_from_zero(spark):
    half = Decimal("0.5") * Decimal("1e-12")
    pairs = [(Decimal(1), half * Decimal("0.1")), (Decimal(-1), half * Decimal("0.1")), (Decimal("1e-12"), Decimal("0.05")), (Decimal(0), Decimal(3))]
    assert products(spark, pairs) == [rounded(t * r) for t, r in pairs]
    assert products(spark, pairs)[0] == Decimal("1e-13")


def test_nulls_and_missing_numbers(spark):
    df = spark.createDataFrame([(1.5, float("nan")), (None, 1.0), (2.0, float("inf")), (2.0, 0.1)], "t double, r double").select(
        F.col("t").cast(M.TOTAL_FACTOR).alias("t"), M.rate_factor(F.col("r"), spark.createDataFrame([], "r double").schema["r"].dataType).alias("r")
    )
    assert [row["x"] for row in M.with_product(df, "t", "r", "x").collect()] == [None, None, None, Decimal("0.2")]


def test_too_large_a_total_stops_the_job(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|overflow|cannot be represented"):
        df = spark.range(1).select(F.lit("1" + "0" * 25).cast("decimal(38,0)").alias("t"), F.lit("0.5").cast(M.RATE_FACTOR).alias("r"))
        M.with_product(df, "t", "r", "x").collect()


def test_short_factors_keep_sparks_own_product(spark):
    df = spark.createDataFrame([("12.34", "1.1")], "t string, r string").select(F.col("t").cast("decimal(22,2)").alias("t"), F.col("r").cast("decimal(4,1)").alias("r"))
    out = M.with_product(df, "t", "r", "x")
    assert out.columns == ["t", "r", "x"] and out.first()["x"] == Decimal("13.574")


def priced(spark, amounts, rate_type, rates):
    day = dt.datetime(2020, 1, 15)
    tx = spark.createDataFrame(
        [(1, 7, 9, c, day, kind, Decimal(a), 6) for c, kind, a in amounts],
        "account_id int, form_id int, gateway_id int, currency string, date_created timestamp, transaction_type int, amount decimal(30,2), status int",
    )
    er = spark.createDataFrame([(day.date(), c, r) for c, r in rates], f"date date, currency string, rate {rate_type}")
    take = spark.createDataFrame([], "gateway_group string, date date, product string, rate decimal(20,10)")
    out = P.priced_monthly_totals(
        tx, spark.createDataFrame([(7, "p")], "id int, product string"), spark.createDataFrame([(9, "wepay")], "id int, type string"), er, take,
        fallback_wepay=Decimal("0.0053729985439988"),
    ).collect()
    assert len(out) == 1
    return out[0]["monthly_total"]


def test_double_rates_price_with_all_their_digits(spark):
    rate, take = 1 / 16345, Decimal("0.0053729985439988")
    amounts = [("EUR", 1, "1000000000.00"), ("EUR", 1, "0.01"), ("EUR", 2, "77.77"), ("USD", 1, "5.00"), ("EUR", 3, "9.99"), ("XXX", 1, "4.00")]
    got = priced(spark, amounts, "double", [("EUR", rate), ("USD", 1.0)])
    exact = ((Decimal("1000000000.01") - Decimal("77.77")) * Decimal(repr(rate)) + 5) * take
    assert rounded(got, 5) == rounded(exact, 5) and abs(got - exact) < Decimal("1e-11")
    large = priced(spark, [("EUR", 1, "9999999999999999999999.99")], "double", [("EUR", rate)])
    assert rounded(large, 5) == rounded(Decimal("9999999999999999999999.99") * Decimal(repr(rate)) * take, 5)


def test_months_without_a_rate_or_with_other_rows(spark):
    assert priced(spark, [("XXX", 1, "4.00")], "double", [("EUR", 2.0)]) is None
    assert priced(spark, [("XXX", 1, "4.00"), ("XXX", 3, "1.00")], "double", [("EUR", 2.0)]) == 0
