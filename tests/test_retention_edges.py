"""Edge rows through the whole retention lineage vs the self-join oracle.

Inline tables (generated from a fixed seed) cover: missing form (NULL
product), form with NULL product, NULL gateway type and missing gateway
(NULL group), a non-listed gateway type (Other), days and months without an
exchange rate, take-rate fallbacks for WePay / other / NULL groups,
transaction type 3, non-kept status, activity after ``as_of``, gaps longer
than the 24-month tail, December and January cohorts, an account missing from
the account table and a manager with a NULL last name.  The same tables are
registered in DuckDB under the oracle's input names and the oracle's model
CTEs (self-join form) are run on them.
"""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest

from ledgerlens.plans import oracle_sql as O
from ledgerlens.plans import retention as RP
from oracle_check import _diff, table_hash

AS_OF = dt.date(2001, 12, 1)
CAL_START = dt.date(1995, 1, 1)


def _month_add(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.month - 1 + n, 12)
    return dt.date(d.year + y, m + 1, 1)


def _tables():
    rnd = random.Random(7)
    # (account, form, gateway, currency, first month, months active, gap pattern)
    series = [
        (1, 10, 100, "X", dt.date(1996, 1, 1), 30, None),    # WePay, product A
        (1, 10, 103, "Y", dt.date(1996, 6, 1), 14, None),    # paypal -> Other
        (1, 11, 101, "X", dt.date(1996, 12, 1), 20, "neg"),  # Stripe, B, net negative spells
        (1, 11, 101, "X", dt.date(2002, 2, 1), 2, None),     # after as_of
        (2, 10, 102, "Z", dt.date(1997, 3, 1), 6, None),     # currency without rates
        (2, 10, 102, "X", dt.date(1997, 5, 1), 8, None),
        (2, 12, 100, "X", dt.date(1997, 1, 1), 5, None),     # form with NULL product
        (2, 13, 101, "X", dt.date(1997, 1, 1), 5, None),     # missing form
        (3, 11, 104, "X", dt.date(1998, 1, 1), 6, None),     # NULL gateway type
        (3, 11, 105, "X", dt.date(1998, 2, 1), 6, None),     # missing gateway
        (3, 10, 101, "X", dt.date(1998, 12, 1), 40, "gap"),  # December cohort, long gap
        (4, 10, 100, "X", dt.date(1999, 1, 1), 15, None),    # January cohort, missing account
        (4, 11, 100, "Y", dt.date(1995, 2, 1), 4, "late"),   # gap > 24 months then return
        (5, 11, 100, "X", dt.date(2001, 6, 1), 1, "refund"),  # only a refund before as_of ...
        (5, 11, 100, "X", dt.date(2002, 3, 1), 2, "sale"),   # ... positive months only after it
    ]
    tx = []
    for acct, form, gw, cur, first, n, pattern in series:
        for i in range(n):
            if pattern == "gap" and 6 <= i < 34:
                continue
            month = _month_add(first, i)
            if pattern == "late" and i == 3:
                month = _month_add(first, 40)
            for _ in range(rnd.randint(1, 3)):
                day = dt.datetime(month.year, month.month, rnd.randint(1, 28), rnd.randint(0, 23))
                ttype = rnd.choice([1, 1, 1, 2, 3]) if pattern != "neg" else rnd.choice([1, 2, 2])
                status = rnd.choice([6, 6, 6, 6, 1])
                if pattern == "refund":
                    ttype, status = 2, 6
                if pattern == "sale":
                    ttype, status = 1, 6
                amount = Decimal(rnd.randint(100, 500000)) / 100
                tx.append((acct, form, gw, cur, day, ttype, amount, status))
    # a day in March 1997 without a Y rate, and a transaction on that day
    tx.append((1, 10, 103, "Y", dt.datetime(1997, 3, 15, 12), 1, Decimal("99.99"), 6))
    # no timestamp (matches no month), and no account at all (NULL key series)
    tx.append((2, 11, 101, "X", None, 1, Decimal("55.00"), 6))
    tx.append((None, 10, 100, "X", dt.datetime(1999, 5, 5, 5), 1, Decimal("77.00"), 6))
    tx.append((None, 10, 100, "X", dt.datetime(1999, 9, 5, 5), 1, Decimal("12.00"), 6))

    days = [CAL_START + dt.timedelta(days=i) for i in range((AS_OF - CAL_START).days + 1)]
    later = [AS_OF + dt.timedelta(days=i) for i in range(1, 400)]  # rates exist past as_of
    fx = [(d, "X", Decimal("1.0")) for d in days + later]
    fx += [(d, "Y", Decimal("2.0")) for d in days if d != dt.date(1997, 3, 15)]
    months = [d for d in days if d.day == 1]
    take = [("WePay", m, "A", Decimal("0.02")) for m in months]
    take += [("Other", m, "A", Decimal("0.015")) for m in months if m.month % 2 == 1]
    take += [("Stripe", m, "B", Decimal("0.01")) for m in months if m.year < 1999]
    return {
        "tx": (
            [("account_id", pa.int64()), ("form_id", pa.int64()), ("gateway_id", pa.int64()),
             ("currency", pa.string()), ("date_created", pa.timestamp("us")),
             ("transaction_type", pa.int32()), ("amount", pa.decimal128(12, 2)),
             ("status", pa.int32())],
            tx),
        "acct": ([("id", pa.int64()), ("name", pa.string()), ("organization_id", pa.int32())],
                 [(1, "one", 1), (2, "two", 2), (3, "three", 5)]),
        "form": ([("id", pa.int64()), ("product", pa.string())],
                 [(10, "A"), (11, "B"), (12, None)]),
        "gateway": ([("id", pa.int64()), ("type", pa.string())],
                    [(100, "wepay"), (101, "stripe"), (102, "adyen"), (103, "paypal"), (104, None)]),
        "mgr_link": ([("account_id", pa.int64()), ("account_manager_id", pa.int64())],
                     [(1, 1), (2, 2)]),
        "mgr": ([("id", pa.int64()), ("first_name", pa.string()), ("last_name", pa.string())],
                [(1, "Ann", "Lee"), (2, "Bob", None)]),
        "fx": ([("date", pa.date32()), ("currency", pa.string()), ("rate", pa.decimal128(4, 1))], fx),
        "take": ([("gateway_group", pa.string()), ("date", pa.date32()), ("product", pa.string()),
                  ("rate", pa.decimal128(20, 10))], take),
        "attribution_in": ([("account_id", pa.int64()), ("utm_medium", pa.string()),
                            ("utm_source", pa.string())],
                           [(1, "cpc", "FB"), (2, None, "Google"), (4, "email", None)]),
        "industry_in": ([("account_id", pa.int64()), ("industry", pa.string())],
                        [(1, "Education"), (3, "Religious")]),
        "max_ttm_in": ([("account_id", pa.int64()), ("product", pa.string()),
                        ("product_max_ttm_size", pa.string())],
                       [(1, "A", "7. Micro ($1 - $10k)"), (3, "A", "5. Small ($25k - $100k)")]),
        "size_py_in": ([("account_id", pa.int64()), ("product", pa.string()), ("year", pa.int32()),
                        ("customer_size_py", pa.string())],
                       [(1, "A", 1997, "6. Very Small ($10k - $25k)"),
                        (1, "A", 1997, "6. Very Small ($10k - $25k)"),
                        (3, "A", 1999, "7. Micro ($1 - $10k)")]),
    }


def _arrow(spec):
    cols, rows = spec
    arrays = [pa.array([r[i] for r in rows], type=t) for i, (_, t) in enumerate(cols)]
    return pa.table(arrays, names=[c for c, _ in cols])


@pytest.fixture(scope="module")
def edge(spark):
    specs = _tables()
    arrow = {k: _arrow(v) for k, v in specs.items()}
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for k, t in arrow.items():
        con.register(k, t)
    con.execute(
        "CREATE VIEW cal_days AS SELECT CAST(range AS DATE) AS full_date, "
        "CAST(dayofmonth(range) AS INTEGER) AS month_day_number "
        "FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-02', INTERVAL 1 DAY)"
    )
    df = {k: spark.createDataFrame(t) for k, t in arrow.items()}
    inp = RP.RetentionInputs(
        transactions=df["tx"], forms=df["form"], gateways=df["gateway"],
        exchange_rates=df["fx"], take_rates=df["take"], accounts=df["acct"],
        manager_links=df["mgr_link"], managers=df["mgr"], attribution=df["attribution_in"],
        industries=df["industry_in"], max_ttm=df["max_ttm_in"], size_py=df["size_py_in"],
    )
    return con, inp, RP.fixture_params()


def _oracle(con, select):
    cur = con.execute("WITH " + O.MODEL_CTES.strip() + "\n" + select)
    return [c[0] for c in cur.description], cur.fetchall()


def _check(df, con, select):
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    d_cols, d_rows = _oracle(con, select)
    assert sorted(s_cols) == sorted(d_cols)
    if table_hash(s_cols, s_rows) != table_hash(d_cols, d_rows):
        _diff("edge", s_cols, s_rows, d_cols, d_rows, limit=10)
        pytest.fail(f"spark {len(s_rows)} rows vs oracle {len(d_rows)} rows differ")


def test_edge_priced_totals(edge):
    con, inp, prm = edge
    from pyspark.sql import functions as F
    df = RP.priced_with_accounts(inp, prm).select(
        "account_id", "account_name", "account_manager_name", "organization_id", "product",
        "gateway_group", "date", F.col("monthly_total").cast("decimal(38,13)").alias("monthly_total"))
    _check(df, con, O.RETENTION_SELECTS["priced_monthly_totals"])


def test_edge_aux(edge):
    con, inp, prm = edge
    _check(RP.aux_report(inp, prm), con, O.RETENTION_SELECTS["aux_report"])


def test_edge_report(edge):
    con, inp, prm = edge
    _check(RP.retention_report(inp, prm), con, O.RETENTION_SELECTS["retention_report"])


def test_edge_properties(edge):
    """Dense spine, one row per grain, new + existing = total, TTM = sum of
    the last 12 months, report rows = base rows."""
    con, inp, prm = edge
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window
    aux = RP.aux_report(inp, prm).cache()
    keys = ["account_id", "product", "gateway_group"]
    assert aux.groupBy(*keys, "date").count().where("count > 1").count() == 0
    w = Window.partitionBy(*keys).orderBy("date")
    gaps = aux.withColumn("prev", F.lag("date").over(w)).where(
        F.col("prev").isNotNull() & (F.add_months("prev", 1) != F.col("date")))
    assert gaps.count() == 0
    assert aux.where(F.col("ttm_total_new") + F.col("ttm_total_existing") != F.col("ttm_total")).count() == 0
    assert aux.where(F.col("ytd_total_new") + F.col("ytd_total_existing") != F.col("ytd_total")).count() == 0
    ttm12 = aux.withColumn("s12", F.sum("monthly_total").over(w.rowsBetween(-11, 0)))
    ok = F.col("account_id").isNotNull() & F.col("product").isNotNull() & F.col("gateway_group").isNotNull()
    assert ttm12.where(ok & (F.col("s12") != F.col("ttm_total"))).count() == 0
    assert aux.where(F.col("date") > F.lit(AS_OF)).count() == 0
    assert RP.retention_report(inp, prm).count() == aux.count()
    # NULL keys: statuses NULL, totals 0
    rep = RP.retention_report(inp, prm)
    nk = rep.where(F.col("product").isNull() | F.col("gateway_group").isNull())
    assert nk.count() > 0
    assert nk.where(F.col("ttm_status").isNotNull() | (F.col("ttm_total") != 0)).count() == 0


def test_edge_monthly_cohort_counts_months_after_as_of(edge):
    """Account 5 / product B has only a refund before as_of: its monthly
    cohort is its first positive month after as_of (priced months are not cut
    by as_of; the spine is)."""
    con, inp, prm = edge
    from pyspark.sql import functions as F
    rows = RP.aux_report(inp, prm).where((F.col("account_id") == 5) & (F.col("product") == "B"))
    cohorts = {r.monthly_cohort for r in rows.select("monthly_cohort").collect()}
    assert len(cohorts) == 1 and next(iter(cohorts)) > AS_OF
    assert rows.count() > 0
