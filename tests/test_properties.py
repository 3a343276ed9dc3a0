"""Property tests against brute force on random small inputs (hypothesis).

The two constructions that replace joins are checked here: the gap expansion
of ``missing_dates`` (instead of keys x calendar anti join) and the
lead + explode spine of ``densify_months`` (instead of extent x calendar).
"""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.operators import densify as D
from ledgerlens.operators import rates as RT

START = dt.date(2020, 1, 1)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

day_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]),
              st.one_of(st.none(), st.integers(-5, 40).map(lambda i: START + dt.timedelta(days=i)))),
    max_size=40,
)


@SETTINGS
@given(rows=day_rows, lo=st.integers(0, 10), span=st.integers(0, 30))
def test_missing_dates_equals_brute_force(spark, rows, lo, span):
    start, end = START + dt.timedelta(days=lo), START + dt.timedelta(days=lo + span)
    df = spark.createDataFrame(rows, "k string, d date")
    got = sorted((r.k, r.missing_date) for r in RT.missing_dates(df, "d", start, end, keys=["k"]).collect())
    keys = {k for k, _ in rows}
    seen = {(k, d) for k, d in rows if d is not None}
    cal = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    want = sorted((k, d) for k in keys for d in cal if (k, d) not in seen)
    assert got == want


def _month(i: int) -> dt.date:
    y, m = divmod(i, 12)
    return dt.date(2015 + y, m + 1, 1)


series_rows = st.lists(
    st.tuples(st.sampled_from([1, 2]), st.sampled_from(["A", "B"]), st.integers(0, 60),
              st.integers(-500, 500)),
    max_size=25,
)


@SETTINGS
@given(rows=series_rows, as_of_i=st.integers(10, 70), tail=st.integers(0, 30))
def test_densify_equals_extent_cross_calendar(spark, rows, as_of_i, tail):
    # one row per series and month, as the monthly aggregate guarantees
    uniq = {}
    for a, g, mi, v in rows:
        uniq[(a, g, mi)] = v
    data = [(a, "P", g, _month(mi), Decimal(v) / 100) for (a, g, mi), v in uniq.items()]
    df = spark.createDataFrame(
        data, "account_id long, product string, gateway_group string, date date, monthly_total decimal(38,13)")
    as_of = _month(as_of_i)
    got = sorted(
        (r.account_id, r.gateway_group, r.date, r.monthly_total)
        for r in D.densify_months(df, as_of, tail).collect()
    )
    # brute force: extent per series x every month, then the left join
    want = []
    for a, g in {(a, g) for a, g, _ in uniq}:
        months = [mi for (a2, g2, mi) in uniq if (a2, g2) == (a, g)]
        lo, hi = min(months), min(max(months) + tail, as_of_i)
        for mi in range(lo, hi + 1):
            v = uniq.get((a, g, mi))
            want.append((a, g, _month(mi), (Decimal(v) / 100 if v is not None else Decimal(0))))
    assert got == sorted(want)
