"""The metrics over running sums: brute force on odd amounts, and what the dense rows no longer meet."""

import datetime as dt
import random
import tempfile
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlens.functions import labels as L
from ledgerlens.functions.amounts import MONEY_PLACE, Amount
from ledgerlens.operators import horizons as H
from ledgerlens.operators import report as R
from ledgerlens.operators import status as S
from ledgerlens.plans import retention as RP
from test_plans import NO_AQE, formatted, settings, tree

SCHEMA = "account_id long, product string, gateway_group string, date date, monthly_total decimal(38,13)"


def _month(i):
    return dt.date(1990 + i // 12, i % 12 + 1, 1)


def _rounded(x, places):
    return x.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def test_amounts_are_exact(spark):
    """Every sign and size that decimal(20,5) has; roundings of ties, and ``lo`` of the other sign than ``hi``."""
    texts = ["0", "0.00001", "-0.00001", "0.0005", "-0.0005", "0.00049", "-0.00051", "99999.99999", "-100000", "100000.00050",
             "-100000.00050", "999999999999999.99999", "-999999999999999.99999", "123456789.98765"]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a in texts for b in texts], "a decimal(20,5), b decimal(20,5)")
    df = df.select("a", "b", *Amount.of("a").columns("a"), *Amount.of("b").columns("b"))
    d = Amount.named("a") - Amount.named("b")
    for r in df.select("a", "b", d.decimal().alias("d"), d.sign().alias("s"), d.rounded().decimal().alias("r")).collect():
        want = r.a - r.b
        assert r.d == want and (r.s > 0) == (want > 0) and (r.s < 0) == (want < 0), r
        assert r.r == _rounded(want, 3), r


def test_horizons_equal_brute_force(spark):
    rnd = random.Random(3)
    amounts = [Decimal(x) for x in ("0.0005", "-0.0005", "12.34567", "-12.34567", "999999999999.99949", "-999999999999.99951", "0", "3")]
    cells = {(a, g, m): rnd.choice(amounts) for a in (1, 2, 3) for g in ("X", "Y") for m in rnd.sample(range(60), rnd.choice([1, 3, 9, 30]))}
    start, end, tail = 10, 50, 5
    df = spark.createDataFrame([(a, "P", g, _month(m), v) for (a, g, m), v in cells.items()], SCHEMA)
    out = H.with_amounts(H.add_horizons(df, _month(end), tail, _month(start)))
    got = {(r.account_id, r.gateway_group, r.date): r for r in out.collect()}
    want, sums = {}, {}
    for a, g in {k[:2] for k in cells}:
        months = [m for a2, g2, m in cells if (a2, g2) == (a, g)]
        own = {m: cells.get((a, g, m), Decimal(0)) for m in range(max(min(months), start), min(max(months) + tail, end) + 1)}
        third = {m: _rounded(v, 3) for m, v in own.items()}
        for m in own:
            sums[a, g, m] = (own, sum(own.get(k, 0) for k in range(m - 11, m + 1)), sum(third.get(k, 0) for k in range(m - m % 12, m + 1)), third)
    starts = {a: [min((m for (a2, _, m), s in sums.items() if a2 == a and s[k] > 0), default=None) for k in (1, 2)] for a in (1, 2, 3)}
    for (a, g, m), (own, ttm, ytd, third) in sums.items():
        t, y = starts[a]
        before = sums.get((a, g, m - 12), (None, Decimal(0), Decimal(0), None))
        t_new = y_new = Decimal(0)
        if t is not None:
            t_new = ttm if m - t < 12 else sum(own.get(k, 0) for k in range(m - 11, m + 1) if k < t + 12) if m - t < 24 else 0
        if y is not None:
            next_year = m // 12 == y // 12 + 1
            y_new = ytd if m - y < 12 else sum(own.get(k, 0) for k in range(m - 11, m + 1) if k < y + 12 and k // 12 == m // 12) if next_year else 0
        want[a, g, _month(m)] = (own[m], third.get(m - 12, 0), ttm, t_new, _rounded(before[1], 3), ytd, y_new, before[2], t, y)
    assert got.keys() == want.keys()
    for k, w in want.items():
        r = got[k]
        assert tuple(r[c] for c in H.AMOUNTS) == w[:8], (k, r, w)
        assert (r.ttm_cohort, r.ytd_cohort) == tuple(None if x is None else _month(x) for x in w[8:]), (k, r, w)
        assert r.change_in_existing_ttm == w[2] - w[3] - w[4] and r.ytd_total_existing == w[5] - w[6]


def _above_the_months(spark, name):
    """Names of the operators that the dense rows meet."""
    names = [n for _, n in tree(formatted(E.queries()[name](spark, SF_SMALL)))]
    return names[:names.index("Generate")] if name != "status_counts" else names[names.index("Generate") + 1:][:names[names.index("Generate") + 1:].index("Generate")]


def test_the_dense_rows_of_the_metrics_meet_no_window(spark):
    """the windows are over the priced rows; each dense row of aux_report is only projected."""
    with settings(spark, **NO_AQE):
        assert set(_above_the_months(spark, "aux_report")) <= {"Project"}


def test_the_dense_rows_of_the_statuses_meet_two_windows_and_one_sort(spark):
    """No amount passes them as a decimal."""
    with settings(spark, **NO_AQE):
        for name in ("status_counts", "product_totals", "ttm_status", "future_activity", "ytd_status"):
            above = _above_the_months(spark, name)
            assert above.count("Window") <= 2 and above.count("Sort") <= 1, (name, above)


def test_generated_methods_are_compiled(spark):
    """the JVM never compiles a method of more than 8,000 bytes."""
    import contextlib
    import io
    import re

    with settings(spark, **NO_AQE):
        for name in ("aux_report", "status_counts", "retention_report"):
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                E.queries()[name](spark, SF_SMALL).explain("codegen")
            sizes = [int(m) for m in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
            assert sizes and max(sizes) < 8000, (name, sizes)


def test_generated_methods_of_the_kept_report_are_compiled(spark):
    """what a refresh writes, and what a reader makes of it."""
    import contextlib
    import io
    import re

    with settings(spark, **NO_AQE):
        compact = RP.compact_report(RP.fixture_inputs(spark, SF_SMALL), RP.fixture_params(), buckets=64)
        kept = f"{tempfile.mkdtemp(prefix='ledgerlens-test-')}/kept"
        compact.write.parquet(kept)
        for df in (compact, R.whole_report(spark.read.parquet(kept))):
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                df.explain("codegen")
            sizes = [int(m) for m in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
            assert sizes and max(sizes) < 8000, sizes


def test_the_peak_as_a_double_has_the_band_of_the_decimal(spark):
    near = [t * 100_000 + d for t, _ in L.SIZE_BANDS for d in (-1, 0, 1)] + [0, -1, 10**24]
    df = spark.createDataFrame([(v // 10**10, v % 10**10) for v in near], "_hi_a long, _lo_a long")
    a = Amount.named("a")
    bands = df.select(
        L.size_band(a.sign() / F.lit(float(MONEY_PLACE))).alias("by_double"), L.size_band(a.decimal()).alias("by_decimal")
    ).collect()
    assert all(r.by_double == r.by_decimal for r in bands) and len({r.by_double for r in bands}) == len(L.SIZE_BANDS) + 1


def test_the_report_has_the_band_of_its_largest_total(spark):
    """``ttm_peak`` of the status window gives the bands of ``add_size_band``."""
    inp, prm = RP.fixture_inputs(spark, SF_SMALL), RP.fixture_params()
    df = R.add_size_band(S.classify_status(RP._horizons(RP.monthly_totals(inp, prm), prm), peak=True))
    own = R._peak_band(F.col("ttm_peak"))
    assert df.where(~own.eqNullSafe(F.col("processing_max_ttm_size"))).count() == 0
    assert df.where(own != L.NON_ACTIVE_BAND).count() > 0
