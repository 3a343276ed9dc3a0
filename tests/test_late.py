"""X1 with late and repeated versions against its batch form; A12 / A14 in pages."""

import datetime as dt
import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerlens.operators import audits as A
from ledgerlens.operators import flaglog as FL
from ledgerlens.plans import jobs as J
from ledgerlens.sources import fixtures as FX


def test_stream_equals_the_batch_form(spark):
    events = FX.Tables(spark, SF_SMALL)("events")
    deliveries = J.late_deliveries(events).select(
        F.col("event_id").alias("id"), F.col("user_id").alias("form_id"), F.col("props").alias("form"),
        F.col("ts").cast("timestamp").alias("date_created"), "drop",
    )
    batch = FL.flag_rows(FL.delivered_in_time(deliveries, J.LATE_MS), J.FLAG_MARKER)
    stream = J.q_flag_stream_late(spark, SF_SMALL).select(*batch.columns)
    got = sorted(map(tuple, stream.collect()))
    assert got == sorted(map(tuple, batch.collect()))
    n = events.count()
    assert deliveries.count() > n > len(got) > 0.85 * n and len({r[0] for r in got}) == len(got)


def test_what_is_late(spark):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [(1, t(0), 0), (2, t(100), 0), (1, t(0), 1), (3, t(90), 1), (4, t(89.9995), 1), (5, t(90.001), 1), (6, t(200), 1), (7, t(150), 2), (8, t(195), 2), (8, t(195), 3)]
    df = spark.createDataFrame([(i, i, "x", at, d) for i, at, d in rows], "id bigint, form_id bigint, form string, date_created timestamp, drop int")
    out = FL.delivered_in_time(df, 10_000)
    assert out.columns == ["id", "form_id", "form", "date_created"]
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 5, 6, 8]


def test_pages_of_a_large_object(spark):
    """An object with thousands of grantees spreads over pages; none holds more than its rows."""
    rng = random.Random(3)
    pairs = [("big", f"g{i:05d}") for i in range(5000)] + [("small", "b"), ("small", "a"), (None, "n")]
    rng.shuffle(pairs)
    pages = A.list_missing_pages(spark.createDataFrame(pairs, "object string, grantee string").repartition(8), page_rows=64)
    got = {(r["object"], r["page"]): r for r in pages.collect()}
    assert len(got) == 79 + 2 and got["big", 79]["n_missing"] == 8 and got["small", 1]["missing_grantees"] == "a, b"
    listed = [g for p in range(1, 80) for g in got["big", p]["missing_grantees"].split(", ")]
    assert listed == sorted(g for o, g in pairs if o == "big")
