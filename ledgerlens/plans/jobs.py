"""Query plans for the data jobs around the report (C1-C3, C12, X1, C13-C15),
each over views of the driver's test tables (FIXTURES.md section 2)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import audits as A
from ..operators import flaglog as FL
from ..operators import landing as LD
from ..operators import ordering as OR
from ..operators import rates as RT
from ..session import dealt, shared_dir
from ..sources import fixtures as FX
from ..sources import io

GAP_START = dt.date(1995, 1, 1)
GAP_END = dt.date(2001, 8, 1)
FLAG_MARKER = '"k": 7'
EVENTS_AS_OF = "2024-02-01 00:00:00"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
AUDIT_PROJECTS = ["click", "purchase", "signup", "view"]


# ---------------------------------------------------------------- C1 / C2

def q_missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without an order, per order priority and status."""
    keys = ["o_orderpriority", "o_orderstatus"]
    o = FX.Tables(spark, sf_dir)("orders").select(*keys, "o_orderdate")
    return RT.missing_dates(o, "o_orderdate", GAP_START, GAP_END, keys=keys)


def q_missing_months_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months without an order, per customer (the scale form of C1)."""
    o = FX.Tables(spark, sf_dir)("orders").select("o_custkey", "o_orderdate")
    return RT.missing_dates(o, "o_orderdate", GAP_START, GAP_END, keys=["o_custkey"], unit="month")


def q_missing_days_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without any order at all (the key-less form of the original job)."""
    o = FX.Tables(spark, sf_dir)("orders").select("o_orderdate")
    return RT.missing_dates(o, "o_orderdate", GAP_START, GAP_END)


def rate_payloads(t: FX.Tables, keep_status: bool = False) -> DataFrame:
    """Landed payloads from the orders: one per (day, order status), a map from
    currency (the priority's digit) to a quote that follows the orders' keys, so
    one day's payloads can disagree.  Some quotes are zero or NULL."""
    o = t("orders").where(F.col("o_orderdate").isNotNull())
    top = F.max("o_orderkey")
    quote = (
        F.when(top % 41 == 0, F.lit(None).cast("double"))
        .when(top % 37 == 0, F.lit(0.0))
        .otherwise((top % 16 + 1) / F.lit(8.0))
    )
    quotes = o.groupBy(
        F.to_date("o_orderdate").alias("date"), "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("currency")
    ).agg(quote.alias("quoted"))
    # at most five priorities a payload
    return quotes.groupBy("date", "o_orderstatus").agg(
        F.map_from_entries(F.collect_list(F.struct("currency", "quoted"))).alias("rates")
    ).select("date", "rates", *(["o_orderstatus"] if keep_status else []))


def known_rates(t: FX.Tables) -> DataFrame:
    """The rate table so far: the (day, currency) of orders with a key divisible by 3."""
    o = t("orders").where("o_orderdate IS NOT NULL AND o_orderkey % 3 = 0")
    return o.select(
        F.to_date("o_orderdate").alias("date"), F.substring("o_orderpriority", 1, 1).alias("currency"), F.lit(1.0).alias("rate")
    ).distinct()


def _rates_ingest(spark: SparkSession, sf_dir: str):
    t = FX.Tables(spark, sf_dir)
    return RT.ingest_rates(rate_payloads(t), known_rates(t))


def q_rates_ingest(spark, sf_dir):
    return _rates_ingest(spark, sf_dir)[0]


def q_rates_rejects(spark, sf_dir):
    return _rates_ingest(spark, sf_dir)[1].select("date", "currency", "reason")


def q_rates_append(spark, sf_dir):
    """The rate table after three refreshes: with the payloads of the filled orders, with
    all payloads, and with all again (which adds nothing)."""
    from . import refresh

    t = FX.Tables(spark, sf_dir)
    target = shared_dir(spark, f"rates_append/{uuid.uuid4().hex}")
    rates = rate_payloads(t, keep_status=True)
    for payloads in (rates.where("o_orderstatus = 'F'"), rates, rates):
        refresh.refresh_rates(spark, payloads.select("date", "rates"), target)
    return refresh.read_rates(spark, target)


# ---------------------------------------------------------------- C3

def landing_raw(t: FX.Tables, *keep: str) -> DataFrame:
    """Orders as landed sheet rows (all text) with blank rows, missing ids,
    ``123.0`` ids, non-numeric ids, days in five layouts and unparsable ones."""
    o = t("orders")
    k = F.col("o_orderkey")
    blank = k % 101 == 0
    date_txt = (
        F.when(k % 53 == 0, F.lit("not a date"))
        .when(k % 7 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(k % 11 == 0, F.date_format("o_orderdate", "M/d/yyyy"))
        .when(k % 13 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00")))
        .when(k % 17 == 0, F.concat(F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" 10:00")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    cust = F.col("o_custkey").cast("string")
    acct_txt = (
        F.when(k % 37 == 0, F.lit(None).cast("string"))
        .when(k % 211 == 0, F.lit("abc"))
        .when(k % 5 == 0, F.concat(cust, F.lit(".0")))
        .otherwise(cust)
    )
    values = [date_txt, acct_txt, F.col("o_orderpriority"), F.col("o_totalprice").cast("string"), F.col("o_orderstatus")]
    return o.select(
        *keep,
        *[F.when(blank, F.lit(None).cast("string")).otherwise(v).alias(name) for name, v in zip(LD.DEFAULT_MAPPING, values, strict=True)],
    )


def q_landing_clean(spark, sf_dir):
    return LD.clean_landing(landing_raw(FX.Tables(spark, sf_dir)))[0]


def q_landing_rejects(spark, sf_dir):
    rej = LD.clean_landing(landing_raw(FX.Tables(spark, sf_dir)))[1]
    return rej.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def q_landing_files(spark, sf_dir):
    """The same rows landed as CSV files under three headers (other orders of the columns, one more
    column), read by one scan and cleaned."""
    names = list(LD.DEFAULT_MAPPING)
    raw = landing_raw(FX.Tables(spark, sf_dir), "o_orderkey")
    land = shared_dir(spark, f"landing_files/{uuid.uuid4().hex}")
    for i, columns in enumerate((names, names[::-1], ["o_orderkey", *names[2:], *names[:2]])):
        raw.where(F.col("o_orderkey") % 3 == i).select(*[F.col(f"`{c}`") for c in columns]).write.option("header", "true").csv(f"{land}/drop{i}")
    return LD.clean_landing(io.read_landing(spark, land))[0]


#: Ways to write a day: by date_format pattern, the month before the day, behind it or by name.
DAY_LAYOUTS = (
    "yyyy-MM-dd", "dd/MM/yyyy", "d.M.yyyy", "yyyyMMdd", "MM-dd-yy", "d MMM yyyy", "MMMM d, yyyy", "EEE, d MMM yyyy",
    "yyyy.M.d", "dd-MMM-yy", "MM/dd/yyyy hh:mm a", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy/dd/MM", "M d yyyy",
)


def q_landing_dates(spark, sf_dir):
    """the order dates written in fourteen layouts, by the order's key, and read again."""
    o = FX.Tables(spark, sf_dir)("orders").select("o_orderkey", "o_orderdate")
    layout = F.col("o_orderkey") % len(DAY_LAYOUTS)
    text = F.lit(None).cast("string")
    for i, pattern in enumerate(DAY_LAYOUTS):
        text = F.when(layout == i, F.date_format("o_orderdate", pattern)).otherwise(text)
    return o.select("o_orderkey", LD.parse_date(text).alias("day"))


# ---------------------------------------------------------------- C12 / X1

def published_versions(t: FX.Tables) -> DataFrame:
    return t("events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("form_id"),
        F.col("props").alias("form"),
        F.col("ts").alias("date_created"),
    )


def q_flag_full(spark, sf_dir):
    return FL.flag_log_full(published_versions(FX.Tables(spark, sf_dir)), FLAG_MARKER)


def q_flag_increment(spark, sf_dir):
    """Initial load of the lower half of the ids, then the watermark
    increment; the union is the log after two runs (= the full rebuild)."""
    v = published_versions(FX.Tables(spark, sf_dir))
    half = (FL.high_watermark(v) or 0) // 2
    _, initial = FL.flag_log_increment(v.where(F.col("id") <= half), None, FLAG_MARKER)
    mode, new = FL.flag_log_increment(v, initial, FLAG_MARKER)
    # a rebuild (the first load held no id above 0) replaces the log
    return initial.unionByName(new) if mode == "append" else new


EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def q_flag_stream(spark, sf_dir):
    """The events table, a file or a folder of part files, as the source of a file
    stream; run until caught up, then read the sink (under the session's
    checkpoint dir)."""
    from ..streaming.flag_log import start_flag_stream

    run = shared_dir(spark, f"flag_stream/{uuid.uuid4().hex}")
    q = start_flag_stream(
        spark, f"{sf_dir.rstrip('/')}/events.parquet", EVENTS_SCHEMA, f"{run}/sink", f"{run}/checkpoint",
        marker=FLAG_MARKER,
        rename={"event_id": "id", "user_id": "form_id", "props": "form", "ts": "date_created"},
    )
    q.awaitTermination()
    return spark.read.parquet(f"{run}/sink")


def q_missing_days_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the days without any order, latest first, with their place."""
    return OR.with_position(q_missing_days_any(spark, sf_dir), F.col("missing_date").desc())


#: The watermark's delay in the late stream.
LATE_MS = 86_400_000
LATE_DROPS = 4


def late_deliveries(events: DataFrame) -> DataFrame:
    """The events as deliveries in drops: a drop brings the next stretch of event time, a third of the events of the
    drop before once more, and one in eleven of these for the first time."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    low, span = ends["low"] or 0, (ends["high"] or 0) - (ends["low"] or 0) + 1
    own = F.expr("least({1}, (unix_micros(cast(ts as timestamp)) - {0}L) * {2} div {3}L)".format(low, LATE_DROPS - 1, LATE_DROPS, span))
    held = F.col("event_id") % 11 == 0
    again = (F.col("event_id") % 3 == 0) & ~held & (own < LATE_DROPS - 1)
    drops = F.when(held, F.array(F.least(own + 1, F.lit(LATE_DROPS - 1)))).when(again, F.array(own, own + 1)).otherwise(F.array(own))
    return events.withColumn("drop", F.explode(drops))


def q_flag_stream_late(spark, sf_dir):
    """X1 with late and repeated versions: each drop lands as files, the stream starts again from its checkpoint,
    catches up and stops; then the sink is read.  Equal to ``flaglog.delivered_in_time``."""
    from ..streaming.flag_log import start_flag_stream

    run = shared_dir(spark, f"flag_stream_late/{uuid.uuid4().hex}")
    names = [f.name for f in EVENTS_SCHEMA.fields]
    events = FX.Tables(spark, sf_dir)("events").select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENTS_SCHEMA.fields])
    deliveries = late_deliveries(events)
    for drop in range(LATE_DROPS):
        deliveries.where(F.col("drop") == drop).select(*names).write.parquet(f"{run}/source/drop{drop}")
        q = start_flag_stream(
            spark, f"{run}/source", EVENTS_SCHEMA, f"{run}/sink", f"{run}/checkpoint", marker=FLAG_MARKER,
            rename={"event_id": "id", "user_id": "form_id", "props": "form", "ts": "date_created"},
            dedupe_within=f"{LATE_MS} milliseconds",
        )
        q.awaitTermination()
    return spark.read.parquet(f"{run}/sink")


# ---------------------------------------------------------------- C13-C15

def _events(spark, sf_dir) -> DataFrame:
    return FX.Tables(spark, sf_dir)("events")


def extract_inventory(events: DataFrame) -> DataFrame:
    """One object per (user, event type): last event time, has_extracts when
    the pair has more than one event."""
    return events.groupBy("user_id", "event_type").agg(
        F.max("ts").alias("updated_at"), F.count(F.lit(1)).alias("_n")
    ).select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("project"),
        "updated_at",
        (F.col("_n") > 1).alias("has_extracts"),
    )


def q_freshness(spark, sf_dir):
    inv = extract_inventory(_events(spark, sf_dir))
    as_of = dt.datetime.fromisoformat(EVENTS_AS_OF)
    return A.freshness_audit(inv, as_of, projects=AUDIT_PROJECTS)


def q_freshness_ordered(spark, sf_dir):
    """O2: the stale extracts, oldest first, then by name and project, with their place."""
    inv = extract_inventory(_events(spark, sf_dir))
    stale = A.freshness_audit(inv, dt.datetime.fromisoformat(EVENTS_AS_OF), projects=AUDIT_PROJECTS, ordered=False)
    return OR.with_position(stale, F.col("days_since_refresh").desc(), F.col("extract").asc(), F.col("project").asc())


def _grant_states(events: DataFrame) -> DataFrame:
    """Objects are a user's days.  Each day from a user's first to last is expected to be
    granted to all groups; it is in the inventory when it has an event; an event grants
    its type's group, but an ``error`` event only a single user."""
    day = F.to_date("ts")
    name = A.object_name("_day", "_user")
    named = lambda df: df.select("*", name.alias("object"))
    user = F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("_user")
    # one short row a user becomes a row a day and group: dealt evenly before that
    spans = dealt(events.groupBy("user_id").agg(F.min(day).alias("d0"), F.max(day).alias("d1")))
    days = F.transform(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY")), lambda d: d.cast("string"))
    expected = named(spans.select(user, F.explode(days).alias("_day"))).select("object", F.explode(F.array(*[F.lit(e) for e in EVENT_TYPES])).alias("grantee"))
    groups = events.select(F.upper("event_type").alias("id"), F.col("event_type").alias("name")).distinct()
    seen = named(events.select(user, day.cast("string").alias("_day"), "event_type"))
    grants = seen.select(
        "object",
        F.when(F.col("event_type") == "error", F.lit("user")).otherwise(F.lit("group")).alias("grantee_type"),
        F.upper("event_type").alias("grantee_id"),
    )
    return A.expected_grants(expected, A.group_grants(grants, groups), seen.select("object"))


def q_missing_grants(spark, sf_dir):
    return A.missing_grants(_grant_states(_events(spark, sf_dir)))


def q_missing_grants_listed(spark, sf_dir):
    return A.list_missing(A.missing_grants(_grant_states(_events(spark, sf_dir))))


def q_missing_grants_paged(spark, sf_dir):
    """The missing grants in pages of two per object."""
    return A.list_missing_pages(A.missing_grants(_grant_states(_events(spark, sf_dir))), page_rows=2)


def q_absent_objects(spark, sf_dir):
    return A.absent_objects(_grant_states(_events(spark, sf_dir)))


def _outside_window(spark, sf_dir, ordered: bool) -> DataFrame:
    ev = _events(spark, sf_dir)
    ds_id = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"))
    datasources = ev.select("user_id", "event_type").distinct().select(
        ds_id.alias("id"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("project"),
    )
    tasks = ev.select(
        ds_id.alias("datasource_id"), F.col("ts").alias("start_at"),
        (F.col("value") >= 1.0).alias("daily"),
    )
    return A.schedule_window_audit(tasks, datasources, projects=AUDIT_PROJECTS, ordered=ordered)


def q_schedule_outside_window(spark, sf_dir):
    return _outside_window(spark, sf_dir, ordered=True)


def q_schedule_ordered(spark, sf_dir):
    """O3: the tasks outside the window by lower-cased name, then by project, time and
    flag, with their place."""
    out = _outside_window(spark, sf_dir, ordered=False)
    keys = [F.lower("datasource_name"), F.col("project_name"), F.col("start_time"), F.col("refreshed_daily"), F.col("datasource_name")]
    return OR.with_position(out, *[k.asc_nulls_first() for k in keys])


def q_audit_summary(spark, sf_dir):
    """Counts of the three audits (stale extracts, objects missing grants,
    absent objects, tasks outside the window), unordered variants."""
    ev = _events(spark, sf_dir)
    as_of = dt.datetime.fromisoformat(EVENTS_AS_OF)
    stale = A.freshness_audit(extract_inventory(ev), as_of, projects=AUDIT_PROJECTS, ordered=False)
    outside = _outside_window(spark, sf_dir, ordered=False)
    # both counts of the grant audit come from one pass over its states
    counts = _grant_states(ev).agg(
        F.count(F.when(F.col("state") == "missing", 1)).alias("missing_grants"),
        F.count_distinct(F.when(F.col("state") == "absent", F.col("object"))).alias("absent_objects"),
    ).select(F.expr("stack(2, 'missing_grants', missing_grants, 'absent_objects', absent_objects) AS (audit, n_rows)"))
    return A.audit_summary(stale_extracts=stale, outside_window=outside).unionByName(counts)


JOB_QUERIES = {
    "missing_dates": q_missing_dates,
    "missing_months_by_customer": q_missing_months_by_customer,
    "missing_days_any": q_missing_days_any,
    "missing_days_ordered": q_missing_days_ordered,
    "rates_ingest": q_rates_ingest,
    "rates_rejects": q_rates_rejects,
    "rates_append": q_rates_append,
    "landing_clean": q_landing_clean,
    "landing_rejects": q_landing_rejects,
    "landing_files": q_landing_files,
    "landing_dates": q_landing_dates,
    "flag_full": q_flag_full,
    "flag_increment": q_flag_increment,
    "flag_stream": q_flag_stream,
    "flag_stream_late": q_flag_stream_late,
    "freshness": q_freshness,
    "freshness_ordered": q_freshness_ordered,
    "missing_grants": q_missing_grants,
    "missing_grants_listed": q_missing_grants_listed,
    "missing_grants_paged": q_missing_grants_paged,
    "absent_objects": q_absent_objects,
    "schedule_outside_window": q_schedule_outside_window,
    "schedule_ordered": q_schedule_ordered,
    "audit_summary": q_audit_summary,
}
