"""Freshness, missing grants, schedule-window audits.

They run over inventory tables (one row per object / grant / task) of any
size: filters, one aggregate over tagged inputs, and small per-object aggregates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import floor_days_between, micros_of_day, time_of_day_micros
from ..session import dealt
from .ordering import with_position

# Defaults of the original audits (fixed values).
DEFAULT_OFFSET_HOURS = 7
WINDOW_START = (2, 0, 0)
WINDOW_END = (3, 0, 0)


def object_name(name, project) -> F.Column:
    """``name in project``."""
    return F.concat(F.col(name), F.lit(" in "), F.col(project))


def freshness_audit(
    inventory: DataFrame,
    as_of: dt.datetime,
    offset_hours: int = DEFAULT_OFFSET_HOURS,
    projects: list[str] | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Objects whose last update is one or more whole days old.

    ``inventory``: name, project, updated_at (NULL allowed), has_extracts.
    Age = floor((as_of - offset) - updated_at) in days; a NULL update counts
    as fresh (0).  Output: days_since_refresh, extract, updated_at (date),
    project; oldest first when ``ordered``.
    """
    # wall-clock text read in the session time zone, so the result does not
    # depend on the driver machine's zone
    as_of_txt = as_of.strftime("%Y-%m-%d %H:%M:%S") if isinstance(as_of, dt.datetime) else str(as_of)
    now = F.lit(as_of_txt).cast("timestamp") - F.expr(f"INTERVAL {int(offset_hours)} HOURS")
    df = inventory.where(F.col("has_extracts"))
    if projects is not None:
        df = df.where(F.col("project").isin(*projects))
    days = floor_days_between(now, F.coalesce(F.col("updated_at"), now))
    out = df.select(
        days.alias("days_since_refresh"),
        F.col("name").alias("extract"),
        F.to_date("updated_at").alias("updated_at"),
        "project",
    ).where(F.col("days_since_refresh") > 0)
    return out.orderBy(F.col("days_since_refresh").desc()) if ordered else out


def group_grants(grants: DataFrame, groups: DataFrame) -> DataFrame:
    """(object, grantee_type, grantee_id) -> (object, grantee) for
    group grants, id resolved to the first group with that id."""
    first = groups.groupBy("id").agg(F.min("name").alias("grantee"))
    return (
        grants.where(F.col("grantee_type") == "group")
        .join(first, F.col("grantee_id") == F.col("id"))
        .select("object", "grantee")
    )


def expected_grants(expected: DataFrame, actual: DataFrame, inventory: DataFrame) -> DataFrame:
    """C14: every expected (object, grantee) with its ``state``.

    ``granted``: the object is in ``inventory`` and has the grant; ``missing``: it
    is there without it, whatever other grants it has or lacks; ``absent``: the
    object is not in the inventory.  Presence comes from the inventory alone.
    ``actual`` is (object, grantee), ``inventory`` has a column object.

    Expected and actual pairs are tagged and unioned: one aggregate by (object, grantee).  The
    inventory's objects are joined to its rows, so no other input is read for them.  Repeated grants and
    inventory rows go in partial aggregates first.  Names repeat so much that a shuffle of them
    has few bytes; both exchanges of the pairs are dealt to a given number of tasks, which AQE leaves as it is."""
    flag = lambda e, a: [F.lit(x).alias(n) for n, x in (("_e", e), ("_a", a))]
    tagged = expected.select("object", "grantee", *flag(1, 0)).unionAll(
        actual.select("object", "grantee").distinct().select("object", "grantee", *flag(0, 1))
    )
    pairs = dealt(tagged, "object", "grantee").groupBy("object", "grantee").agg(*[F.max(c).alias(c) for c in ("_e", "_a")])
    wanted = pairs.where("_e = 1").select("object", "grantee", (F.col("_a") == 1).alias("_granted"))
    there = inventory.select("object").distinct().withColumn("_there", F.lit(True))
    state = (
        F.when(F.col("_there").isNull(), F.lit("absent"))
        .when(F.col("_granted"), F.lit("granted"))
        .otherwise(F.lit("missing"))
    )
    return dealt(wanted, "object").join(there, "object", "left").select("object", "grantee", state.alias("state"))


def missing_grants(states: DataFrame) -> DataFrame:
    """The missing (object, grantee) pairs of ``expected_grants``."""
    return states.where(F.col("state") == "missing").select("object", "grantee")


def absent_objects(states: DataFrame) -> DataFrame:
    """The expected objects that are not in the inventory."""
    return states.where(F.col("state") == "absent").select("object").distinct()


def list_missing(missing: DataFrame) -> DataFrame:
    """A view for people: object, n_missing, missing_grantees (sorted, comma joined).

    One text per object, so only for lists of grantees that a person can read."""
    return missing.groupBy("object").agg(
        F.count(F.lit(1)).alias("n_missing"),
        F.array_join(F.array_sort(F.collect_set("grantee")), ", ").alias("missing_grantees"),
    )


def list_missing_pages(missing: DataFrame, page_rows: int = 1000) -> DataFrame:
    """A12 / A14 at any size: object, page (from 1), n_missing, missing_grantees (sorted, comma joined).

    A page holds the next ``page_rows`` grantees of its object in their order, so no list grows with
    the object: places come from one order over all pairs, and an object with a million grantees
    spreads over the tasks like any other rows."""
    placed = with_position(missing.select("object", "grantee"), F.col("object").asc(), F.col("grantee").asc(), name="_at")
    starts = placed.groupBy(F.col("object").alias("_of")).agg(F.min("_at").alias("_first"))
    page = F.floor((F.col("_at") - F.col("_first")) / page_rows) + 1
    return placed.join(starts, F.col("object").eqNullSafe(F.col("_of"))).groupBy("object", page.alias("page")).agg(
        F.count(F.lit(1)).alias("n_missing"),
        F.array_join(F.array_sort(F.collect_list("grantee")), ", ").alias("missing_grantees"),
    )


def schedule_window_audit(
    tasks: DataFrame,
    datasources: DataFrame,
    projects: list[str] | None = None,
    start: tuple[int, int, int] = WINDOW_START,
    end: tuple[int, int, int] = WINDOW_END,
    ordered: bool = True,
) -> DataFrame:
    """Refresh tasks starting outside [start, end] (both inclusive).

    ``tasks``: datasource_id, start_at (timestamp; its time of day is the
    schedule), daily (bool).  ``datasources``: id, name, project.
    Output: datasource_name, project_name, refreshed_daily, start_time,
    in_range; sorted by lower-cased name when ``ordered``.
    """
    ds = datasources.select(
        F.col("id").alias("datasource_id"),
        F.col("name").alias("datasource_name"),
        F.col("project").alias("project_name"),
    )
    df = tasks.join(ds, "datasource_id")
    if projects is not None:
        df = df.where(F.col("project_name").isin(*projects))
    tod = micros_of_day("start_at")
    in_range = tod.between(time_of_day_micros(*start), time_of_day_micros(*end))
    out = df.select(
        "datasource_name", "project_name",
        F.col("daily").alias("refreshed_daily"),
        F.date_format("start_at", "HH:mm:ss.SSSSSS").alias("start_time"),
        in_range.alias("in_range"),
    ).where(~F.col("in_range"))
    return out.orderBy(F.lower("datasource_name")) if ordered else out


def audit_summary(**results: DataFrame) -> DataFrame:
    """One row per audit with its row count (``audit``, ``n_rows``).

    Each count is a partial + final aggregate of that audit; the union of
    single-row results is tiny."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("audit"), "n_rows")
        for name, df in results.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
