"""Physical-plan shape and the full oracle comparison at sf0.001."""

import contextlib
import io
import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(plan: str):
    """(depth, name) of each operator in the formatted plan's tree section."""
    nodes = []
    for line in plan.split("\n\n")[0].splitlines():
        m = re.match(r"^([\s:+\-]*)(?:\* )?([A-Z][A-Za-z ]+?) \(\d+\)", line)
        if m:
            nodes.append((len(m.group(1)), m.group(2).strip()))
    return nodes


def main_line_exchanges(nodes):
    """Shuffle exchanges that are not inside a broadcast subtree."""
    out, stack = [], []
    for depth, name in nodes:
        while stack and stack[-1][0] >= depth:
            stack.pop()
        inside_broadcast = any(n == "BroadcastExchange" for _, n in stack)
        if name == "Exchange" and not inside_broadcast:
            out.append(depth)
        stack.append((depth, name))
    return out


def own_names():
    """The queries of this library without the optional subpackage's."""
    return [n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n)]


@pytest.fixture(scope="module")
def qs():
    return {n: E.queries()[n] for n in own_names()}


def test_no_nested_loops_or_python(spark, qs):
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
              "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
    for name, q in qs.items():
        if name.startswith("flag_stream"):
            continue
        plan = formatted(q(spark, SF_SMALL))
        for b in banned:
            assert b not in plan, f"{name} uses {b}"


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_AQE = {"spark.sql.adaptive.enabled": "false"}
NO_BROADCAST = {**NO_AQE, "spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_number_of_windows(spark, qs):
    with settings(spark, **NO_AQE):
        nodes = tree(formatted(qs["retention_report"](spark, SF_SMALL)))
    # densify lead + 3 horizon layers + the running sum's value in December (over the same sort)
    # + product sums + later activity (with the band maximum)
    windows = sum(1 for _, n in nodes if n == "Window")
    assert 6 <= windows <= 8, windows


def test_raw_rows_meet_no_dimension(spark, qs):
    """Without broadcasts: raw rows are summed by (account, form, gateway, currency, day) behind a partial
    aggregate before any dimension is joined, and the monthly grain has an exchange of its own."""
    with settings(spark, **NO_BROADCAST):
        df = qs["priced_monthly_totals"](spark, SF_SMALL)
        plan = formatted(df)
        path = path_to_table(plan, "lineitem")
    aggregates = [i for i, n in enumerate(path) if n == "HashAggregate"]
    assert len(aggregates) == 4, path  # monthly final and partial, daily final and partial
    assert path[aggregates[0]:aggregates[1]].count("Exchange") == 1, path
    joined = lambda part: sum(n.startswith("SortMergeJoin") for n in part)
    assert joined(path[aggregates[1]:aggregates[2]]) == 3, path  # form, gateway, day rate: on daily sums
    assert path[aggregates[2]:aggregates[3]].count("Exchange") == 1, path
    raw = path[aggregates[3]:]
    assert joined(raw) == 1, path  # the fixture's own join of lines and orders
    for m in re.finditer(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\((form_id|gateway_id|currency|gateway_group)", plan):
        assert not re.search(r"\bamount|transaction_type|l_extendedprice|_added", m.group(1)), m.group(0)


def test_no_job_runs_before_the_action(spark, qs):
    tracker = spark.sparkContext.statusTracker()
    for name in ("retention_report", "priced_monthly_totals", "missing_grants", "audit_summary"):
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        qs[name](spark, SF_SMALL)
        assert not tracker.getJobIdsForGroup(f"plan-{name}"), name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_filters_and_columns_reach_the_scan(spark, qs):
    plan = formatted(qs["flag_increment"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_id), LessThanOrEqual(event_id" in plan or \
        "LessThanOrEqual(event_id" in plan
    plan = formatted(qs["priced_monthly_totals"](spark, SF_SMALL))
    # lineitem is read with only the columns the pricing needs
    m = re.search(r"Scan parquet .*?lineitem.*?ReadSchema: struct<([^>]*)>", plan, re.S)
    assert m and "l_comment" not in m.group(1) and "l_quantity" not in m.group(1)
    # the status filter reaches the scan of the orders
    assert re.search(r"PushedFilters: \[[^\n]*EqualTo\(o_orderstatus,F\)", plan)


def test_all_queries_match_oracle_small(spark):
    res = compare(spark, SF_SMALL, own_names(), verbose=False)
    bad = {k: v for k, v in res.items() if v.get("match") is False}
    assert not bad, bad
    assert all(v["spark_rows"] >= 0 for v in res.values())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "horizon", "status", "n_rows"]
    assert df.count() > 0


def test_partition_count_does_not_change_results(spark, qs):
    a = qs["status_counts"](spark, SF_SMALL).collect()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = qs["status_counts"](spark, SF_SMALL).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def path_to_table(plan: str, table: str):
    """Operator names from the root down to the scan of ``table``."""
    head, _, details = plan.partition("\n\n")
    ids = {}
    for m in re.finditer(r"^\((\d+)\) Scan parquet.*?Location: [^\n]*?/" + table + r"\.parquet", details, re.M | re.S):
        ids[int(m.group(1))] = True
    nodes = []  # (depth, name, id)
    for line in head.splitlines():
        m = re.match(r"^([\s:+\-]*)(?:\* )?([A-Z][A-Za-z ]+?) \((\d+)\)", line)
        if m:
            nodes.append((len(m.group(1)), m.group(2).strip(), int(m.group(3))))
    for i, (depth, name, nid) in enumerate(nodes):
        if name == "Scan parquet" and nid in ids:
            path, d = [name], depth
            for depth2, name2, _ in reversed(nodes[:i]):
                if depth2 < d:
                    path.append(name2)
                    d = depth2
            return list(reversed(path))
    raise AssertionError(f"no scan of {table}")


@pytest.mark.parametrize("conf", [NO_AQE, NO_BROADCAST])
def test_windows_reuse_one_partitioning(spark, qs, conf):
    """With and without broadcasts, under Spark's default settings, nothing between the root
    and the windows shuffles the dense frame again."""
    with settings(spark, **conf, **{"spark.sql.requireAllClusterKeysForCoPartition": "true"}):
        path = path_to_table(formatted(qs["retention_report"](spark, SF_SMALL)), "lineitem")
    deepest_window = max(i for i, n in enumerate(path) if n == "Window")
    assert "Exchange" not in path[:deepest_window], path


def test_grants_read_events_few_times(spark, qs):
    plan = formatted(qs["missing_grants"](spark, SF_SMALL)).split("\n\n")[0]
    assert len(re.findall(r"Scan parquet", plan)) <= 10, plan


def test_the_report_keeps_the_partitions_of_its_windows(spark, qs):
    """Behind joins by (account, product) Spark drops an exchange by the same keys and AQE joins the partitions by
    their bytes before the months are spread: the given number must stand below these joins."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        df = qs["retention_report"](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(account_id#\w+, product#\w+, 32\), REPARTITION_BY_NUM", plan)
        parts = df.groupBy(F.spark_partition_id().alias("p")).count().count()
    assert parts >= 16, parts  # 60 keys
