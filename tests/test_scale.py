"""Skew: one account with a third of all transactions."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.plans import retention as RP

SF = "/root/testdata/sf0.01"


def test_hot_account_is_absorbed_by_the_monthly_aggregate(spark):
    inp, prm = RP.fixture_inputs(spark, SF), RP.fixture_params()
    hot = F.when(F.col("form_id") % 3 == 0, F.lit(1)).otherwise(F.col("account_id"))
    inp.transactions = inp.transactions.withColumn("account_id", hot)

    kept = inp.transactions.where("status = 6")
    share = kept.where("account_id = 1").count() / kept.count()
    assert share > 0.3  # a raw partitioning by account would put >30% in one task

    dense = RP._dense(RP.monthly_totals(inp, prm), prm)
    per_part = [r["count"] for r in dense.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    mean = sum(per_part) / len(per_part)
    # after the partial + final aggregate the hot account is products x groups x months rows
    assert max(per_part) < 1.6 * mean, per_part
    hot_rows = dense.where("account_id = 1").count()
    assert hot_rows < 0.1 * sum(per_part)


def test_hot_account_report_is_complete(spark):
    """The skewed input still yields one report row per series-month."""
    inp, prm = RP.fixture_inputs(spark, SF), RP.fixture_params()
    hot = F.when(F.col("form_id") % 3 == 0, F.lit(1)).otherwise(F.col("account_id"))
    inp.transactions = inp.transactions.withColumn("account_id", hot)
    rep = RP.retention_report(inp, prm)
    keys = ["account_id", "product", "gateway_group", "date"]
    assert rep.groupBy(*keys).count().where("count > 1").count() == 0
    assert rep.count() == RP._dense(RP.monthly_totals(inp, prm), prm).count()


def test_an_account_with_thousands_of_products_spreads(spark):
    """Windows are partitioned by (account, product), so one marketplace account is not one task."""
    inp, prm = RP.fixture_inputs(spark, SF), RP.fixture_params()
    inp.transactions = inp.transactions.withColumn("account_id", F.least("account_id", F.lit(0)))
    inp.forms = inp.forms.withColumn("product", F.concat(F.lit("p"), F.col("id").cast("string")))
    dense = RP._dense(RP.monthly_totals(inp, prm), prm)
    per_part = [r["count"] for r in dense.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(per_part) >= 6 and max(per_part) < 1.6 * sum(per_part) / len(per_part), per_part


def test_the_days_of_few_users_spread(spark):
    """A short row a user becomes a row a day and group: neither that step nor its pairs stay in one task."""
    from ledgerlens.plans import jobs as J

    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d) for d in (0, 2, 40)]
    rows = [(u, days[i], ("click", "error", "view")[(u + i) % 3]) for u in range(60) for i in range(3)]
    events = spark.createDataFrame([*rows, *rows], "user_id long, ts timestamp, event_type string")
    states = J._grant_states(events)
    per_part = [r["count"] for r in states.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per_part) == 60 * 41 * 5
    assert len(per_part) >= 6 and max(per_part) < 0.3 * sum(per_part), per_part
    counts = {r["state"]: r["count"] for r in states.groupBy("state").count().collect()}
    # three days a user are there; a click or view grants its group, an error none
    assert counts == {"absent": 60 * 38 * 5, "granted": 120, "missing": 60 * 3 * 5 - 120}
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(8), REPARTITION_BY_NUM" in plan
