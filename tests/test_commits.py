"""Lists of folders published one after another; rates appended once; the report refreshed by keys."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.plans import incremental as INC
from ledgerlens.plans import refresh
from ledgerlens.plans import retention as RP
from ledgerlens.session import dealt
from ledgerlens.sources import commits, io
from ledgerlens.sources import fixtures as FX

ROWS = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
SMALL = "/root/testdata/sf0.001"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROWS)


def held(spark, target):
    return sorted((r.k, r.v) for r in commits.read(spark, target, ROWS).collect())


def test_append_and_replace(spark, scratch):
    target = f"{scratch}/t"
    assert held(spark, target) == []
    one = commits.append(rows(spark, (1, "a")), target, commits.current(spark, target))
    two = commits.append(rows(spark, (2, "b")), target, one)
    assert held(spark, target) == [(1, "a"), (2, "b")] and commits.current(spark, target) == two
    # parts by a column: touched ones are replaced, a touched one without rows is gone, others stay
    base = commits.replace(rows(spark, (1, "a"), (2, "b"), (3, "c")), f"{scratch}/p", commits.Version(), "k", [])
    commits.replace(rows(spark, (1, "x")), f"{scratch}/p", base, "k", [1, 2])
    got = sorted(r.v for r in commits.read(spark, f"{scratch}/p", T.StructType([ROWS["v"]])).collect())
    assert got == ["c", "x"]


def test_a_stopped_run_is_not_seen(spark, scratch):
    target = f"{scratch}/t"
    base = commits.append(rows(spark, (1, "a")), target, commits.Version())
    rows(spark, (9, "lost")).write.parquet(f"{target}/{commits.new_folder()}")  # stopped before it published
    assert held(spark, target) == [(1, "a")]
    commits.append(rows(spark, (2, "b")), target, base)
    assert held(spark, target) == [(1, "a"), (2, "b")]


def test_the_second_of_two_runs_is_refused(spark, scratch):
    target = f"{scratch}/t"
    base = commits.append(rows(spark, (1, "a")), target, commits.Version())
    commits.append(rows(spark, (2, "b")), target, base)
    with pytest.raises(commits.Refused):
        commits.append(rows(spark, (2, "b")), target, base)
    assert held(spark, target) == [(1, "a"), (2, "b")]
    assert not [f for f in os.listdir(f"{target}/_lists") if f.startswith(".") and not f.endswith(".crc")]


def test_a_plain_table_is_taken_over(spark, scratch):
    target = f"{scratch}/t"
    rows(spark, (1, "a")).write.parquet(target)
    commits.append(rows(spark, (2, "b")), target, commits.current(spark, target))
    assert held(spark, target) == [(1, "a"), (2, "b")]


def payloads(spark, *days):
    return spark.createDataFrame([(dt.date(2020, 1, d), {"EUR": 0.5, "GBP": float(d)}) for d in days], "date date, rates map<string,double>")


def test_rates_of_two_runs_at_once_are_appended_once(spark, scratch, monkeypatch):
    """A whole refresh publishes between this run's check of the keys and its own append."""
    target, other = f"{scratch}/rates", []
    plain = commits.append

    def late(df, target, base):
        if not other:
            other.append("ran")
            other.append(refresh.refresh_rates(spark, payloads(spark, 1, 2), target))
        return plain(df, target, base)

    monkeypatch.setattr(commits, "append", late)
    assert refresh.refresh_rates(spark, payloads(spark, 2, 3), target) == {"appended": 2, "rejected": 0}
    assert other[1]["appended"] == 4
    got = sorted((r.date.day, r.currency) for r in refresh.read_rates(spark, target).collect())
    assert got == [(d, c) for d in (1, 2, 3) for c in ("EUR", "GBP")]


def test_a_repeated_run_after_a_stop_appends_once(spark, scratch, monkeypatch):
    target = f"{scratch}/rates"
    with monkeypatch.context() as m:
        m.setattr(commits, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            refresh.refresh_rates(spark, payloads(spark, 1), target)
    assert refresh.read_rates(spark, target).count() == 0
    assert refresh.refresh_rates(spark, payloads(spark, 1), target)["appended"] == 2
    assert refresh.refresh_rates(spark, payloads(spark, 1), target)["appended"] == 0
    assert refresh.read_rates(spark, target).schema == io.RATES_SCHEMA


# ---------------------------------------------------------------- the report by keys

def report(df):
    return sorted(str(r) for r in df.collect())


def some(spark, early):
    """The inputs with the transactions of some orders."""
    t = FX.Tables(spark, SMALL)
    return replace(RP.fixture_inputs(spark, SMALL), transactions=FX.dim_transaction(t, orders=early))


def test_a_refresh_equals_a_rebuild_and_leaves_other_buckets(spark, scratch):
    prm, target = RP.fixture_params(), f"{scratch}/report"
    all_inputs = some(spark, None)
    late = F.col("o_orderkey") % 50 == 7
    changed = some(spark, late).transactions.select("account_id", "form_id")
    assert INC.refresh_report(spark, some(spark, ~late), prm, target, buckets=97)["mode"] == "full"
    first = commits.current(spark, target)
    out = INC.refresh_report(spark, all_inputs, prm, target, changed, buckets=97)
    second = commits.current(spark, target)
    assert out["mode"] == "increment" and 0 < out["buckets"] < 97
    whole = RP.retention_report(all_inputs, prm)
    assert report(INC.read_report(spark, target, whole.schema)) == report(whole)
    same = [n for n in first.parts if second.parts.get(n) == first.parts[n]]
    touched = {str(r[0]) for r in INC.affected_keys(all_inputs, changed, 97).select(INC.BUCKET).distinct().collect()}
    assert set(same) == set(first.parts) - touched


def test_transactions_that_go_take_their_rows_along(spark, scratch):
    prm, target = RP.fixture_params(), f"{scratch}/report"
    all_inputs = some(spark, None)
    one = all_inputs.transactions.where("status = 6").select("account_id", "form_id").orderBy("account_id", "form_id").limit(1)
    account = one.first()["account_id"]
    INC.refresh_report(spark, all_inputs, prm, target, buckets=1000)
    gone = replace(all_inputs, transactions=all_inputs.transactions.where(F.col("account_id") != account))
    changed = all_inputs.transactions.where(F.col("account_id") == account).select("account_id", "form_id")
    INC.refresh_report(spark, gone, prm, target, changed, buckets=1000)
    whole = RP.retention_report(gone, prm)
    assert report(INC.read_report(spark, target, whole.schema)) == report(whole)


def test_keys_with_nulls_are_refreshed(spark, scratch):
    """Transactions without account or with an unknown form are keys of their own."""
    prm, target = RP.fixture_params(), f"{scratch}/report"
    inputs = some(spark, None)
    odd = inputs.transactions.limit(20).select(
        *[F.when(F.col("form_id") % 2 == 0, F.col(c)).cast(inputs.transactions.schema[c].dataType).alias(c) if c == "account_id"
          else (F.lit(-5).cast(inputs.transactions.schema[c].dataType).alias(c) if c == "form_id" else F.col(c)) for c in inputs.transactions.columns]
    ).withColumn("status", F.lit(6))
    odd = spark.createDataFrame(odd.collect(), odd.schema)
    after = replace(inputs, transactions=inputs.transactions.unionByName(odd))
    INC.refresh_report(spark, inputs, prm, target)
    INC.refresh_report(spark, after, prm, target, odd.select("account_id", "form_id"))
    whole = RP.retention_report(after, prm)
    assert report(INC.read_report(spark, target, whole.schema)) == report(whole)


def files_by_bucket(target, version):
    return {p: sum(n.endswith(".parquet") for n in os.listdir(f"{target}/{f}")) for p, f in version.parts.items()}


def test_dealt_by_buckets(spark):
    """A bucket has partitions of its own, or lies whole in one; NULL keys too."""
    keys = spark.createDataFrame([(a, p) for a in [None, *range(300)] for p in ("x", "y", None)], "account_id long, product string")
    rows = keys.withColumn("b", INC.key_bucket(12))
    own = dealt(rows, *INC.KEY, buckets=12).select("b", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r.p for r in own}) == len(own) == 12
    rows = keys.withColumn("b", INC.key_bucket(3))
    own = dealt(rows, *INC.KEY, buckets=3).select("b", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r.p for r in own}) == len(own) == 9  # the least multiple of 3 from 8 on


def test_the_report_is_written_by_the_tasks_of_its_windows(spark, scratch, monkeypatch):
    """Neither the built rows of a bucket nor its copied ones meet in one task; files that pile up are joined again."""
    prm, target = RP.fixture_params(), f"{scratch}/report"
    inputs = some(spark, None)
    early, late = F.col("o_orderkey") % 50 != 7, F.col("o_orderkey") % 50 == 7
    changed = some(spark, late).transactions.select("account_id", "form_id")
    whole = RP.retention_report(inputs, prm)
    INC.refresh_report(spark, some(spark, early), prm, target, buckets=2)
    built = files_by_bucket(target, commits.current(spark, target))
    assert len(built) == 2 and all(3 < n <= 16 for n in built.values()), built  # 32 tasks
    INC.refresh_report(spark, inputs, prm, target, changed, buckets=2)
    copied = files_by_bucket(target, commits.current(spark, target))
    assert report(INC.read_report(spark, target, whole.schema)) == report(whole)
    assert all(n <= 32 + 16 for n in copied.values()), copied
    monkeypatch.setattr(INC, "FILES", 1)
    INC.refresh_report(spark, inputs, prm, target, changed, buckets=2)
    joined = files_by_bucket(target, commits.current(spark, target))
    assert all(n <= 16 + 16 for n in joined.values()), joined
    assert report(INC.read_report(spark, target, whole.schema)) == report(whole)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_the_kept_report_holds_no_decimals(spark, scratch):
    """Amounts are written and copied as longs, built rows and refreshed ones; a report kept with its decimals is read as it is."""
    prm, target = RP.fixture_params(), f"{scratch}/report"
    inputs = some(spark, None)
    whole = RP.retention_report(inputs, prm)
    rows = report(whole)
    commits.replace(whole.withColumn("key_hash_bucket", INC.key_bucket(4)), target, commits.Version(), "key_hash_bucket", [])
    assert report(INC.read_report(spark, target, whole.schema)) == rows
    changed = inputs.transactions.select("account_id", "form_id").limit(5)
    for mode in ("full", "increment"):
        assert INC.refresh_report(spark, inputs, prm, target, changed, buckets=4)["mode"] == mode
        kept = spark.read.parquet(*[f"{target}/{f}" for f in commits.current(spark, target).parts.values()]).schema
        assert not [f.name for f in kept if isinstance(f.dataType, T.DecimalType)]
        read = INC.read_report(spark, target, whole.schema)
        assert report(read) == rows and [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in whole.schema]


def test_a_report_by_other_buckets_is_built_anew(spark, scratch):
    prm, target = RP.fixture_params(), f"{scratch}/report"
    inputs = some(spark, None)
    whole = RP.retention_report(inputs, prm)
    commits.replace(whole.withColumn("key_bucket", F.pmod(F.xxhash64("account_id"), F.lit(4))), target, commits.Version(), "key_bucket", [])
    changed = inputs.transactions.select("account_id", "form_id").limit(5)
    assert INC.refresh_report(spark, inputs, prm, target, changed, buckets=4)["mode"] == "full"
    assert report(INC.read_report(spark, target, whole.schema)) == report(whole)
