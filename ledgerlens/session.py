"""Spark session helpers.

Library functions never create a session; they take DataFrames.  ``build_session``
is for tests, the bench and local runs.  ``recommended_conf`` lists the SQL
settings the plans are written against; on a cluster put them in the job conf.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

# SQL settings the operators assume (all are public Spark confs).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def recommended_conf() -> dict[str, str]:
    return dict(RECOMMENDED_CONF)


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "ledgerlens",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session: UI off, UTC, ANSI, AQE."""
    master = master or os.environ.get("LEDGERLENS_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a local
    master gets a fresh scratch folder; on a cluster, whose executors do not
    share local folders, that is an error.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{sub}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``shared_dir`` and read back: later jobs reread the
    files, also after executors are lost."""
    path = shared_dir(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, times: int = 1, buckets: int = 1) -> DataFrame:
    """``df`` dealt to ``times`` as many partitions as the session's shuffles have, by ``keys`` or evenly.

    For rows that multiply or widen later in the same stage: AQE joins partitions by the bytes a shuffle has
    now, and would leave few tasks for them.  A given number of partitions is kept, unless the rows
    below are already dealt by the same keys: Spark then drops the exchange, and AQE sizes the one below.

    With ``buckets`` the number is raised to a multiple of it, or to a divisor where there are more buckets: a
    bucket that is the rest of the same ``hash`` of the keys then lies in partitions of its own, or whole in one."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * times
    n = -(-n // buckets) * buckets if n >= buckets else next(k for k in range(n, buckets + 1) if buckets % k == 0)
    return df.repartition(n, *keys)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="ledgerlens-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))  # served to the executors by the driver
