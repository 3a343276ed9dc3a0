"""Guards for dimension inputs.

Joins carry no broadcast hints: Spark decides by size statistics and, under
AQE, by the bytes a finished shuffle really has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (``n_rows``).

    An empty result means that a left join on ``keys`` cannot fan out.
    Partial + final aggregate; only duplicates come back."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def unique_rows(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df`` for a left join on ``keys``, which must be unique.

    A key that occurs twice would multiply the amounts of the rows that meet
    it, so reading any other column of such a row stops the job with the name
    ``what``.  The check is part of the plan: one aggregate of the
    dimension, no job of its own.  Rows with a NULL key match nothing and are
    left out."""
    values = [c for c in df.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = df.where(known).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*values)).alias("_v")
    )
    twice = F.concat_ws(" ", F.lit(f"{what}: a key occurs more than once:"), *[F.col(k).cast("string") for k in keys])
    return rows.select(
        *keys,
        *[F.when(F.col("_n") == 1, F.col(f"_v.{c}")).otherwise(F.raise_error(twice)).alias(c) for c in values],
    )
