"""O1-O3: a global order as a column.

A sorted result loses its order as soon as it is written, joined or hashed, and
a window without partition would put all rows into one task.  Here the rows
are dealt by ranges of the order, numbered inside their range, and each range
adds the rows before it.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

# monotonically_increasing_id: the partition above, the row inside it below
_ROW_BITS = 33


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` with ``name``: 1 for the first row in ``order``, 2 for the next, to the number of rows.

    Rows that tie on the whole of ``order`` get their places in any order, each a place of its own,
    so give an order that is total if the result must not depend on that.  The numbered rows are
    written once to the shared folder: range bounds come from a sample, and a second run of the same plan
    could draw them elsewhere.  One row a range (its size) reaches the driver.  An existing
    column ``name`` is replaced."""
    at = "__row_at"
    ranged = df.drop(name).repartitionByRange(*order).sortWithinPartitions(*order)
    kept = written(ranged.withColumn(at, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(at, _ROW_BITS)
    sizes = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = accumulate((r["n"] for r in sizes), initial=0)
    starts = [(r["part"], n) for r, n in zip(sizes, before, strict=False)]
    offsets = df.sparkSession.createDataFrame(starts, "__row_part bigint, __row_before bigint")
    # one row a range: the broadcast is bounded by the number of partitions
    met = kept.withColumn("__row_part", part).join(F.broadcast(offsets), "__row_part")
    inside = F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return met.select(*[c for c in kept.columns if c != at], (F.col("__row_before") + inside + 1).alias(name))
