"""Exact products of money and rates.

Spark cuts the decimals of a product whose declared digits exceed 38.  Here both
factors are taken apart into limbs of twelve digits; the partial products fit
38 digits each, are exact, and are added by place value.  The result does not depend on
the size of the values: there is no switch, and what does not fit stops the job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A total: up to 24 whole digits and twelve decimals.  A rate: up to twelve whole digits and 24 decimals.
TOTAL_FACTOR = "decimal(36,12)"
RATE_FACTOR = "decimal(36,24)"
#: A product: up to 24 whole digits and thirteen decimals, rounded half away from zero.
PRODUCT_TYPE = "decimal(38,13)"

_LIMB = 1_000_000_000_000


def rate_factor(rate: Column, kind: T.DataType) -> Column:
    """``rate`` of type ``kind`` as a decimal of at most 24 decimals.  A double is taken by its shortest decimal
    text (all of its digits down to the 24th decimal); one that is no number counts as missing."""
    if isinstance(kind, T.DecimalType) and kind.scale <= 24 and kind.precision - kind.scale <= 12:
        return rate
    return rate.try_cast(RATE_FACTOR) if isinstance(kind, (T.FloatType, T.DoubleType)) else rate.cast(RATE_FACTOR)


def _fits(total: T.DataType, rate: T.DataType) -> bool:
    """Whether the declared digits of both factors let Spark's own product keep all of its decimals."""
    decimals = isinstance(total, T.DecimalType) and isinstance(rate, T.DecimalType)
    return decimals and total.precision + rate.precision + 1 <= 38


def with_product(df: DataFrame, total: str, rate: str, name: str) -> DataFrame:
    """``df`` with ``name`` = column ``total`` x column ``rate``, exact, rounded to thirteen decimals where
    it has more; NULL if either is.  Both columns are decimals (``rate_factor`` makes one of any number)."""
    if _fits(df.schema[total].dataType, df.schema[rate].dataType):
        return df.withColumn(name, F.col(total) * F.col(rate))
    # no abs or negation: Spark rounds both to 34 digits.  The limbs of a negative factor are negative, as are all of
    # its partial products, so rounding away from zero is right for either sign
    t, r = F.col(total).cast(TOTAL_FACTOR), F.col(rate).cast(RATE_FACTOR)
    own = {c: f"__{c}" for c in ("t", "r", "f", "a", "b", "c", "w", "g", "h")}
    # limbs: t = a * 10^12 + b + c, r = w + g / 10^12 + h / 10^24
    rest = f"{own['t']} % {_LIMB}"
    halves = df.withColumns({own["t"]: t, own["r"]: r}).withColumns({
        own["a"]: F.expr(f"{own['t']} div {_LIMB}").cast("decimal(12,0)"),
        own["b"]: F.expr(f"({rest}) div 1").cast("decimal(12,0)"),
        own["c"]: F.expr(f"{own['t']} % 1").cast("decimal(12,12)"),
        own["w"]: F.expr(f"{own['r']} div 1").cast("decimal(12,0)"),
        own["f"]: F.expr(f"{own['r']} % 1").cast("decimal(24,24)") * F.lit(_LIMB).cast("decimal(13,0)"),
    }).withColumns({
        own["g"]: F.expr(f"{own['f']} div 1").cast("decimal(12,0)"),
        own["h"]: F.expr(f"{own['f']} % 1").cast("decimal(12,12)"),
    })
    a, b, c, w, g, h = (F.col(own[x]) for x in "abcwgh")
    small = F.lit(Decimal(1).scaleb(-12))  # decimal(12,12)
    g_place, h_place = (g * small).cast("decimal(12,12)"), (h * small).cast("decimal(24,24)")
    whole = a * w * F.lit(_LIMB).cast("decimal(13,0)") + a * g + b * w
    middle = a * h + b * g_place + c * w
    low = (b * h_place).cast("decimal(37,36)") + (c * g_place).cast("decimal(37,36)") + c * h_place
    product = (whole.cast("decimal(37,13)") + middle.cast("decimal(26,13)")).cast("decimal(37,13)") + F.round(low, 13).cast("decimal(14,13)")
    return halves.withColumn(name, product.cast(PRODUCT_TYPE)).drop(*own.values())
