"""Amounts of five decimals as two long columns.

Spark keeps a decimal of more than 18 digits as an object and copies it byte by byte into every row that passes an
operator.  Where many amounts pass many operators they are two longs instead: ``hi`` counts 100,000 units of money,
``lo`` hundred-thousandths of one.  Sums and differences are taken of each by itself and are exact: a decimal(20,5) has
less than 10^10 in either, so nothing overflows below 10^8 summands.  ``lo`` need not have the sign of ``hi``.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: hundred-thousandths in one ``hi``
PLACE = 10**10
#: money in one ``hi``
MONEY_PLACE = 100_000
AMOUNT_TYPE = "decimal(38,5)"


@dataclass(frozen=True)
class Amount:
    hi: Column
    lo: Column

    @classmethod
    def named(cls, name: str) -> Amount:
        """The amount in the columns that ``columns`` gave."""
        return cls(F.col(f"_hi_{name}"), F.col(f"_lo_{name}"))

    @classmethod
    def of(cls, name: str) -> Amount:
        """The decimal column ``name``, of at most 15 whole digits and five decimals; NULL counts 0."""
        v = f"coalesce({name}, 0BD)"
        return cls(F.expr(f"{v} div {MONEY_PLACE}BD"), (F.expr(f"{v} % {MONEY_PLACE}BD") * F.lit(MONEY_PLACE)).cast("bigint"))

    def __sub__(self, other: Amount) -> Amount:
        return Amount(self.hi - other.hi, self.lo - other.lo)

    def columns(self, name: str) -> list[Column]:
        return [self.hi.alias(f"_hi_{name}"), self.lo.alias(f"_lo_{name}")]

    def only(self, condition: Column) -> Amount:
        """0 where ``condition`` is not met."""
        return self.if_else(condition, Amount(F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))

    def if_else(self, condition: Column, other: Amount) -> Amount:
        return Amount(F.when(condition, self.hi).otherwise(other.hi), F.when(condition, self.lo).otherwise(other.lo))

    def sign(self) -> Column:
        """A double with the sign of the amount: the double of ``hi`` is cut only where ``lo`` is too small to matter."""
        return self.hi.cast("double") * F.lit(float(PLACE)) + self.lo.cast("double")

    def rounded(self) -> Amount:
        """Rounded to three decimals, half away from zero.  ``PLACE`` divides by 100, so only ``lo`` moves."""
        rest = F.pmod(self.lo, F.lit(100).cast("bigint"))
        up = F.when(self.sign() >= 0, rest >= 50).otherwise(rest > 50)
        return Amount(self.hi, self.lo - rest + F.when(up, F.lit(100).cast("bigint")).otherwise(F.lit(0).cast("bigint")))

    def decimal(self) -> Column:
        high = self.hi.cast("decimal(20,0)") * F.lit(Decimal(MONEY_PLACE))
        low = self.lo.cast("decimal(20,0)") * F.lit(Decimal("0.00001"))
        return F.when((self.hi == 0) & (self.lo == 0), F.lit(Decimal(0))).otherwise(high + low).cast(AMOUNT_TYPE)
