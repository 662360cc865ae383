"""Small Column helpers shared by the operators."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"
LARGEST = 1e18
_STEP, _TOO_LARGE = 2**20, 2**62


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_compact_date(c: Column) -> Column:
    """``yyyyMMdd`` text or number to date; unreadable values become NULL."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def parse_us_date(c: Column) -> Column:
    """``MM/dd/yyyy`` text to date; unreadable values become NULL."""
    return F.try_to_date(c.cast("string"), "MM/dd/yyyy")


def parse_amount(c: Column) -> Column:
    """Text to double. Blank, non-numeric and non-finite values become NULL."""
    value = c.try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def parse_int(c: Column) -> Column:
    return c.try_cast("int")


def flag(c: Column, yes: int = 1) -> Column:
    """1 where the code says yes, else 0 (also for NULL)."""
    return F.when(c.try_cast("int") == yes, 1).otherwise(0)


def present(c: Column) -> Column:
    return c.isNotNull().cast("int")


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def exact(c: Column | str) -> Column:
    """An amount as decimal of ten places; one that has no room is an error, with ANSI mode or without."""
    value = _col(c)
    wrong = F.raise_error(F.concat(F.lit("amount too large for an exact sum: "), value.cast("string")))
    return F.when(F.abs(value) < LARGEST, value.cast(EXACT)).when(value.isNotNull(), wrong.cast(EXACT))


def exact_total(amounts: Column) -> Column:
    """Sum of ``exact`` amounts, or of sums of them, as double; an overflow is an error in both modes."""
    added = F.sum(amounts)
    wrong = F.raise_error(F.lit("overflow in an exact sum")).cast("double")
    return F.when(added.isNotNull() | (F.count(amounts) == 0), added.cast("double")).otherwise(wrong)


def _limbs(value: Column) -> list[Column]:
    """An ``exact`` amount as three whole numbers: a * 2**20 + (b * 2**27 + c) / 10**10.

    Sums of whole numbers cost a fraction of sums of decimals. Below 200,000 a product within 0.2 of a
    whole number is the amount's, as the errors of value and product are 0.27 at most together; any other
    amount is taken apart as decimal. One that has no room there gets an ``a`` out of reach of all others.
    """
    product = value.cast("double") * 1e10
    near = (F.abs(product) < 2e15) & (F.abs(product - F.rint(product)) <= 0.2)
    amount, step = value.try_cast(EXACT), F.lit(Decimal(_STEP))
    high = F.call_function("div", amount.cast("long"), F.lit(_STEP).cast("long"))
    known = F.when(value.isNotNull(), _TOO_LARGE)
    a = F.when(near, F.lit(0).cast("long")).otherwise(F.coalesce(high, known))
    below = ((amount % step) * F.lit(Decimal(10**10))).cast("long")
    units = F.when(near, F.rint(product).cast("long")).otherwise(below)
    return [a, F.shiftright(units, 27), units.bitwiseAND(F.lit(2**27 - 1).cast("long"))]


def _sum_of_limbs(high: Column, middle: Column, low: Column, known: Column) -> Column:
    whole = "decimal(19,0)"
    below = middle.cast(whole) * F.lit(Decimal(2**27).scaleb(-10)) + low.cast(whole) * F.lit(Decimal(1).scaleb(-10))
    added = (high.cast(whole) * F.lit(Decimal(_STEP)) + below).cast("double")
    wrong = F.raise_error(F.lit("amount too large for an exact sum, or overflow in an exact sum")).cast("double")
    return F.when((F.abs(high) < _TOO_LARGE // 2) | (known == 0), added).otherwise(wrong)


def exact_sum(c: Column | str) -> Column:
    """Sum as double, the same whatever the partitioning.

    Values are added up as decimals of ten places, which holds amounts and prices as they are
    read; only what a double's text would show beyond that is cut.
    """
    a, b, rest = _limbs(_col(c))
    return _sum_of_limbs(F.try_sum(a), F.sum(b), F.sum(rest), F.count(_col(c)))


def exact_part(c: Column | str) -> Column:
    """A part of an exact sum, to be put together by ``exact_sum_of_parts``."""
    a, b, rest = _limbs(_col(c))
    known = F.count(_col(c))
    high = F.coalesce(F.try_sum(a), F.when(known > 0, _TOO_LARGE))
    return F.struct(high.alias("high"), F.sum(b).alias("middle"), F.sum(rest).alias("low"), known.alias("known"))


def exact_sum_of_parts(name: str) -> Column:
    """``exact_sum`` of what went into the parts in a column."""
    part = F.col(name)
    return _sum_of_limbs(F.try_sum(part["high"]), F.sum(part["middle"]), F.sum(part["low"]), F.sum(part["known"]))


def exact_avg(c: Column | str) -> Column:
    """Mean on an exact sum; NULL when nothing is counted."""
    return F.try_divide(exact_sum(c), F.count(_col(c)))


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL unless the denominator is positive."""
    return F.when(_col(den) > 0, _col(num) / _col(den))


def share_pct(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    return F.when(_col(den) > 0, F.round(_col(num) / _col(den) * 100, digits))


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name, with spaces and hyphens as underscores."""
    return df.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in df.columns])
