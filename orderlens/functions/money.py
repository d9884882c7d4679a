"""Sums, ratios and currency conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are added up as whole numbers of units, millionths and millionths of those: unlike a sum
# of doubles the total does not depend on how rows are partitioned, or on which tasks run again
# after a lost executor. What is below 1e-12 of a row's amount is noise of the double itself.
MILLION = 1_000_000
MONEY = "decimal(34,12)"


PARTS = ("whole", "millionths", "rest", "special")
INFINITY, NOT_A_NUMBER = float("inf"), float("nan")
#: Bits of the special part.
UP, DOWN, NAN = 1, 2, 4


def money_parts(amount: Column) -> tuple[Column, ...]:
    """Three parts of an amount as integers, whose sums are as fast as those of doubles, and its kind.

    NaN and infinite amounts have no integers; the fourth part says, in bits, which of them there were.
    """
    special = F.when(F.isnan(amount), NAN).when(amount == INFINITY, UP).when(amount == -INFINITY, DOWN).otherwise(0)
    finite = F.when(special == 0, amount)
    whole = F.floor(finite)
    scaled = (finite - whole) * float(MILLION)
    millionths = F.floor(scaled)
    return whole, millionths, F.rint((scaled - millionths) * float(MILLION)).cast("bigint"), special


def added(parts: Sequence[Column]) -> list[Column]:
    """Each part over all rows: sums, and all kinds of special amounts that occur."""
    return [*[F.sum(p) for p in parts[:3]], F.bit_or(parts[3])]


def from_parts(whole: Column, millionths: Column, rest: Column, special: Column) -> Column:
    """Decimal of the added parts: NULL without any amount, and where one was NaN or infinite."""
    wide = "decimal(20,0)"
    fraction = millionths.cast(wide) / F.lit(MILLION) + rest.cast(wide) / F.lit(MILLION) / F.lit(MILLION)
    return F.when(special == 0, (whole.cast(wide) + fraction.cast(MONEY)).cast(MONEY))


def total_of_parts(whole: Column, millionths: Column, rest: Column, special: Column) -> Column:
    """Double of the added parts, with NaN and infinity as a sum of doubles has them."""
    both = special.bitwiseAND(UP | DOWN) == UP | DOWN
    return (
        F.when((special.bitwiseAND(NAN) != 0) | both, F.lit(NOT_A_NUMBER))
        .when(special.bitwiseAND(UP) != 0, F.lit(INFINITY))
        .when(special.bitwiseAND(DOWN) != 0, F.lit(-INFINITY))
        .otherwise(as_double(from_parts(whole, millionths, rest, special)))
    )


def exact_sum(amount: Column) -> Column:
    """Decimal SUM that skips NULL; NULL when every value is, or when one is NaN or infinite."""
    return from_parts(*added(money_parts(amount)))


def exact_total(amount: Column) -> Column:
    """The same as a double, NaN or infinite where such an amount takes part."""
    return total_of_parts(*added(money_parts(amount)))


def as_double(amount: Column) -> Column:
    return amount.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Report division: NULL, not an error, when the denominator is 0."""
    return F.try_divide(numerator, denominator)


def eur_name(local_name: str) -> str:
    return local_name.replace("_local", "_eur")


def to_eur(amount: Column, exchange_rate: Column) -> Column:
    """Batch division: a zero rate is an error, a NULL rate gives NULL."""
    return amount / exchange_rate
