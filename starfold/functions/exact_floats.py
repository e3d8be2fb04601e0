"""Exact sums of doubles, whatever the order of the rows.

A double is a whole number of units, and the unit is a power of two that depends on its exponent
only. Units of one size are added up as decimals, which is exact, so a sum is a decimal for each unit
size that occurs: its bin. Sums of sums stay in that form. At the end the bins of a group, at most
263, are carried into digits and rounded once, to the nearest double, ties to even.

A group holds up to 8 * 10^12 rows of one bin; beyond that the sum is refused.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a digit, and of the step from one unit to the next; the exponent of the least double.
_BITS, _LEAST = 8, -1074
_BASE = 1 << _BITS
_DECIMAL = "decimal(38,0)"
#: Bins of what is no number of units.
_PLUS, _MINUS = 1000, 1001
#: Digits that decide how a sum is rounded, and more that a sum can have than its largest bin.
_KEPT, _MORE = 12, 14
_LIMIT = "10000000000000000000000000000000"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scaled(x: Column, power: Column) -> Column:
    """``x * 2^power`` in two steps, as the power alone can be out of range."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def bin_of(x: Column) -> Column:
    """The bin of a double, null for null. NaN is taken for null before."""
    size = F.abs(x)
    near = F.floor(F.log2(size))
    power = lambda e: F.pow(F.lit(2.0), e)
    exponent = F.when(power(near) > size, near - 1).when(size >= power(near + 1), near + 1).otherwise(near)
    lowest = F.greatest(exponent - 52, F.lit(_LEAST).cast("long")) - _LEAST
    own = F.when(size == 0, F.lit(-_LEAST // _BITS)).otherwise(F.floor(lowest / _BITS))
    return (
        F.when(x == float("inf"), _PLUS).when(x == float("-inf"), _MINUS).when(x.isNotNull(), own).cast("int")
    )


def units_of(x: Column, own: Column) -> Column:
    """How many units of the bin ``own`` a double is: exact, less than 2^60; 1 for an infinite one."""
    count = _scaled(x, F.lit(-_LEAST) - own * _BITS).cast("bigint")
    return F.when(own < _PLUS, count).when(own.isNotNull(), 1).cast("decimal(28,0)")


def _digits(bins: Column, sign: int) -> Column:
    """``digits`` from the lowest bin up, each from 0 to 255, of ``sign`` times the sum, and ``carry``,
    which is -1 if that is negative."""
    zero = F.lit(0).cast(_DECIMAL)
    base = F.lit(_BASE).cast("decimal(4,0)")

    def run(held: Column) -> Column:
        def step(state: Column, at: Column) -> Column:
            total = state["carry"] + F.coalesce(F.try_element_at(held, at), zero) * sign
            return _once(total.cast(_DECIMAL), lambda t: _once(F.pmod(t, base).cast("bigint"), lambda digit: F.struct(
                ((t - digit).cast(_DECIMAL) / base).cast(_DECIMAL).alias("carry"),
                F.concat(state["digits"], F.array(digit)).alias("digits"),
            )))

        first = F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("digits"))
        ends = F.map_keys(held)
        return F.aggregate(F.sequence(F.array_min(ends), F.array_max(ends) + _MORE), first, step)

    return _once(F.map_from_entries(bins), run)


def _magnitude(digits: Column, lowest: Column) -> Column:
    """The double next to the number of these digits, which begin at the bin ``lowest``."""

    def value(top: Column) -> Column:
        # whether anything follows the head matters for rounding, how much does not
        below = F.slice(digits, 1, F.greatest(top - _KEPT + 1, F.lit(0)))
        rest = F.exists(below, lambda d: d > 0).cast("int")
        head = F.aggregate(
            F.sequence(F.lit(0), F.lit(_KEPT - 1)), F.lit(0).cast(_DECIMAL),
            lambda so_far, i: (
                so_far * _BASE + F.coalesce(F.when(top >= i, F.get(digits, top - i)), F.lit(0))
            ).cast(_DECIMAL),
        )
        power = (lowest + top - (_KEPT - 1)) * _BITS + _LEAST - 1
        return _scaled((head * 2 + rest).cast(_DECIMAL).cast("double"), power)

    # the place of the first digit that counts, from 0 at the lowest; -1 if there is none
    top = F.aggregate(
        digits, F.struct(F.lit(0).alias("at"), F.lit(-1).alias("top")),
        lambda so_far, d: F.struct(
            (so_far["at"] + 1).alias("at"), F.when(d > 0, so_far["at"]).otherwise(so_far["top"]).alias("top")
        ),
        lambda end: end["top"],
    )
    return _once(top, lambda t: F.when(t >= 0, value(t)).otherwise(0.0))


def rounded_sum(entries: Column) -> Column:
    """The double next to the sum of ``entries``, an array of one ``struct<bin, units>`` for each bin.
    Null if no bin is known; infinite ones of both signs give NaN."""
    known = F.filter(entries, lambda e: e["bin"].isNotNull())
    bins = F.filter(known, lambda e: e["bin"] < _PLUS)
    has = lambda which: F.exists(known, lambda e: e["bin"] == which)
    too_many = F.exists(bins, lambda e: e["units"].isNull() | (F.abs(e["units"]) >= F.lit(_LIMIT).cast(_DECIMAL)))
    lowest = F.array_min(F.transform(bins, lambda e: e["bin"]))

    def finite(one: Column) -> Column:
        minus = lambda: _once(_digits(one, -1), lambda down: -_magnitude(down["digits"], lowest))
        return _once(
            _digits(one, 1),
            lambda up: F.when(up["carry"] >= 0, _magnitude(up["digits"], lowest)).otherwise(minus()),
        )

    return (
        F.when(F.size(known) == 0, F.lit(None).cast("double"))
        .when(has(_PLUS) & has(_MINUS), float("nan"))
        .when(has(_PLUS), float("inf")).when(has(_MINUS), float("-inf"))
        .when(too_many, F.raise_error(F.lit("too many rows for an exact sum")).cast("double"))
        .otherwise(finite(bins))
    )


def as_doubles(own: Column, units: Column) -> Column:
    """Doubles whose sum is exactly that many units: the lower 52 bits and the rest."""
    low = (units % F.lit(1 << 52).cast("decimal(16,0)")).cast(_DECIMAL)
    power = own * _BITS + _LEAST
    parts = [_scaled(part.cast("double"), power) for part in (low, (units - low).cast(_DECIMAL))]
    some = F.filter(F.array(*parts), lambda p: p != 0)
    return (
        F.when(own == _PLUS, F.array(F.lit(float("inf")))).when(own == _MINUS, F.array(F.lit(float("-inf"))))
        .when(own.isNull(), F.array(F.lit(None).cast("double")))
        .when(units == 0, F.array(F.lit(0.0))).otherwise(some)
    )
