"""Order-level column expressions: wait time, salt, exact half-up averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wait_seconds(fulfilled: Column | str, placed: Column | str) -> Column:
    """Whole-second fulfilment delay (each side truncated to seconds first);
    0 when the order is not fulfilled; negative delays pass through (C4)."""
    return F.coalesce(F.unix_timestamp(_c(fulfilled)) - F.unix_timestamp(_c(placed)),
                      F.lit(0)).cast("double")


def salt(key: Column | str, factor: int) -> Column:
    """The first 32 bits of the key's md5 modulo ``factor`` (C10); 0 for a null key.

    A digest of the key's text, so any other engine that reads the table can tell a row's salt.
    """
    digits = F.conv(F.substring(F.md5(_c(key).cast("binary")), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.pmod(digits, F.lit(int(factor))), F.lit(0)).cast("int")


#: Decimal places kept of an amount, and the size up to which amounts are summed exactly.
UNIT_PLACES, LARGEST = 10, 1e14


def units(amount: Column | str) -> Column:
    """Amount in whole units of 10**-10: sums of them are exact in any grouping order.
    Null for an amount that is null, not a number, infinite or beyond ``LARGEST``."""
    a = _c(amount)
    exact = F.when(F.abs(a) < LARGEST, a).cast("decimal(24,10)")
    return (exact * F.lit(10 ** UNIT_PLACES).cast("decimal(11,0)")).cast("decimal(24,0)")


def strays(amount: Column | str) -> Column:
    """The amounts that ``units`` cannot hold (NaN, infinities, very large ones), as they are."""
    a = _c(amount)
    return F.when(a.isNotNull() & ~F.coalesce(F.abs(a) < LARGEST, F.lit(False)), a)


def half_up_ratio(total: Column | str, count: Column | str, places: int,
                  unit_places: int = 0) -> Column:
    """``round(total / count, places)`` with HALF_UP ties, computed exactly.

    ``total`` is a whole sum in units of 10**-unit_places (cents: 2). Integer
    ``div`` keeps the quotient exact for any group size; the result is the
    DOUBLE nearest the exact decimal. Null total -> null.
    """
    t = _c(total).cast("decimal(34,0)")
    n = _c(count).cast("decimal(20,0)")
    shift = places - unit_places

    def times(c: Column, power: int) -> Column:
        return (c * F.lit(10 ** power).cast(f"decimal({power + 1},0)")).cast("decimal(38,0)")

    num = times(F.abs(t), max(shift, 0))
    den = times(n, max(-shift, 0))
    q = F.call_function("div", num * 2 + den, den * 2)
    signed = F.when(t < 0, -q).otherwise(q)
    return signed.cast("double") / F.lit(float(10 ** places))
