"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """The column as a double; text that is no number and NaN both become null."""
    value = as_col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rounded(c: Column | str, digits: int) -> Column:
    """The double nearest to the value rounded to a number of decimals, exact ties to the even digit.

    Spark's own rounding goes by the printed decimal, so that 2.675, which is stored a little below, becomes 2.68. Here
    the stored value counts, as in Python's ``round``. Away from a tie the product with the power of ten tells; near one,
    and for large values, the fraction is split in two halves whose products are exact.
    """
    scale = 10.0**digits
    value = number(c)
    product = value * scale
    nearest = F.rint(product)
    clear = (F.abs(product - nearest) < 0.499) & (F.abs(product) < 2.0**40)
    return F.when(clear, nearest / scale).otherwise(_exactly_rounded(value, scale))


def _exactly_rounded(value: Column, scale: float) -> Column:
    """The rounding spelled out, every step bound once."""

    def of(value: Column) -> Column:
        size = F.abs(value)
        # Beyond this size a double has no decimals left to round.
        small = F.when(size < 2.0**52 / scale, size).otherwise(0.0)
        whole = F.floor(small).cast("double")
        return let(F.struct(value.alias("value"), whole.alias("whole"), (small - whole).alias("fraction")), split)

    def split(x: Column) -> Column:
        stretched = x.fraction * 134217729.0
        high = let(stretched, lambda s: s - (s - x.fraction))
        return let(F.struct(x.alias("x"), high.alias("high")), half)

    def half(y: Column) -> Column:
        units = F.floor(y.high * scale).cast("double")
        return let(F.struct(y.x.alias("x"), y.high.alias("high"), units.alias("units")), joined)

    def joined(z: Column) -> Column:
        over_half = (z.high * scale - z.units - 0.5) + (z.x.fraction - z.high) * scale
        up = let(over_half, lambda o: (o > 0).cast("double") + (o == 0).cast("double") * F.pmod(z.units, F.lit(2.0)))
        size = F.abs(z.x.value)
        large = F.when(size < 2.0**52 / scale, 0.0).otherwise(size)
        return ((z.x.whole * scale + z.units + up) / scale + large) * F.signum(z.x.value)

    return let(value, of)
