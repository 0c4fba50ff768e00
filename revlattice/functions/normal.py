"""Standard normal distribution as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the rational approximation of the upper tail
# published by Hart (1968), double precision, lowest power first.
_NUMERATOR = (
    220.206867912376,
    221.213596169931,
    112.079291497871,
    33.912866078383,
    6.37396220353165,
    0.700383064443688,
    0.0352624965998911,
)
_DENOMINATOR = (
    440.413735824752,
    793.826512519948,
    637.333633378831,
    296.564248779674,
    86.7807322029461,
    16.064177579207,
    1.75566716318264,
    0.0883883476483184,
)
_FAR = 7.07106781186547
_ROOT_TWO_PI = 2.506628274631


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * x + F.lit(c)
    return value


def upper_tail(z: Column) -> Column:
    """P(Z > z) for z >= 0, accurate to about 1e-14."""
    near = F.exp(-z * z / 2) * _polynomial(_NUMERATOR, z) / _polynomial(_DENOMINATOR, z)
    fraction = z + 0.65
    for step in (4.0, 3.0, 2.0, 1.0):
        fraction = z + F.lit(step) / fraction
    far = F.exp(-z * z / 2) / fraction / F.lit(_ROOT_TWO_PI)
    return F.when(z > 37, F.lit(0.0)).when(z < _FAR, near).otherwise(far)


def two_sided_p(z: Column) -> Column:
    return F.lit(2.0) * upper_tail(F.abs(z))
