"""Column functions: scales, band arithmetic, memberships, modes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def to_db(power: Column | str, add: float = 0.0) -> Column:
    """Power to decibels; what isn't positive is missing."""
    value = _c(power) + add if add else _c(power)
    return F.when(value > 0, 10 * F.log10(value))


def to_power(db: Column | str) -> Column:
    return F.pow(F.lit(10.0), _c(db) / 10)


def rescale(value: Column | str, low: float, high: float) -> Column:
    """(value - low) / (high - low)."""
    return (_c(value) - low) / (high - low)


def pol_ratio(co: Column | str, cross: Column | str) -> Column:
    """co / cross, 0 where cross is 0."""
    return F.when(_c(cross) != 0, _c(co) / _c(cross)).when(_c(cross) == 0, F.lit(0.0))


def span(co: Column | str, cross: Column | str) -> Column:
    return _c(co) + 2 * _c(cross)


def occurrence_share(value: Column | str, missing: float = 255, most: float = 100) -> Column:
    """Water occurrence as a share; the missing code is missing."""
    return F.nullif(_c(value), F.lit(float(missing))) / most


def smf(x: Column | str, a: Column | str | float, b: Column | str | float) -> Column:
    """S-shaped membership rising from a to b."""
    x, a, b = _c(x), _c(a), _c(b)
    a = F.when(b - a <= 0, b - 1e-5).otherwise(a)
    up = 2 * F.pow((x - a) / (b - a), 2)
    down = 1 - 2 * F.pow((x - b) / (b - a), 2)
    return F.when(x.isNull(), None).when(x <= a, 0.0).when(x >= b, 1.0).when(x <= (a + b) / 2, up).otherwise(down)


def zmf(x: Column | str, a: Column | str | float, b: Column | str | float) -> Column:
    """Z-shaped membership falling from a to b; at or below a it is 1 whatever b is."""
    x, a, b = _c(x), _c(a), _c(b)
    a = F.when(b - a <= 0, b - 1e-5).otherwise(a)
    down = 1 - 2 * F.pow((x - a) / (b - a), 2)
    up = 2 * F.pow((x - b) / (b - a), 2)
    return F.when(x.isNull(), None).when(x <= a, 1.0).when(x >= b, 0.0).when(x <= (a + b) / 2, down).otherwise(up)


def zmf_recentred(x: Column | str, peak: Column | str | float, valley: Column | str | float, alpha: float = 1.0, least: float = 1e-3) -> Column:
    """Z membership whose middle lies ``alpha`` of the way from the peak to the valley."""
    peak, valley = _c(peak), _c(valley)
    middle = peak + alpha * (valley - peak)
    return zmf(x, peak, F.greatest(2 * middle - peak, peak + least))


def known_mean(*values: Column) -> Column:
    """Mean of the values that aren't missing."""
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
    n = reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v in values])
    return F.when(n > 0, total / n)


def gaussian(x: Column | str, mu: Column | str | float, sigma: Column | str | float, amp: Column | str | float) -> Column:
    return _c(amp) * F.exp(-F.pow(_c(x) - _c(mu), 2) / 2 / F.pow(_c(sigma), 2))


def normal_cdf(x: Column, mu: Column, sigma: Column) -> Column:
    """Normal distribution function by the rational approximation of erf (|error| < 1.5e-7)."""
    z = (x - mu) / sigma / F.lit(2.0**0.5)
    t = 1 / (1 + 0.3275911 * F.abs(z))
    # Coefficients of the approximation.
    series = reduce(lambda acc, c: (acc + c) * t, (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592), F.lit(0.0))
    erf = 1 - series * F.exp(-z * z)
    return 0.5 * (1 + F.when(z < 0, -erf).otherwise(erf))


def diagnostic(membership: Column | str) -> Column:
    """Membership in hundredths, half to even; missing is 255."""
    return F.coalesce(F.bround(100 * _c(membership), 0).cast("int"), F.lit(255))


def prioritised(base: Column, *layers: tuple[Column, int]) -> Column:
    """Codes laid over a base in order, later ones on top."""
    chain = base
    for mask, code in layers:
        chain = F.when(F.coalesce(mask, F.lit(False)), F.lit(code)).otherwise(chain)
    return chain
