"""Temperature, humidity and wind formulas; temperatures in °C unless named otherwise."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the published formulas.
WIND_CHILL = {"constant": 13.12, "t": 0.6215, "v": -11.37, "tv": 0.3965, "exponent": 0.16}
HEAT_INDEX = {  # (power of temperature, power of relative humidity): coefficient
    (0, 0): -42.379,
    (1, 0): 2.04901523,
    (0, 1): 10.14333127,
    (1, 1): -0.22475541,
    (2, 0): -6.83783e-3,
    (0, 2): -5.481717e-2,
    (2, 1): 1.22874e-3,
    (1, 2): 8.5282e-4,
    (2, 2): -1.99e-6,
}
MAGNUS = {"a": 17.625, "b": 243.04}
KMH_PER_MS = 3.6


def to_fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def to_celsius(fahrenheit: Column) -> Column:
    return (fahrenheit - 32) * 5 / 9


def wind_chill(temperature: Column, wind_ms: Column) -> Column:
    """Felt temperature; `wind_ms` in metres per second, null below zero."""
    k = WIND_CHILL
    v = F.when(wind_ms >= 0, F.pow(wind_ms * KMH_PER_MS, F.lit(k["exponent"])))
    return k["constant"] + k["t"] * temperature + k["v"] * v + k["tv"] * temperature * v


def heat_index(temperature: Column, humidity: Column) -> Column:
    """Second-degree polynomial in temperature and relative humidity (%)."""

    def power(x: Column, n: int) -> Column:
        return F.lit(1.0) if n == 0 else x if n == 1 else x * x

    total = F.lit(0.0)
    for (i, j), coefficient in HEAT_INDEX.items():
        total = total + coefficient * power(temperature, i) * power(humidity, j)
    return total


def dew_point_depression(temperature: Column, dew_point: Column) -> Column:
    return temperature - dew_point


def relative_humidity_from_dew(temperature: Column, dew_point: Column) -> Column:
    """Magnus formula: ratio of the vapour pressures at dew point and at temperature, in %."""

    def vapour(t: Column) -> Column:
        return F.exp(F.try_divide(MAGNUS["a"] * t, MAGNUS["b"] + t))

    return 100 * F.try_divide(vapour(dew_point), vapour(temperature))
