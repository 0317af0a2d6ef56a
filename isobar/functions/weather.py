"""Weather formulas."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magnus coefficients over water, and the reference temperature of
# the simplified heat index.
MAGNUS_A = 17.27
MAGNUS_B = 237.7
HEAT_INDEX_BASE = 14.5


def missing(value: Column) -> Column:
    """Read NaN as NULL, so comparisons and means treat it as missing."""
    return F.when(~F.isnan(value), value)


def dew_point(temperature: Column, humidity: Column) -> Column:
    """Magnus dew point; humidity of 0 % or less has none and gives NULL."""
    gamma = F.try_divide(MAGNUS_A * temperature, MAGNUS_B + temperature) + F.ln(humidity / 100)
    return F.try_divide(MAGNUS_B * gamma, MAGNUS_A - gamma)


def feels_like(temperature: Column, humidity: Column) -> Column:
    return temperature + 0.5 * (humidity / 100) * (temperature - HEAT_INDEX_BASE)


def rain_flag(precipitation: Column) -> Column:
    """1 where it rained, else 0; a missing reading counts as dry."""
    return F.when(missing(precipitation.cast("double")) > 0, 1).otherwise(0)


def zero_if_missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def to_number(value: Column) -> Column:
    """Double, or NULL where the text is not a number."""
    return missing(value.try_cast("double"))
