"""Column selection, renaming and simple row picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.operators.ordered import positions

# Columns of the raw export that repeat another unit, and the
# canonical names of the ones kept.
IMPERIAL = [
    "pressure_in",
    "temperature_fahrenheit",
    "wind_mph",
    "precip_in",
    "feels_like_fahrenheit",
    "visibility_miles",
    "gust_mph",
]
METRIC_NAMES = {
    "temperature_celsius": "temperature",
    "pressure_mb": "pressure",
    "wind_kph": "wind_speed",
    "precip_mm": "precipitation",
    "last_updated": "recorded_at",
}
# Spark's default limit for filtering ranks ahead of the shuffle.
PREFILTERED = 1000
# The stored hourly table's names and the canonical ones.
HOURLY_NAMES = {
    "idCity": "city_id",
    "Date": "date",
    "Hour": "hour",
    "Temp": "temperature",
    "FeelsLike": "feelslike",
    "Clouds": "clouds",
    "Rain": "precipitation",
    "Wind": "wind_speed",
    "Pressure": "pressure",
    "Humidity": "humidity",
}
# Columns that are or reveal a target.
TARGET_COLUMNS = ["precipitation", "rain_flag", "air_quality", "is_weekend", "will_rain"]


def metric_only(df: DataFrame) -> DataFrame:
    """Drop imperial duplicates and use the canonical metric names."""
    return df.drop(*IMPERIAL).withColumnsRenamed(METRIC_NAMES)


def canonical_hourly(df: DataFrame) -> DataFrame:
    """Rename the stored hourly table to the names the cleaning step reads."""
    return df.withColumnsRenamed(HOURLY_NAMES)


def available(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def without_targets(df: DataFrame, names: list[str] = TARGET_COLUMNS) -> DataFrame:
    return df.drop(*names)


def keep_keys(df: DataFrame, column: str, keys: list) -> DataFrame:
    return df.filter(F.col(column).isin(*keys))


def recent(df: DataFrame, time: str, *, days: int = 30) -> DataFrame:
    """Rows at most ``days`` before the table's own latest time.

    The latest time is an uncorrelated scalar subquery: one pruned scan, and the
    value is pushed back into the main scan.
    """
    latest = df.agg(F.max(time)).scalar()
    return df.filter(F.col(time) >= latest - F.make_dt_interval(F.lit(days)))


def since(df: DataFrame, time: str, now: Column, *, hours: int = 1) -> DataFrame:
    return df.filter(F.col(time) >= now - F.make_dt_interval(F.lit(0), F.lit(hours)))


def head(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_n(df: DataFrame, keys: list[str], time: list[str], n: int) -> DataFrame:
    """The latest ``n`` rows of each series.

    For small ``n`` Spark keeps only ``n`` rows per series in each map task
    before the shuffle; a large ``n`` is ranked through ``positions``.
    """
    order = [F.col(c).desc() for c in time]
    if n > PREFILTERED:
        return positions(df, keys, order, name="__newest").filter(F.col("__newest") <= n).drop("__newest")
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__newest", F.row_number().over(newest)).filter(F.col("__newest") <= n).drop("__newest")


def first_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of the first ``k`` keys in key order."""
    chosen = df.select(key).distinct().orderBy(key).limit(k)
    return df.join(chosen, key, "left_semi")


def top(df: DataFrame, score: str, *, k: int = 10, tie: str | None = None) -> DataFrame:
    order = [F.col(score).desc()] + ([F.col(tie)] if tie else [])
    return df.orderBy(*order).limit(k)
