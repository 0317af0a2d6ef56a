"""Calendar features and time conversions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_time(value: Column) -> Column:
    """Zone-free timestamp, or NULL where the text is not one."""
    return value.try_cast("timestamp_ntz")


def day_of_week(moment: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(moment)


def season(month: Column) -> Column:
    """Southern-hemisphere season; anything that is no other month is Spring."""
    return (
        F.when(month.isin(12, 1, 2), "Summer")
        .when(month.isin(3, 4, 5), "Autumn")
        .when(month.isin(6, 7, 8), "Winter")
        .otherwise("Spring")
    )


def epoch_to_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def time_to_epoch(moment: Column) -> Column:
    """Whole seconds since 1970 of a timestamp with or without zone."""
    return F.unix_seconds(moment.cast("timestamp"))


def iso_format(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def key_safe(name: Column) -> Column:
    """A name usable in a path: blanks and slashes become underscores."""
    return F.translate(name, " /", "__")
