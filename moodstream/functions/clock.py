"""Time keys and time windows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the instant from which the descending row key counts down.
KEY_ORIGIN = "2030-01-01"


def descending_time_key(ts: Column) -> Column:
    """Seconds from a wall-clock time to 2030-01-01, so that newer times get smaller keys.

    Built from calendar fields: no session time zone enters, as the times are plain wall-clock times.
    """
    days = F.datediff(F.lit(KEY_ORIGIN).cast("date"), ts.cast("date"))
    seconds_of_day = (
        F.hour(ts) * 3600 + F.minute(ts) * 60 + F.date_part(F.lit("SECOND"), ts)
    )
    return (days.cast("bigint") * 86400 - seconds_of_day).cast("double")


def window_start(ts: Column, duration: str) -> Column:
    """Start of the tumbling window a time falls into."""
    return F.window(ts, duration)["start"]
