"""Calendar fields from epoch seconds.

``calendar_columns`` computes month / hour / day-of-week in UTC with integer
arithmetic on the epoch value, so the answer does not depend on the session
time zone of whoever runs the job. Pass ``zone`` to read the fields on a local
wall clock instead (DST aware through ``convert_timezone`` on a timestamp
without time zone, so again independent of the session zone).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def epoch_day(time: Column) -> Column:
    """The UTC calendar date of an epoch-seconds column."""
    return F.date_from_unix_date(F.floor(time / SECONDS_PER_DAY).cast("int"))


def calendar_columns(time_col: str = "time", zone: str | None = None) -> dict[str, Column]:
    """``month`` (1-12), ``hour`` (0-23) and ``dayofweek`` (1 = Sunday) columns."""
    time = F.col(time_col)
    if zone is None or zone.upper() == "UTC":
        day = epoch_day(time)
        return {
            "month": F.month(day),
            "hour": F.floor(F.pmod(time, F.lit(SECONDS_PER_DAY)) / 3600).cast("int"),
            "dayofweek": F.dayofweek(day),
        }
    utc_wall = F.timestamp_add("SECOND", time, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    wall = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)
    return {
        "month": F.month(wall),
        "hour": F.hour(wall),
        "dayofweek": F.dayofweek(wall),
    }
