"""Time as whole microseconds since 1970 UTC, and the text keys made from it.

Keys are made by integer arithmetic, so results never depend on the session's time zone.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000
HOUR_S = 3600
DAY_S = 86_400
GRAINS = {"day": "kpi_date_utc", "hour": "kpi_hour_utc"}


def wall_us(wall: Column) -> Column:
    """Micros of a timestamp without zone that is UTC wall time."""
    return F.timestamp_diff("MICROSECOND", F.lit(datetime.datetime(1970, 1, 1)).cast("timestamp_ntz"), wall)


def parse_us(text: Column) -> Column:
    """Micros of an ISO-8601 text with zone; null where it cannot be parsed."""
    return F.unix_micros(text.try_cast("timestamp"))


def day_key(us: Column) -> Column:
    """YYYY-MM-DD."""
    return F.date_add(F.lit(datetime.date(1970, 1, 1)), F.floor(us / (DAY_S * SECOND_US)).cast("int")).cast("string")


def hour_key(us: Column) -> Column:
    """YYYY-MM-DDTHH:00:00Z."""
    return F.concat(day_key(us), F.lit("T"), F.lpad(F.pmod(F.floor(us / (HOUR_S * SECOND_US)), F.lit(24)).cast("string"), 2, "0"), F.lit(":00:00Z"))


def period_key(us: Column, grain: str) -> Column:
    return {"day": day_key, "hour": hour_key}[grain](us).alias(GRAINS[grain])


def iso_seconds(epoch_s: Column) -> Column:
    """YYYY-MM-DDTHH:MM:SS+00:00."""
    part = lambda unit, size: F.lpad(F.pmod(F.floor(epoch_s / unit), F.lit(size)).cast("string"), 2, "0")
    return F.concat(day_key(epoch_s * SECOND_US), F.lit("T"), part(3600, 24), F.lit(":"), part(60, 60), F.lit(":"), part(1, 60), F.lit("+00:00"))


def epoch_s(us: Column) -> Column:
    return F.floor(us / SECOND_US)


def bin_epoch(seconds: Column, bin_seconds: int) -> Column:
    """The start of the bin that a whole second falls in."""
    return F.floor(seconds / bin_seconds) * bin_seconds
