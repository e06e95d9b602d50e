"""Zone-free epoch arithmetic for timestamps without time zone.

Casting a TIMESTAMP_NTZ to TIMESTAMP goes through the session time zone
(and its daylight-saving shifts); these expressions use only the date and
the wall-clock parts, so the result does not depend on any zone setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz_epoch_micros(ts: Column) -> Column:
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = F.hour(ts).cast("bigint") * 3600 + F.minute(ts).cast("bigint") * 60
    frac = (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("bigint")  # seconds.micros
    return days * F.lit(86_400_000_000) + secs * F.lit(1_000_000) + frac


def ntz_epoch_millis(ts: Column) -> Column:
    return F.floor(ntz_epoch_micros(ts) / F.lit(1000)).cast("bigint")


def ntz_epoch_seconds(ts: Column) -> Column:
    return F.floor(ntz_epoch_micros(ts) / F.lit(1_000_000)).cast("bigint")


def ntz_as_instant(ts: Column) -> Column:
    """The wall-clock value as an instant on the UTC line (for event-time
    windows and watermarks, which need TIMESTAMP)."""
    return F.timestamp_micros(ntz_epoch_micros(ts))
