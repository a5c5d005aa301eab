"""Timestamps as zone-free wall-clock values.

Order milestones carry no zone, and event times are stored as UTC. Both are kept as
TIMESTAMP_NTZ, so no result depends on the session time zone.
"""

from pyspark.sql import Column, functions as F

# a time of day followed by an explicit zone: "...10:00:00Z", "...10:00:00.5+03:00"
_ZONED = r"\d:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)$"


def wall_clock(value: Column) -> Column:
    """Zone-less text (or an already typed timestamp) to TIMESTAMP_NTZ; malformed text gives NULL."""
    return value.try_cast("timestamp_ntz")


def instant_to_utc(instant: Column) -> Column:
    """TIMESTAMP to its UTC wall clock. Adding micros to the epoch avoids the session zone's DST gaps."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def utc_clock(text: Column) -> Column:
    """ISO text to a UTC wall clock. Text without a zone is taken as UTC; malformed text gives NULL."""
    zoned = instant_to_utc(text.try_cast("timestamp"))
    return F.when(text.rlike(_ZONED), zoned).otherwise(wall_clock(text))


def micros_text(clock: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss.SSSSSS`. The string cast drops trailing zeros, so they are put back."""
    text = clock.cast("string")
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(F.concat(text, F.lit(".000000")))


def iso_utc_text(clock: Column) -> Column:
    """`yyyy-MM-ddTHH:mm:ss.SSSSSSZ`."""
    return F.concat(F.translate(micros_text(clock), " ", "T"), F.lit("Z"))


def event_time_text(clock: Column) -> Column:
    """Seconds precision, with six fraction digits only when there is a fraction."""
    text = clock.cast("string")
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


def utc_now() -> Column:
    return instant_to_utc(F.current_timestamp())


def date_key(clock: Column) -> Column:
    """`yyyyMMdd` text key of the calendar day."""
    return F.replace(clock.cast("date").cast("string"), F.lit("-"), F.lit(""))
