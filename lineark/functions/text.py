"""Record text: timestamps in the record format, log defaults, interface names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The record time format (weekday, month name, 12-hour clock, no AM/PM).
RECORD_TIME_FORMAT = "EEEE, MMMM dd, yyyy hh:mm:ss"
RECORD_TIME_PARSE = "MMMM dd, yyyy hh:mm:ss"
UNRECOGNISED_LOG = "Command Unrecognized."


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_record_time(ts) -> Column:
    """Timestamp -> ``'Monday, January 01, 2024 01:05:00'`` (no AM/PM marker)."""
    return F.date_format(_c(ts), RECORD_TIME_FORMAT)


def from_record_time(text) -> Column:
    """Record time text -> TIMESTAMP_NTZ.  The weekday is dropped before parsing and
    the hour is read as AM, since the text carries no marker."""
    rest = F.regexp_replace(_c(text), r"^[^,]*,\s*", "")
    return F.try_to_timestamp(rest, F.lit(RECORD_TIME_PARSE)).cast("timestamp_ntz")


def log_default(status, log) -> Column:
    """A failed job with an empty log reports ``'Command Unrecognized.'``."""
    return F.when((_c(status) == "Failed") & (_c(log) == ""), F.lit(UNRECOGNISED_LOG)).otherwise(_c(log))


def interface_name(type_text) -> Column:
    """``"<class 'a.b.C'>" -> 'a.b.C'`` (text between the first two quotes)."""
    return F.split_part(_c(type_text), F.lit("'"), F.lit(2))
