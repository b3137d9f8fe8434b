"""Column expressions on event times and days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchtide.functions.text import SPACE
from searchtide.vocab import ARABIC_DIGITS, EXTENDED_ARABIC_DIGITS, LOCAL_OFFSET_HOURS, SESSION_SECONDS

#: a date, an hour of one or two digits, minutes, seconds, an optional fraction, then anything;
#: the second branch makes the pattern match every text, so a text without a time loses all its groups
_MOMENT = rf"(?s)^(?:{SPACE}*(\d{{4}}-\d\d-\d\d){SPACE}+(\d\d?):(\d\d):(\d\d)(?:\.(\d+))?.*|.*)$"
_PADDED = "$1 0$2:$3:$4.$5000"
_NO_GROUPS = " 0::.000"
#: times that need no repair
_CLEAN_MOMENT = r"^(?!2565)\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}$"


def repaired_datetime(text: Column) -> Column:
    """Event time as ``yyyy-MM-dd HH:mm:ss.SSS``, or null where no time can be read.

    Arabic digits become ASCII, the one known Buddhist-calendar year becomes its common-era year,
    the hour is padded and the fraction is cut (not rounded) to milliseconds.
    """
    ascii_text = F.translate(text, ARABIC_DIGITS + EXTENDED_ARABIC_DIGITS, "0123456789" * 2)
    padded = F.regexp_replace(ascii_text, _MOMENT, _PADDED)
    two_digit_hour = F.regexp_replace(padded, r" 0(\d\d:)", " $1")
    return F.replace(F.nullif(F.left(two_digit_hour, F.lit(23)), F.lit(_NO_GROUPS)), F.lit("2565-"), F.lit("2022-"))


def event_moment(text: Column) -> Column:
    """Event time as a timestamp; null where the text holds none (month 13, no date, ...).

    Clean texts skip the repair.
    """
    clean = text.rlike(_CLEAN_MOMENT)
    return F.when(clean, text.try_cast("timestamp")).otherwise(repaired_datetime(text).try_cast("timestamp"))


def local_hour(moment: Column) -> Column:
    return F.hour(moment + F.expr(f"INTERVAL {LOCAL_OFFSET_HOURS} HOURS"))


def session_slot(moment: Column) -> Column:
    """Number of the fixed half-hour slot since 1970, as text."""
    return F.floor(F.unix_seconds(moment) / F.lit(SESSION_SECONDS)).cast("string")


def iso_day(day: Column) -> Column:
    """``20220601`` as ``2022-06-01``; other texts stay as they are."""
    return F.when(F.length(day) == 8, F.regexp_replace(day, r"(?s)^(.{4})(.{2})(.{2})$", "$1-$2-$3")).otherwise(day)
