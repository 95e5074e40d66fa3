"""Scalar column expressions shared by every job."""

from pyspark.sql import functions as F

# Fixed value: every character of the Unicode White_Space property.
BLANK_PATTERN = r"^[\s\x85\p{Z}]*$"


def event_time(ms):
    return F.timestamp_millis(ms)


def epoch_ms(ts):
    return F.unix_millis(ts)


def day_key(ts):
    """UTC day as yyyyMMdd text, independent of the session zone."""
    return F.date_format(
        F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86_400).cast("int")), "yyyyMMdd")


def clock_text(ts):
    return F.date_format(ts, "HH:mm:ss")


def whole_second(ts):
    return F.date_trunc("second", ts)


def text_or_empty(text):
    return F.coalesce(text, F.lit(""))


def number_or_zero(number):
    return F.coalesce(number, F.lit(0))


def blank_text(text):
    """True for null, empty and whitespace-only text."""
    return text_or_empty(text).rlike(BLANK_PATTERN)


def byte_length(text):
    return F.octet_length(text_or_empty(text))


def narrow(number):
    return number_or_zero(number).cast("float")


def round_half_up(number, digits=1):
    """Round for display; the cut at nine decimals removes summation noise first."""
    return F.round(number.cast("decimal(38,9)"), digits).cast("double")
