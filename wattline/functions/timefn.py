"""Wall-clock time as Columns.

Times are TIMESTAMP_NTZ or, inside operators, the number of wall-clock seconds
since 1970 (a bigint): a fixed-width key that hashes and compares fast and does
not depend on the session zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.schemas import COMPACT_PATTERN, STEP_SECONDS, ZONE_OFFSET_HOURS

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def seconds_of(ts: Column) -> Column:
    """Wall-clock seconds of a TIMESTAMP_NTZ; ``timestampdiff`` would go through the session zone."""
    return (ts - _epoch()).cast("interval second").cast("bigint")


def time_of(seconds: Column) -> Column:
    """TIMESTAMP_NTZ of wall-clock seconds."""
    return F.timestamp_add("SECOND", seconds, _epoch())


def text_of(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of wall-clock seconds."""
    return time_of(seconds).cast("string")


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to TIMESTAMP_NTZ; null where the text has another shape."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), text.try_cast("timestamp_ntz"))


def parse_date(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def parse_compact(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(COMPACT_PATTERN))


def format_time(ts: Column) -> Column:
    """Text of a TIMESTAMP_NTZ; ``date_format`` would go through the session zone and its gaps."""
    return text_of(seconds_of(ts))


def format_date(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def format_compact(ts: Column) -> Column:
    return F.regexp_replace(format_time(ts), "[^0-9]", "")


def epoch_seconds(seconds: Column, offset_hours: int = ZONE_OFFSET_HOURS) -> Column:
    """Instant in epoch seconds of wall-clock seconds at a fixed zone offset."""
    return seconds - F.lit(offset_hours * 3600)


def epoch_millis(seconds: Column, offset_hours: int = ZONE_OFFSET_HOURS) -> Column:
    return epoch_seconds(seconds, offset_hours) * 1000


def seconds_from_epoch(epoch: Column, offset_hours: int = ZONE_OFFSET_HOURS) -> Column:
    """Wall-clock seconds at a fixed zone offset of an instant in epoch seconds."""
    return epoch + F.lit(offset_hours * 3600)


def millis_text(millis: Column, offset_hours: int = ZONE_OFFSET_HOURS) -> Column:
    """Epoch milliseconds as wall-clock text."""
    return text_of(seconds_from_epoch(F.floor(millis / 1000), offset_hours))


def _date(seconds: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def _midnight(date: Column) -> Column:
    return F.unix_date(date).cast("bigint") * 86400


def step_start(seconds: Column, step: str) -> Column:
    """Start of the half-open step a moment lies in."""
    if step in STEP_SECONDS:
        return seconds - F.pmod(seconds, F.lit(STEP_SECONDS[step]))
    return _midnight(F.trunc(_date(seconds), "MM" if step == "1n" else "YEAR"))


def step_after(start: Column, step: str) -> Column:
    """Start of the step that follows the one starting at ``start``."""
    if step in STEP_SECONDS:
        return start + STEP_SECONDS[step]
    return _midnight(F.add_months(_date(start), 1 if step == "1n" else 12))


def step_before(start: Column, step: str) -> Column:
    """Start of the step that precedes the one starting at ``start``."""
    if step in STEP_SECONDS:
        return start - STEP_SECONDS[step]
    return _midnight(F.add_months(_date(start), -1 if step == "1n" else -12))


def day_number(seconds: Column) -> Column:
    return F.floor(seconds / 86400).cast("int")


def year_number(seconds: Column) -> Column:
    return F.year(_date(seconds))


def period_days(start: Column, end: Column) -> Column:
    """Day field of the calendar period between two dates (what whole months leave over)."""
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    days = F.day(end) - F.day(start)
    return (
        F.when((months > 0) & (days < 0), F.date_diff(end, F.add_months(start, months - 1)))
        .when((months < 0) & (days > 0), days - F.day(F.last_day(end)))
        .otherwise(days)
    )


def whole_units_between(start: Column, end: Column, seconds: int) -> Column:
    """Whole units of so many seconds between two moments, cut towards zero."""
    return ((seconds_of(end) - seconds_of(start)) / seconds).cast("bigint")


def millis_between(start: Column, end: Column) -> Column:
    return ((end - start).cast("interval second").cast("decimal(20,6)") * 1000).cast("bigint")


def is_same_day(date: Column, today: Column) -> Column:
    return date == today


def first_day_of_month(date: Column) -> Column:
    return F.trunc(date, "MM")


def last_day_of_month(date: Column) -> Column:
    return F.last_day(date)


def first_monday_of_month(date: Column) -> Column:
    return F.next_day(F.date_sub(F.trunc(date, "MM"), 1), "MON")


def weeks_later(date: Column, weeks: int = 2) -> Column:
    return F.date_add(date, 7 * weeks)


def months_later(date: Column, months: int) -> Column:
    return F.add_months(date, months)
