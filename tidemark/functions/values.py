"""Typed values out of text: numbers, dates, service-level buckets, content hash."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Number text that counts as numeric, and the day-first date of a note.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NOTE_DATE_PATTERN = r"(?U)\b(\d{1,2})[/-](\d{1,2})(?:[/-](\d{2,4}))?\b"

# The two accepted date spellings of a snapshot file name, in order of precedence.
FILE_DATE_YEAR_FIRST = r"(?U)(?<!\d)(\d{4})[-_.](\d{1,2})[-_.](\d{1,2})(?!\d)"
FILE_DATE_DAY_FIRST = r"(?U)(?<!\d)(\d{1,2})[-_.](\d{1,2})[-_.](\d{4})(?!\d)"

# First and last day that a nanosecond timestamp can hold.
EARLIEST_NOTE_DATE = "1677-09-22"
LATEST_NOTE_DATE = "2262-04-11"

# A day/month more than this many days ahead belongs to the previous year.
NOTE_LOOKAHEAD_DAYS = 31

# Service-level buckets by days remaining.
OVERDUE = "Overdue"
BUCKET_LIMITS = ((7, "0 to 7 Days"), (15, "8 to 15 Days"), (25, "16 to 25 Days"))
LAST_BUCKET = "26 to 35 Days"

DEFAULT_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")

HASH_SEPARATOR = "\x1f"
HASH_NULL = "<NA>"


@lru_cache(maxsize=1)
def _foreign_digits() -> tuple[str, str]:
    points = [chr(p) for p in range(0x80, sys.maxunicode + 1)]
    digits = [ch for ch in points if unicodedata.category(ch) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.digit(ch)) for ch in digits)


def _digits(text: Column) -> Column:
    """Any script's decimal digits written as 0-9."""
    return F.translate(text, *_foreign_digits())


def _day_of(year: Column, month: Column, day: Column) -> Column:
    """The date of three integers, null when there is no such day.

    The month is checked before it is used, because ``make_date`` raises in ANSI mode.
    """
    first = F.when(month.between(1, 12) & year.between(1, 9999), F.make_date(year, month, F.lit(1)))
    return F.when(day.between(1, F.dayofmonth(F.last_day(first))), F.date_add(first, day - 1))


def whole_number(value: Column) -> Column:
    """Nullable integer of number text; anything not a whole number is null.

    The pattern comes first because a cast alone would accept ``5d``.
    """
    text = value.cast("string")
    exact = text.try_cast("bigint")
    rounded = text.try_cast("double")
    integral = F.when(rounded == F.floor(rounded), rounded.try_cast("bigint"))
    return F.when(text.rlike(NUMBER_PATTERN), F.coalesce(exact, integral))


def _fixed_width_date(text: Column, pattern: str) -> Column:
    """Date of text in a pattern of yyyy, MM, dd and separators, by position."""
    shape = re.escape(pattern)
    for part in ("yyyy", "MM", "dd"):
        shape = shape.replace(part, r"\d{%d}" % len(part))
    pieces = [
        F.substring(text, pattern.index(part) + 1, len(part)) for part in ("yyyy", "MM", "dd")
    ]
    return F.when(text.rlike(f"^{shape}\\z"), F.concat_ws("-", *pieces).try_cast("date"))


def _date_in(text: Column, pattern: str) -> Column:
    letters = re.findall("[A-Za-z]+", pattern)
    if sorted(letters) == ["MM", "dd", "yyyy"]:
        return _fixed_width_date(text, pattern)
    return F.try_to_date(text, pattern)


def _day_of_moment(value: Column) -> Column:
    """The date of an ISO date followed by a time of day, as a workbook's date cells read."""
    return F.when(
        value.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.substring(value, 1, 10).try_cast("date")
    )


def calendar_date(value: Column, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Date of text under the first format that fits, else null; date cells are dates."""
    return F.coalesce(*[_date_in(value, pattern) for pattern in formats], _day_of_moment(value))


def fitting_values(value: Column, formats: Sequence[str]) -> Column:
    """For every format, how many values of a group are a date in it."""
    return F.array(*[F.count(_date_in(value, pattern)) for pattern in formats])


def best_format(counts: Column) -> Column:
    """Place of the format that most values fit, from 0, the first of equals; null if none fits any."""
    most = F.array_max(counts)
    return F.when(most > 0, (F.array_position(counts, most) - 1).cast("int"))


def date_in_format(value: Column, formats: Sequence[str], place: Column) -> Column:
    """Date of text in the format at ``place``, else null; date cells are dates."""
    chosen = [F.when(place == i, _date_in(value, pattern)) for i, pattern in enumerate(formats)]
    return F.coalesce(*chosen, _day_of_moment(value))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def snapshot_date_from_name(name: Column) -> Column:
    """Snapshot date in a file name, null when absent or impossible.

    Only the stem counts. The year-first spelling is tried first, and the first
    spelling found decides: an impossible date in it is not retried day-first.
    """
    stem = F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")
    year_first = F.regexp_extract(stem, FILE_DATE_YEAR_FIRST, 0)
    day_first = F.regexp_extract(stem, FILE_DATE_DAY_FIRST, 0)
    # a year zero is spoiled on purpose: it is an impossible date here, but not for a cast
    ordered = F.when(year_first != "", F.regexp_replace(year_first, "^0000.*|[-_.]", "-")).otherwise(
        F.regexp_replace(day_first, r"(?U)^(\d+)[-_.](\d+)[-_.](?!0000)(\d+)$", "$3-$2-$1")
    )
    return _digits(ordered).try_cast("date")


def note_parts(note: Column) -> Column:
    """Day, month and, if written, year of the first date of a note, as texts."""
    return F.split(F.regexp_extract(note, NOTE_DATE_PATTERN, 0), "[/-]")


def note_number(parts: Column, index: int) -> Column:
    """One of the :func:`note_parts` as a number, null when it is absent."""
    part = F.get(parts, F.lit(index))
    return F.coalesce(part.try_cast("int"), _digits(part).try_cast("int"))


def named_day(day: Column, month: Column, year: Column, snapshot_date: Column) -> Column:
    """The day a note names; a short year is in this century, no year is the snapshot's."""
    century = F.when(year < 100, year + 2000).otherwise(year)
    return _day_of(F.coalesce(century, F.year(snapshot_date)), month, day)


def settled_day(
    named: Column, day: Column, month: Column, year: Column, snapshot_date: Column
) -> Column:
    """The named day, or the year before where no year is written and it is far ahead."""
    too_late = year.isNull() & (named > F.date_add(snapshot_date, NOTE_LOOKAHEAD_DAYS))
    return F.when(too_late, _day_of(F.year(snapshot_date) - 1, month, day)).otherwise(named)


def day_in_range(day: Column) -> Column:
    """Null for days that no nanosecond timestamp can hold."""
    limits = (F.lit(limit).cast("date") for limit in (EARLIEST_NOTE_DATE, LATEST_NOTE_DATE))
    return F.when(day.between(*limits), day)


def with_follow_up_date(frame: DataFrame, note: Column, snapshot_date: Column, name: str) -> DataFrame:
    """Add the first day/month[/year] of a note, seen from its snapshot, as ``name``.

    A two-digit year is in this century. A date without a year that lies more than
    31 days after the snapshot is taken from the previous year. Impossible dates
    and dates no nanosecond timestamp can hold are null.

    Each step names what the next one uses several times, so that Spark keeps the
    projections apart and searches every note once.
    """
    day, month, year = (F.col(f"_note_{part}") for part in ("day", "month", "year"))
    numbers = {f"_note_{p}": note_number(F.col("_note_parts"), i) for i, p in enumerate(("day", "month", "year"))}
    return (
        frame.withColumn("_note_parts", note_parts(note))
        .withColumns(numbers)
        .withColumn("_named", named_day(day, month, year, snapshot_date))
        .withColumn("_settled", settled_day(F.col("_named"), day, month, year, snapshot_date))
        .withColumn(name, F.when(snapshot_date.isNotNull(), day_in_range(F.col("_settled"))))
        .drop("_note_parts", *numbers, "_named", "_settled")
    )


def age_in_days(snapshot_date: Column, event_date: Column) -> Column:
    """Days from the event to the snapshot, negative for a future event."""
    return F.datediff(snapshot_date, event_date)


def record_hash(columns: Iterable[str]) -> Column:
    """16 hex digits over the named columns in name order; null is hashed as ``<NA>``."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit(HASH_NULL)) for name in sorted(columns)]
    return F.substring(F.md5(F.concat_ws(HASH_SEPARATOR, *texts)), 1, 16)


def sla_bucket(days: Column) -> Column:
    """Sheet label that holds a process with this many days remaining."""
    bucket = F.when(days < 0, OVERDUE)
    for limit, label in BUCKET_LIMITS:
        bucket = bucket.when(days <= limit, label)
    return bucket.when(days.isNotNull(), LAST_BUCKET)


def sla_status(days: Column) -> Column:
    return F.when(days < 0, "OVERDUE").when(days.isNotNull(), "ON TIME")
