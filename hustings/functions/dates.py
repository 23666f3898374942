"""Dates and clock times in texts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Months in Welsh, in the calendar's order.
WELSH_MONTHS = ("Ionawr", "Chwefror", "Mawrth", "Ebrill", "Mai", "Mehefin", "Gorffennaf", "Awst", "Medi", "Hydref", "Tachwedd", "Rhagfyr")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def parse_date(s: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "d MMMM yyyy", "dd/MM/yyyy")) -> Column:
    """A date by the first format that fits, else null. A weekday and comma in front is passed over."""
    bare = F.regexp_replace(F.trim(s), r"^[A-Za-z]+day,? ", "")
    return F.coalesce(*(F.try_to_timestamp(bare, F.lit(f)).cast("date") for f in formats))


def english_months(s: Column) -> Column:
    for welsh, english in zip(WELSH_MONTHS, MONTHS, strict=True):
        s = F.regexp_replace(s, f"(?i)\\b{welsh}\\b", english)
    return s


def date_in(s: Column) -> Column:
    """The first ISO date in a text such as a file's name, or null if there is none or it is no day."""
    return F.nullif(F.regexp_extract(s, r"(?<!\d)(\d{4}-\d{2}-\d{2})(?!\d)", 1), F.lit("")).try_cast("date")


def clock(s: Column) -> Column:
    """HH:MM:SS of a time as spoken of: '2.30 pm', '14:05', 'noon', 'midnight', '10 o'clock'; else null."""
    low = F.lower(F.trim(s))
    hour, minute, second, half = (F.regexp_extract(low, r"(\d{1,2})(?:[.:](\d{2}))?(?:[.:](\d{2}))?\s*(?:o'clock\s*)?([ap])?\.?m?\.?", i) for i in (1, 2, 3, 4))
    h = hour.try_cast("int")
    h = F.when((half == "p") & (h < 12), h + 12).when((half == "a") & (h == 12), 0).otherwise(h)
    n = lambda x: F.coalesce(F.nullif(x, F.lit("")).cast("int"), F.lit(0))
    return F.when(low.rlike("noon|midday"), "12:00:00").when(low.rlike("midnight"), "00:00:00").when(h.isNotNull() & (h < 24) & (n(minute) < 60), F.format_string("%02d:%02d:%02d", h, n(minute), n(second)))


CLOCK = re.compile(r"(\d{1,2})(?:[.:](\d{2}))?(?:[.:](\d{2}))?\s*(?:o'clock\s*)?([ap])?\.?m?\.?", re.A)


def clock_of(text: str) -> str | None:
    """clock() of one text, for tasks that hold it in Python."""
    low = text.strip(" ").lower()
    if "noon" in low or "midday" in low:
        return "12:00:00"
    if "midnight" in low:
        return "00:00:00"
    found = CLOCK.search(low)
    if found is None:
        return None
    hour, minute, second = int(found[1]), int(found[2] or 0), int(found[3] or 0)
    hour = hour + 12 if found[4] == "p" and hour < 12 else 0 if found[4] == "a" and hour == 12 else hour
    return f"{hour:02d}:{minute:02d}:{second:02d}" if hour < 24 and minute < 60 else None


def minutes_of_day(hms: Column) -> Column:
    return F.split_part(hms, F.lit(":"), F.lit(1)).cast("int") * 60 + F.split_part(hms, F.lit(":"), F.lit(2)).cast("int")


def previous_sitting_day(day: Column) -> Column:
    """The weekday before a date: Friday for Saturday, Sunday and Monday."""
    return F.date_sub(day, F.when(F.dayofweek(day) == 2, 3).when(F.dayofweek(day) == 1, 2).otherwise(1))


def session_name(s: Column) -> Column:
    """'2016_2017' as '2016-17'."""
    return F.regexp_replace(s, r"(\d{4})_\d{2}(\d{2})", "$1-$2")


@F.pandas_udf(T.DateType())
def fuzzy_date(s: pd.Series) -> pd.Series:
    """A date written in any usual way, day first, or null."""
    from dateutil import parser

    def one(x):
        try:
            return parser.parse(x, dayfirst=True, fuzzy=True).date() if x else None
        except (ValueError, OverflowError):
            return None

    return s.map(one)
