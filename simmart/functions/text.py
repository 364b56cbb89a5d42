"""Text predicates and the month stamp of target files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """True for NULL and for text made of Unicode white space only."""
    return text.isNull() | text.rlike(r"(?U)^[\s\x1c-\x1f]*$")


def month_stamp(day: Column) -> Column:
    """``MM_YYYY`` of a date or timestamp."""
    return F.date_format(day, "MM_yyyy")


def month_of_file(name: Column) -> Column:
    """First day of the month in a ``data_MM_YYYY`` file name, NULL when there is none."""
    stamp = F.regexp_extract(name, r"data_(\d{2}_\d{4})", 1)
    return F.to_date(F.try_to_timestamp(F.when(stamp != "", stamp), F.lit("MM_yyyy")))


def csv_field_count(line: Column) -> Column:
    """Number of comma-separated fields in one raw line; commas inside quotes do not count."""
    # A doubled quote ends one quoted piece and starts the next. No group is repeated, which would take stack per character.
    unquoted = F.regexp_replace(line, r'"[^"]*"', "")
    return F.length(F.regexp_replace(unquoted, "[^,]", "")) + 1
