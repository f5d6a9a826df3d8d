"""Dates in records: short calendar dates, time stamps, ranges, and telling dates from identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "dd MMM yyyy", "MMM dd, yyyy", "yyyyMMdd", "yyyy-MM", "yyyy")


def short_date(c: Column) -> Column:
    """4 to 8 digits as an ISO date; '' for words and impossible dates."""
    month = F.when(F.length(c) > 4, F.substring(c, 5, 2)).otherwise("1")
    day = F.when(F.length(c) > 6, F.substring(c, 7, 100)).otherwise("1")
    d = F.try_to_date(F.concat_ws("-", F.substring(c, 1, 4), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")
    return F.coalesce(F.when(c.rlike("^[0-9]{4,8}$"), F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")), F.lit(""))


def timestamp(c: Column) -> Column:
    """A time stamp in any of the usual forms; null if it is none."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in _FORMATS])


def time_range(c: Column) -> Column:
    """struct(begin, end) of a comma list of moments or begin/end/period spans; what cannot be read is skipped."""
    parts = F.transform(F.split(c, ","), lambda p: F.slice(F.split(F.trim(p), "/"), 1, 2))
    t = F.filter(F.transform(F.flatten(parts), lambda x: timestamp(F.trim(x))), lambda x: x.isNotNull())
    return F.when(F.size(t) > 0, F.struct(F.array_min(t).alias("begin"), F.array_max(t).alias("end")))


def looks_like_date(c: Column) -> Column:
    """Whether a lenient date parser would take the text for a date: such tokens are no identifiers."""
    shape = c.rlike(
        r"(?i)^(?:\d{1,2}|\d{4}|\d{6}|\d{8}|\d{12}|\d{14}"
        r"|\d{4}[-/.]\d{1,2}(?:[-/.]\d{1,2})?(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2})?"
        r"|\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}|\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:\s?[ap]m)?"
        r"|\d{1,2}[- ]?(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[- ,]*\d{2,4}"
        r"|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*(?:[ .]\d{1,2},?)?(?: \d{4})?"
        r"|(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*)$"
    )
    other = c.rlike(r"^\d{2}/\d{2}/\d{4} \[\d{2}:\d{2}:\d{2}:\d+\]$|^\d{2}:\d{2}:\d{8}$")
    return F.coalesce(shape | other, F.lit(False))


def strip_dates(c: Column) -> Column:
    """'' for a text that as a whole is a date, else the text."""
    return F.when(looks_like_date(c), "").otherwise(c)
