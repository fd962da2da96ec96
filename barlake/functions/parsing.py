"""Text to typed values, and keys out of file names. All expressions run inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# A bare clock time would read as "today", so text must start with a four-digit year, or have one of
# the other forms.
_HAS_YEAR = r"^\s*\d{4}-"
# Month names in their order; three letters and "sept" stand for them as well.
_MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
_MONTH = "(" + "|".join([f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in _MONTHS] + ["sept"]) + r")\.?"
#: Form of a date that is not written year-month-day, and how it is then written.
_NUMBERED_FORMS = {
    r"^(\d{4})$": "$1-01-01",
    r"^(\d{4})(\d{2})(\d{2})$": "$1-$2-$3",
    r"^(\d{4})(\d{2})(\d{2})[T ]?(\d{2})(\d{2})(\d{2})(?!\d)": "$1-$2-$3 $4:$5:$6",
    r"^(\d{4})/(\d{1,2})/(\d{1,2})(?!\d)": "$1-$2-$3",
    r"^(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)": "$3-$1-$2",
}
#: Forms with a month name, and the groups of their day, month and year.
_NAMED_FORMS = {
    rf"(?i)^{_MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?!\d)": (2, 1, 3),
    rf"(?i)^(\d{{1,2}})(?:st|nd|rd|th)?[\s-]+{_MONTH}[\s,-]+(\d{{4}})(?!\d)": (1, 2, 3),
}
_HALF_DAY = r"(?i)^(\S+)[T\s]+(\d{1,2})((?::\d{2}){0,2}(?:\.\d+)?)\s*([ap])\.?m\.?$"
_NO_SECONDS = r"^(\S+[T\s]+\d{1,2}:\d{2})\s*((?:[+-]\d|Z).*)$"
# Spark reads "5d" and "5f" as numbers; as bar values they are bad text.
_TYPE_SUFFIXES = ("d", "D", "f", "F")
_INFINITE = ("inf", "+inf", "-inf")


def to_number(text: Column) -> Column:
    """SCL-7: text to double; bad text and NaN become NULL."""
    plain = F.trim(text)
    suffixed = reduce(or_, [plain.endswith(s) for s in _TYPE_SUFFIXES]) & ~F.lower(plain).isin(*_INFINITE)
    return F.nullif(F.when(~suffixed, plain.try_cast("double")), F.lit(float("nan")))


def _in_range(time: Column) -> Column:
    """Times of years that every reader of the lake can hold; others are no times."""
    return F.when(F.year(time).between(1, 9999), time)


def _month_number(name: Column) -> Column:
    """1 to 12 from a month name or its first letters."""
    letters = "".join(m[:3] for m in _MONTHS)
    return ((F.instr(F.lit(letters), F.lower(F.substring(name, 1, 3))) + 2) / 3).cast("int").cast("string")


def _year_first(text: Column) -> Column:
    """Text of any known form with its date as year-month-day and its clock of 24 hours; NULL for other text."""
    plain = F.trim(text)
    dated = F.when(plain.rlike(_HAS_YEAR), plain)
    for form, written in _NUMBERED_FORMS.items():
        dated = dated.when(plain.rlike(form), F.regexp_replace(plain, form, written))
    for form, (day, month, year) in _NAMED_FORMS.items():
        part = lambda group, form=form: F.regexp_extract(plain, form, group)
        date = F.concat_ws("-", part(year), _month_number(part(month)), part(day))
        dated = dated.when(plain.rlike(form), F.concat(date, F.regexp_replace(plain, form, "")))
    return dated


def _plain_clock(dated: Column) -> Column:
    """Half days to 24 hours; seconds where an offset follows the minutes."""
    part = lambda group: F.regexp_extract(dated, _HALF_DAY, group)
    hour = part(2).try_cast("int")
    hour = F.when(hour.between(1, 12), hour % 12 + F.when(F.lower(part(4)) == "p", 12).otherwise(0))
    minutes = F.when(part(3) == "", ":00").otherwise(part(3))
    return F.when(dated.rlike(_HALF_DAY), F.concat(part(1), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), minutes)).otherwise(
        F.regexp_replace(dated, _NO_SECONDS, "$1:00$2")
    )


def _rewritten(text: Column) -> Column:
    """The rewritten text of the few values that are no plain year-first times.

    A function over a list of one keeps these many patterns out of the generated code of the usual path.
    """
    return F.get(F.transform(F.transform(F.array(text), _year_first), _plain_clock), F.lit(0))


def to_bar_date(text: Column) -> Column:
    """SCL-1: text to DATE, keeping the written day when an offset follows."""
    dated = F.when(text.rlike(_HAS_YEAR), text.try_cast("timestamp_ntz"))
    return _in_range(F.coalesce(dated, _rewritten(text).try_cast("timestamp_ntz")).cast("date"))


def to_utc_wall_time(text: Column) -> Column:
    """SCL-2, SCL-4: text with any offset to zone-free UTC time (session zone is UTC)."""
    timed = F.when(text.rlike(_HAS_YEAR), F.try_to_timestamp(text))
    return _in_range(F.coalesce(timed, _rewritten(text).try_cast("timestamp")).cast("timestamp_ntz"))


def to_utc_instant(value: Column) -> Column:
    """SCL-3: text or zone-free UTC time to a zone-aware instant."""
    return value.cast("timestamp")


def drop_zone(instant: Column) -> Column:
    """SCL-5, SCL-6: zone-aware instant to zone-free UTC time; NULL stays NULL."""
    return instant.cast("timestamp_ntz")


def decoded_file_name(encoded: Column) -> Column:
    """File name as written on disk: undo the URL encoding of file metadata but keep ``+``."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def file_stem(name: Column) -> Column:
    """SCL-10: file name without ``.csv``."""
    return F.regexp_replace(name, r"\.csv$", "")


def ticker_of(stem: Column) -> Column:
    """SRC-9: first ``_`` token."""
    return F.split(stem, "_").getItem(0)


def timeframe_of(stem: Column) -> Column:
    """SRC-9: last ``_`` token."""
    return F.element_at(F.split(stem, "_"), -1)


def csv_cells(line: Column) -> Column:
    """One CSV line to its raw cells. Quotes are honoured where present."""
    outside_quotes = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    quoted = F.transform(
        F.split(line, outside_quotes),
        lambda c: F.replace(F.regexp_replace(c, r'^\s*"|"\s*$', ""), F.lit('""'), F.lit('"')),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ","))


def cell_text(cell: Column) -> Column:
    """A cell without surrounding blanks; an empty one is missing."""
    return F.nullif(F.trim(cell), F.lit(""))
