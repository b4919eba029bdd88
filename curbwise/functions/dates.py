"""Date and time Column helpers (Oracle DATE semantics on TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
US_SECONDS = "MM-dd-yyyy HH:mm:ss"
DAY = "yyyy-MM-dd"
PUBLISH_MINUTES = "yyyy-MM-dd'T'HH:mm:00.000"
MICROS_PER_DAY = 86_400_000_000


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(text: str) -> Column:
    """A zone-less timestamp literal, comparable with TIMESTAMP_NTZ columns."""
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def round_day(c: ColumnOrName) -> Column:
    """Oracle ROUND(date, 'DDD'): noon and later rounds up to the next day."""
    return F.to_date(_c(c) + F.expr("INTERVAL 12 HOURS"))


def iso_seconds(c: ColumnOrName) -> Column:
    """TO_CHAR(d, 'YYYY-MM-DD"T"HH24:MI:SS')."""
    return F.date_format(_c(c), ISO_SECONDS)


def us_seconds(c: ColumnOrName) -> Column:
    """TO_CHAR(d, 'MM-DD-YYYY HH24:MI:SS')."""
    return F.date_format(_c(c), US_SECONDS)


def day_text(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), DAY)


def month_name_padded(c: ColumnOrName) -> Column:
    """TO_CHAR(d, 'Month'): full month name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_c(c), "MMMM"), 9, " ")


def micros_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def fractional_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Oracle ``end - start`` on DATEs: a (fractional) number of days."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def floor_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days of ``end - start`` rounded toward minus infinity (Timedelta.days)."""
    return F.floor(micros_between(start, end) / F.lit(float(MICROS_PER_DAY)))


def whole_day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """trunc(end) - trunc(start): difference of calendar days."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def fiscal_quarter(c: ColumnOrName) -> Column:
    """Fiscal quarter with the year starting in October (Oct-Dec = Q1)."""
    m = F.month(_c(c))
    return (F.when(m.isin(10, 11, 12), "Q1").when(m.isin(1, 2, 3), "Q2")
            .when(m.isin(4, 5, 6), "Q3").when(m.isin(7, 8, 9), "Q4"))


def fiscal_year(c: ColumnOrName) -> Column:
    """Fiscal year: October onward counts toward the next calendar year."""
    return F.when(F.month(_c(c)) >= 10, F.year(_c(c)) + 1).otherwise(F.year(_c(c)))


def week_ending_saturday(c: ColumnOrName) -> Column:
    """Label of the Sunday..Saturday week containing the day: its Saturday."""
    return F.next_day(F.date_sub(F.to_date(_c(c)), 1), "SAT")


# Layouts accepted for date/time text: year first, month first, or a month name
# before or after the day; two- or four-digit years after the day; an optional
# time with seconds, fraction and AM/PM; an optional zone (Z, UTC or an offset).
_DATE = (r"(?:(\d{4})[-/](\d{1,2})[-/](\d{1,2})|(\d{1,2})[-/](\d{1,2})[-/](\d{4}|\d{2})"
         r"|([A-Za-z]{3,9})\.?[ -]+(\d{1,2}),?[ -]+(\d{4}|\d{2})|(\d{1,2})[ -]([A-Za-z]{3,9})\.?,?[ -](\d{4}|\d{2}))")
_TIME = r"(?:(?:T|,?\s+)(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?(?:\s*([AaPp])\.?[Mm]\.?)?)?"
_ZONE = r"(?:\s*(?:Z|UTC|GMT)|\s*([+-])(\d{2}):?(\d{2}))?"
_LAYOUT = rf"^\s*{_DATE}{_TIME}{_ZONE}\s*$"
_GROUPS = 20
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _from_parts(parts: Column) -> Column:
    """The timestamp of the pattern's groups (empty where a group took no part)."""
    def part(i: int) -> Column:
        return F.nullif(F.get(parts, F.lit(i - 1)), F.lit(""))

    def number(*groups: int) -> Column:
        return F.coalesce(*[part(g).try_cast("int") for g in groups])

    def named(*groups: int) -> Column:
        at = F.instr(F.lit(_MONTHS), F.lower(F.left(F.coalesce(*[part(g) for g in groups]), F.lit(3))))
        return F.when(at % 3 == 1, F.floor((at + 2) / 3).cast("int"))

    year = number(1, 6, 9, 12)
    short = F.length(F.coalesce(part(1), part(6), part(9), part(12))) == 2
    year = F.when(short, year + F.when(year >= 69, 1900).otherwise(2000)).otherwise(year)
    month, day = F.coalesce(number(2, 4), named(7, 11)), number(3, 5, 8, 10)
    hour, half = F.coalesce(number(13), F.lit(0)), F.lower(part(17))
    hour = F.when(half.isNull(), hour).when((hour < 1) | (hour > 12), F.lit(None)).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.concat(F.coalesce(part(15), F.lit("0")), F.lit("."), F.coalesce(part(16), F.lit("0"))).try_cast("decimal(16,6)")
    at = F.try_make_timestamp_ntz(year, month, day, hour.cast("int"), F.coalesce(number(14), F.lit(0)), second)
    offset = F.coalesce((number(19) * 60 + number(20)) * F.when(part(18) == "-", 1).otherwise(-1), F.lit(0))
    return F.timestamp_add("MINUTE", offset, at)


def parse_mixed_timestamp(c: ColumnOrName, errors: str = "raise") -> Column:
    """Date[/time] text in any accepted layout -> TIMESTAMP_NTZ; NULL and blank text are NULL.

    Other text fails the job with the text in the message; with
    ``errors="null"`` it becomes NULL. Text with a zone is shifted to UTC. The
    text is taken apart once, and the value is built with
    ``try_make_timestamp_ntz``, so it does not depend on the session time zone.
    Two-digit years from 69 on are 19xx, the others 20xx.
    """
    if errors not in ("raise", "null"):
        raise ValueError("errors must be 'raise' or 'null'")
    text = _c(c)
    parts = F.split(F.regexp_replace(text, _LAYOUT, "|".join(f"${i}" for i in range(1, _GROUPS + 1))), r"\|", -1)
    # a one-element transform binds the parts, so that the text is matched once
    at = F.get(F.transform(F.array(parts), _from_parts), F.lit(0))
    value = F.when(text.rlike(_LAYOUT), at)
    if errors == "null":
        return value
    bad = F.raise_error(F.concat(F.lit("not a date or time: "), text)).cast("timestamp_ntz")
    return F.when(text.isNull() | (F.trim(text) == ""), F.lit(None)).otherwise(F.coalesce(value, bad))


def as_timestamp(c: ColumnOrName, dtype: str) -> Column:
    """A timestamp column as TIMESTAMP_NTZ whatever its stored type."""
    col = _c(c)
    if dtype == "string":
        return parse_mixed_timestamp(col)
    if dtype in ("timestamp_ntz",):
        return col
    return col.cast("timestamp_ntz")
