"""Date column helpers: tolerant parsing, dates hidden in file names, seasons, windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockweave import schemas as S
from stockweave.functions.numbers import as_col, bind
from stockweave.session import cut_lineage

def _clean(c: str | Column) -> Column:
    return F.trim(as_col(c).cast("string"))


def iso_when(c: str | Column) -> Column:
    """yyyy-mm-dd with an optional time; shorter or looser spellings do not count."""
    def read(text: Column) -> Column:
        shaped = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-") & (F.length(text) >= 10)
        return F.when(shaped, text.try_cast("timestamp_ntz"))

    return bind(_clean(c), read)


def day_first_when(c: str | Column) -> Column:
    """dd-mm-yyyy with -, / or . and an optional time.

    Where the middle part cannot be a month the value is read month first, the
    way lenient day-first parsers do. The number of colons picks the one format
    that can fit, so a clean value is parsed exactly once.
    """
    def read(text: Column) -> Column:
        colons = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit("")))

        def ordered(order: str) -> Column:
            return (
                F.when(colons == 0, F.try_to_timestamp(text, F.lit(f"{order}-yyyy")))
                .when(colons == 1, F.try_to_timestamp(text, F.lit(f"{order}-yyyy H:mm")))
                .otherwise(F.try_to_timestamp(text, F.lit(f"{order}-yyyy H:mm:ss")))
            )

        # A dash in second or third place; anything else is not this kind of date.
        shaped = F.instr(F.substring(text, 2, 2), "-") > 0
        return F.when(shaped, F.coalesce(ordered("d-M"), ordered("M-d")))

    return bind(F.translate(_clean(c), "/.T", "-- "), read).cast("timestamp_ntz")


def parse_when(c: str | Column) -> Column:
    """Per value: ISO if it is ISO, only otherwise day first."""
    return F.coalesce(iso_when(c), day_first_when(c))


def iso_share(c: str | Column) -> Column:
    """Aggregate: true when at least nine of ten non-blank values are ISO."""
    text = _clean(c)
    return F.count(iso_when(c)) >= F.count(F.when(text != "", 1)) * F.lit(0.9)


def parse_dates(
    df: DataFrame, columns: str | Sequence[str], by: str | None = None, into: str | None = None
) -> DataFrame:
    """Column-level choice between ISO and day first, one choice per ``by`` group.

    The choices for all columns are one aggregate row per group, found in one pass.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    shares = [iso_share(c).alias(f"_iso{i}") for i, c in enumerate(columns)]
    if by is None:
        out = df.crossJoin(F.broadcast(df.agg(*shares)))  # one row
    else:
        # One row per group, written down: its size is known when the join is planned.
        choice = cut_lineage(df.groupBy(F.col(by).alias("_by")).agg(*shares), "date-choice")
        out = df.join(choice, F.col(by) == F.col("_by"), "left").drop("_by")
    for i, c in enumerate(columns):
        # With the day-first policy a lenient parser still reads leftover ISO text.
        both = F.coalesce(day_first_when(c), iso_when(c))
        out = out.withColumn(into or c, F.when(F.col(f"_iso{i}"), iso_when(c)).otherwise(both))
    return out.drop(*[f"_iso{i}" for i in range(len(columns))])


# A date or a pair of dates inside a file name, tried in this order.
_NAME_PATTERNS = (
    ("(\\d{1,2}-\\d{1,2}-\\d{4})[_-](\\d{1,2}-\\d{1,2}-\\d{4})", "d-M-yyyy", 2),
    ("(\\d{4}-\\d{2}-\\d{2})[_-](\\d{4}-\\d{2}-\\d{2})", "yyyy-M-d", 2),
    ("(\\d{1,2}-\\d{1,2}-\\d{4})", "d-M-yyyy", 1),
    ("(\\d{4}-\\d{2}-\\d{2})", "yyyy-M-d", 1),
)


def _day(text: Column, fmt: str) -> Column:
    # An unmatched pattern extracts '', which the tolerant parser turns into null.
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit(fmt)).cast("date")


def period_from_name(c: str | Column) -> Column:
    """struct(start, end) of the period a file name states."""
    name = as_col(c)
    found = None
    for pattern, fmt, parts in _NAME_PATTERNS:
        start = _day(F.regexp_extract(name, pattern, 1), fmt)
        end = _day(F.regexp_extract(name, pattern, 2), fmt) if parts == 2 else start
        pair = F.struct(start.alias("start"), end.alias("end"))
        found = F.when(start.isNotNull(), pair) if found is None else found.when(start.isNotNull(), pair)
    return found.otherwise(F.lit(None))


def month_number(c: str | Column) -> Column:
    """1..12 from the first three letters of a month name."""
    names = F.array(*[F.lit(m) for m in S.MONTHS])
    return F.nullif(F.array_position(names, F.upper(F.substring(as_col(c), 1, 3))), F.lit(0).cast("long")).cast("int")


def worded_date(c: str | Column) -> Column:
    """A date such as '17th Aug 2026' anywhere in a text."""
    pattern = "(\\d{1,2})\\w*\\s+([A-Za-z]{3})\\w*\\s+(\\d{4})"
    day, name, year = (F.regexp_extract(as_col(c), pattern, i) for i in (1, 2, 3))
    stamp = F.concat_ws("-", year, F.lpad(month_number(name).cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(month_number(name).isNotNull(), stamp).try_cast("date")


def stamped_date(c: str | Column) -> Column:
    """Timestamp of a 14-digit ddMMyyyyHHmmss stamp in a file name."""
    stamp = F.nullif(F.regexp_extract(as_col(c), "(\\d{14})", 1), F.lit(""))
    return F.try_to_timestamp(stamp, F.lit("ddMMyyyyHHmmss")).cast("timestamp_ntz")


def snapshot_date(name: str | Column, heading: str | Column | None = None) -> Column:
    """Snapshot day: from the file name, else from the lines above the header."""
    from_name = period_from_name(name)["start"]
    return from_name if heading is None else F.coalesce(from_name, worded_date(heading))


def warehouse_snapshot(name: str | Column) -> Column:
    """Warehouse files carry a full stamp; it wins over a plain date."""
    has_stamp = as_col(name).rlike("\\d{14}")
    return F.when(has_stamp, stamped_date(name)).otherwise(period_from_name(name)["start"].cast("timestamp_ntz"))


def month_to_period(month: str | Column, reference: str | Column, year: int | None = None) -> Column:
    """struct(start, end) of a month without a year: its latest run not after ``reference``."""
    m = month_number(month)
    ref_year, ref_month = F.year(as_col(reference)), F.month(as_col(reference))
    # An unreadable month counts as January of the year before.
    chosen = F.lit(year) if year else F.when(m <= ref_month, ref_year).otherwise(ref_year - 1)
    start = F.make_date(chosen, F.coalesce(m, F.lit(1)), F.lit(1))
    return F.struct(start.alias("start"), F.last_day(start).alias("end"))


def season_date(c: str | Column) -> Column:
    """Arrival date coded in a style: SS25 is February 2025, AW24 August 2024.

    A season without a year dates from the fixed legacy day.
    """
    code = F.upper(as_col(c))
    dated = "\\b(SS|AW)(\\d{2})"
    year = F.regexp_extract(code, dated, 2).try_cast("int")
    month = F.when(F.regexp_extract(code, dated, 1) == "SS", S.SEASON_MONTH["SS"]).otherwise(S.SEASON_MONTH["AW"])
    return (
        F.when(year.between(15, 60), F.make_date(F.lit(2000) + year, month, F.lit(1)))
        .when(code.rlike("\\b(SS|AW)\\b"), F.lit(S.UNDATED_SEASON).cast("date"))
    )


def back_fill_start(end: str | Column, period_days: int) -> Column:
    """First day of a period of ``period_days`` that ends on ``end``."""
    return F.date_sub(as_col(end), period_days - 1)


def to_local(c: str | Column, zone: str = S.REPORT_ZONE) -> Column:
    """A UTC instant as wall-clock time where the reports are read."""
    return F.from_utc_timestamp(as_col(c), zone)


def period_label(start: dt.date, end: dt.date) -> str:
    a, b = S.MONTHS[start.month - 1].title(), S.MONTHS[end.month - 1].title()
    return a if a == b else f"{a}-{b}"


def period_label_col(start: str | Column, end: str | Column) -> Column:
    a, b = F.date_format(as_col(start), "MMM"), F.date_format(as_col(end), "MMM")
    return F.when(a == b, a).otherwise(F.concat_ws("-", a, b))


def windows(asof: dt.date, period_days: int = S.PERIOD_DAYS, recent_days: int = S.RECENT_DAYS):
    """(period start, recent start) as plain dates, so they fold into literals."""
    return (
        asof - dt.timedelta(days=period_days - 1),
        asof - dt.timedelta(days=recent_days - 1),
    )


def overlaps(start: dt.date, end: dt.date, first: str = "period_start", last: str = "period_end") -> Column:
    """Rows whose own period touches [start, end]."""
    return (F.col(last) >= F.lit(start)) & (F.col(first) <= F.lit(end))
