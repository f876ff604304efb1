"""Column expressions shared by shaping, staging and marts. All built-in, no UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NANOS = 1_000_000_000


def build_session_id(season: str, round_number: str, session_type: str) -> Column:
    """``{season}_{round}_{type}``, not zero-padded; NULL when any part is missing."""
    return F.concat(
        F.col(season).cast("string"), F.lit("_"),
        F.col(round_number).cast("string"), F.lit("_"), F.col(session_type),
    )


def clean_real(value: Column) -> Column:
    """NaN (pandas' missing number) becomes NULL."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def to_real(name: str) -> Column:
    """Numeric coercion: text that is no number becomes NULL instead of failing.

    A number is digits with an optional sign, point and exponent; ``1d`` or ``2f`` is none.
    """
    text = F.trim(F.col(name).cast("string"))
    number = text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return clean_real(F.when(number, text.try_cast("double")))


def whole_number(value: Column) -> Column:
    """Float to 64-bit integer, rounding halves away from zero."""
    return F.round(clean_real(value)).cast("bigint")


def _duration_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def duration_seconds(df: DataFrame, name: str) -> Column:
    """A duration column as seconds, whichever way the feed stored it.

    Accepts a day-time interval, whole nanoseconds, or a number of seconds.
    """
    kind = _duration_type(df, name)
    if isinstance(kind, T.DayTimeIntervalType):
        return F.col(name).cast("interval second").cast("decimal(20,6)").cast("double")
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.col(name).cast("double") / F.lit(float(NANOS))
    return clean_real(F.col(name))


def duration_text(df: DataFrame, name: str) -> Column:
    """A duration as text such as ``0 days 01:31:44.742000``; missing is ``NaT``.

    A column that already is text passes through, with ``NaT`` for NULL.
    """
    kind = _duration_type(df, name)
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(name), F.lit("NaT"))
    if isinstance(kind, (T.LongType, T.IntegerType)):
        micros = F.floor(F.col(name).cast("decimal(20,0)") / 1000).cast("bigint")
    else:
        micros = F.floor(duration_seconds(df, name).cast("decimal(20,6)") * 1_000_000).cast("bigint")
    # Days carry the sign, the clock part is never negative.
    day = F.lit(86_400_000_000)
    days = F.floor(micros / day).cast("bigint")
    rest = F.pmod(micros, day)
    clock = F.format_string(
        "%s%02d:%02d:%02d",
        F.when(days < 0, F.lit("+")).otherwise(F.lit("")),
        F.floor(rest / 3_600_000_000).cast("int"),
        F.floor(rest / 60_000_000).cast("int") % 60,
        F.floor(rest / 1_000_000).cast("int") % 60,
    )
    fraction = F.when(
        rest % 1_000_000 != 0, F.format_string(".%06d", (rest % 1_000_000).cast("int"))
    ).otherwise(F.lit(""))
    return F.coalesce(
        F.concat(days.cast("string"), F.lit(" days "), clock, fraction), F.lit("NaT")
    )


def session_type_name(session_type: str) -> Column:
    """R is Race, Q is Qualifying, anything else stays as it is."""
    code = F.col(session_type)
    return F.when(code == "R", "Race").when(code == "Q", "Qualifying").otherwise(code)


def race_name(season: str, country: str) -> Column:
    """``2024 Bahrain Grand Prix``; NULL when either part is NULL."""
    return F.concat(
        F.col(season).cast("string"), F.lit(" "), F.col(country), F.lit(" Grand Prix")
    )


def is_classified(status: str) -> Column:
    """True for a finisher or a lapped finisher; any other or missing status is false."""
    code = F.col(status)
    return F.coalesce((code == "Finished") | code.startswith("+"), F.lit(False))
