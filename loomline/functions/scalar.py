"""Scalar functions on columns; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unquote(c: Column) -> Column:
    """Without one quotation mark at each end."""
    return F.regexp_replace(c, '^"|"$', "")


def without_quotes(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit(""))


def without_returns(c: Column) -> Column:
    """Without carriage returns at the end."""
    return F.regexp_replace(c, "\r+$", "")


def decimal_comma(c: Column, digits: int = 6) -> Column:
    """A number as text, rounded, with a comma for the point."""
    return F.replace(F.round(c, digits).cast("string"), F.lit("."), F.lit(","))


def letters_only(c: Column) -> Column:
    """Without digits and punctuation."""
    return F.regexp_replace(c, r"[\p{Punct}\d]", "")


def edge_label(a: Column, b: Column) -> Column:
    return F.concat_ws("-", a, b)


def joined(c: Column) -> Column:
    """The elements of an array as text."""
    return F.array_join(c.cast("array<string>"), ", ")


def truth_text(c: Column) -> Column:
    return F.when(c, "True").when(~c, "False")


def nearest_day(ts: Column) -> Column:
    """Midnight of the nearest day; noon goes up."""
    return F.date_trunc("DAY", ts + F.expr("interval 12 hours"))


def add_days(ds: Column, days: int) -> Column:
    """An ISO date moved by days, as text."""
    return F.date_format(F.date_add(F.to_date(ds), days), "yyyy-MM-dd")


def reformat_date(ds: Column, source: str, target: str) -> Column:
    return F.date_format(F.to_timestamp(ds, source), target)


def loop_percent(unique: Column, total: Column) -> Column:
    return (1 - unique / F.nullif(total, F.lit(0))) * 100


def whole_sum(c: Column) -> Column:
    """The sum of 64-bit integers, exact beyond 64 bits and rounded once to a double; null of none.

    It does not depend on the order of the rows, as a sum of doubles does.
    """
    return F.sum(c.cast("decimal(19,0)")).cast("double")


def whole_mean(c: Column) -> Column:
    """The mean of 64-bit integers from their exact sum; null of none."""
    return whole_sum(c) / F.nullif(F.count(c), F.lit(0))


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over rows with a non-zero actual value."""
    return F.avg(F.abs(actual - predicted) / F.nullif(F.abs(actual), F.lit(0.0)))


def mse(actual: Column, predicted: Column) -> Column:
    return F.avg((actual - predicted) * (actual - predicted))


def occurrences(trace: Column, activity: str) -> Column:
    return F.size(F.filter(trace, lambda x: x == activity))


def summary_pairs(text: Column) -> Column:
    """Blocks between blank lines as an array."""
    return F.split(text, r"\n\s*\n")


def json_fields(c: Column, schema: str) -> Column:
    """A struct of the named fields of a JSON text; null where it is none."""
    return F.from_json(c, schema)
