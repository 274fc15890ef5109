"""Scalar column expressions.  All are built-in Catalyst expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.contracts import (DATE_FORMAT, ERROR_TEXT_LIMIT, INCENTIVE_RATE,
                                MONEY, MONTH_FORMAT, SECONDS)


# Four digits (the year 0 is left to the formatter), two and two, and nothing after them.
_PLAIN_DATE = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_text(date) -> Column:
    """'yyyy-MM' label of a date (sales mart month).  The text of a date begins with it, which
    costs a tenth of a formatter; years of other than four digits go through the formatter."""
    day = _c(date).cast("date")
    return (F.when(F.year(day).between(1, 9999), F.substring(day.cast("string"), 1, 7))
            .otherwise(F.date_format(day, MONTH_FORMAT)))


def month_start(date) -> Column:
    """First day of the month as a DATE (customer mart month)."""
    return F.trunc(_c(date), "month")


def full_name(first, last) -> Column:
    """`first || ' ' || last`; NULL when either part is NULL (unlike concat_ws)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def incentive(total, is_top) -> Column:
    """1 % of `total` for top performers, HALF_UP to cents, else 0."""
    rate = F.lit(INCENTIVE_RATE).cast(T.DecimalType(3, 2))
    return (F.when(_c(is_top), F.round(_c(total) * rate, 2))
            .otherwise(F.lit(0)).cast(MONEY))


def strict_date(text) -> Column:
    """Parse 'yyyy-MM-dd'; a bad value gives NULL (never an ANSI error).

    Text of just that shape is read by a cast, which costs a tenth of a formatter and
    knows the same calendar; all other text goes to the formatter."""
    text = _c(text)
    return (F.when(text.rlike(_PLAIN_DATE), text.try_cast("date"))
            .otherwise(F.try_to_date(text, DATE_FORMAT)))


def typed_or_null(text, data_type: T.DataType) -> Column:
    """Cast text to `data_type`; a bad value gives NULL (never an ANSI error)."""
    if isinstance(data_type, T.DateType):
        return strict_date(text)
    return _c(text).try_cast(data_type)


def truncate_text(text, limit: int = ERROR_TEXT_LIMIT) -> Column:
    return F.substring(_c(text), 1, limit)


def elapsed_seconds(start, end) -> Column:
    """Seconds between two timestamps, 3 decimals."""
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return (micros.cast(T.DecimalType(20, 0)) / F.lit(1_000_000)).cast(SECONDS)


def base_name(path) -> Column:
    """Last path segment of a file path or URI."""
    return F.element_at(F.split(_c(path), "/"), -1)


def padded(number, width: int) -> Column:
    """The number as text, zeros before it up to `width` characters; longer numbers stay whole."""
    text = _c(number).cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(width) - F.char_length(text), F.lit(0))), text)
