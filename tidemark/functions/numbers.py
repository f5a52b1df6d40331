"""Numbers: ratios that never divide by zero, decimal rounding, plain text of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, places: int) -> Column:
    """Round to decimal places by scaling, so that engines agree on halves."""
    scale = float(10**places)
    return F.round(x.cast("double") * scale, 0) / scale


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; null if whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def count_where(condition: Column) -> Column:
    """The number of rows for which the condition holds; 0 over nothing."""
    return F.count_if(condition)


def plain_text(x: Column, places: int = 6) -> Column:
    """A double as decimal text, without exponent or trailing zeros, with one decimal at least."""
    text = F.regexp_replace(x.cast(f"decimal(28,{places})").cast("string"), r"0+$", "")
    return F.when(F.endswith(text, F.lit(".")), F.concat(text, F.lit("0"))).otherwise(text)
