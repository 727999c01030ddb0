"""Checked casts of numbers as they come from loosely typed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _exact(x: Column) -> Column:
    """The whole number of a value or its text; null for a fraction, for what is no number, and beyond 64 bits."""
    text = F.trim(x.cast("string"))
    d = text.try_cast("decimal(38,9)")
    return F.when(d == F.floor(d), d.try_cast("decimal(38,0)").try_cast("bigint"))


def to_long(x: Column, check: bool = True) -> Column:
    """A BIGINT; with check a value that isn't one is an error, otherwise null. Null stays null."""
    return _checked(x, _exact(x), check, "no 64-bit integer: ")


def to_index(x: Column, check: bool = True) -> Column:
    """A BIGINT from 0; with check a negative value or one that is no whole number is an error, otherwise null. Null stays null."""
    n = _exact(x)
    return _checked(x, F.when(n >= 0, n), check, "no index: ")


def to_float(x: Column, check: bool = True) -> Column:
    """A FLOAT; with check what is no number or too large for one is an error, otherwise null. Null stays null."""
    d = F.trim(x.cast("string")).try_cast("double")
    return _checked(x, F.when(F.isnan(d) | (F.abs(d) <= 3.4028234663852886e38) | (F.abs(d) == float("inf")), d.cast("float")), check, "no number: ")


def to_indexes(x: Column, check: bool = True) -> Column:
    return F.transform(x, lambda v: to_index(v, check))


def _checked(x: Column, out: Column, check: bool, message: str) -> Column:
    return F.when(x.isNotNull() & out.isNull(), F.raise_error(F.concat(F.lit(message), x.cast("string")))).otherwise(out) if check else out
