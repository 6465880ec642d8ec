"""Cleaning and parsing of text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The Unicode space separators (category Zs). Tabs are not part of it.
SPACES = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def strip(column: Column) -> Column:
    """Trim every kind of Unicode space; Spark's own trim only knows the ASCII one.

    Text without multi-byte characters takes the plain trim, which is several times faster.
    """
    ascii_only = F.octet_length(column) == F.char_length(column)
    return F.when(ascii_only, F.trim(column)).otherwise(F.btrim(column, F.lit(SPACES)))


def blank_to_null(column: Column) -> Column:
    return F.nullif(strip(column), F.lit(""))


def parse_double(column: Column) -> Column:
    """Text to double, null when it is not a number.

    The JVM parser accepts Java literals such as ``12d``; those are not numbers here.
    """
    java_literal = column.rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~java_literal, column.try_cast("double"))


def parse_int(column: Column) -> Column:
    """Text to int, rounding halves away from zero (``1.5`` gives 2), null when unreadable."""
    return F.round(parse_double(column)).try_cast("int")


def airline_prefix(callsign: Column) -> Column:
    """The airline code carried by a callsign: its first three letters, upper case."""
    return F.upper(F.left(callsign, F.lit(3)))


def display_label(name: Column, code: Column) -> Column:
    """``Name (CODE)``, or the bare name when there is no code."""
    return F.when(code.isNotNull(), F.concat(name, F.lit(" ("), code, F.lit(")"))).otherwise(name)
