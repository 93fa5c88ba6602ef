"""String columns: blank stripping, prefix removal, cutting at a marker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a blank at the ends of a value.
BLANKS = " \t\n\x0b\x0c\r"
LINE_BLANKS = BLANKS + "\x1c\x1d\x1e\x1f\x85\xa0"


def sql_text(text: str) -> str:
    """A SQL string literal, every character written as its code point."""
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


def strip_sql(expr: str, blanks: str = BLANKS) -> str:
    """SQL text of :func:`strip`: wide selects are quicker to build from text."""
    return f"btrim({expr}, {sql_text(blanks)})"


def strip(c: Column, blanks: str = BLANKS) -> Column:
    return F.btrim(c, F.lit(blanks))


def cut_from(c: Column, marker: str) -> Column:
    """The value from the first ``marker`` on; the whole value if it has none."""
    return F.when(c.contains(marker), F.substring(c, F.instr(c, marker), F.length(c))).otherwise(c)


def is_number(c: Column, value: int) -> Column:
    """True when the text reads as this positive whole number: '06', '6' and '6.0' are 6.

    A pattern rather than a cast: a failing cast costs an exception per row.
    """
    return c.rlike(f"^\\s*[+]?0*{value}([.]0*)?\\s*$")


def strip_prefix(c: Column, width: int, value: int) -> Column:
    """Drop the first ``width`` characters when they read as the number ``value``."""
    head = F.substring(c, 1, width)
    return F.when(is_number(head, value), F.substring(c, F.lit(width + 1), F.length(c))).otherwise(c)


def org_code(c: Column) -> Column:
    """Six-character unit code held in a portfolio code of 9, 8 or 5 characters."""
    n = F.length(c)
    return (
        F.when(n == 9, F.substring(c, F.lit(4), n))
        .when(n == 8, F.substring(c, F.lit(3), n))
        .when(n == 5, F.concat(F.lit("0"), c))
        .otherwise(c)
    )
