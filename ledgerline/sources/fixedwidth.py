"""Fixed-width lines: fields by position, records by widths, level arrays, tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import LINE_BLANKS, strip_sql

Slice = tuple[int, int]


def _field_sql(at: Slice, line: str, trim: bool = True) -> str:
    start, end = at
    text = f"substring(`{line}`, {start + 1}, {end - start})"
    return strip_sql(text, LINE_BLANKS) if trim else text


def field(at: Slice, line: str = "value", trim: bool = True) -> Column:
    """Characters ``[start, end)`` of a line; what a short line lacks reads as ''."""
    return F.expr(_field_sql(at, line, trim))


def levels(slices: Sequence[Slice], line: str = "value") -> Column:
    return F.expr(f"array({', '.join(_field_sql(at, line) for at in slices)})")


def where_tag(lines: DataFrame, tag: tuple[Slice, str]) -> DataFrame:
    at, text = tag
    return lines.where(field(at) == text)


def where_prefix(lines: DataFrame, prefix: str) -> DataFrame:
    return lines.where(F.col("value").startswith(prefix))


def select_fields(lines: DataFrame, fields: dict[str, Slice]) -> DataFrame:
    return lines.select(*[field(at).alias(name) for name, at in fields.items()])


def parse(lines: DataFrame, layout: Sequence[tuple[str, int]], trim: bool = True) -> DataFrame:
    """Records laid out as consecutive ``(name, width)`` fields.

    Values are stripped by default: layouts give some codes a wider field than
    the code they hold, and the codes are then compared without padding.
    """
    columns, start = [], 0
    for name, width in layout:
        columns.append(f"{_field_sql((start, start + width), 'value', trim)} as `{name}`")
        start += width
    return lines.selectExpr(*columns)
