"""Cleaning, filtering and projecting columns."""

from __future__ import annotations

import functools
import operator
from collections.abc import Collection, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.functions.text import BLANKS, sql_text, strip_sql


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def trim_all(
    df: DataFrame, null_token: str | None = None, keep: Collection[str] = ()
) -> DataFrame:
    """Every column as text without blanks at its ends, in one projection.

    NULL stays NULL unless ``null_token`` gives the text to put in its place.
    Columns in ``keep`` (amounts, for instance) pass as they are.
    """

    def cleaned(f) -> str:
        c = f"`{f.name}`"
        if f.name in keep:
            return c
        text = strip_sql(c) if isinstance(f.dataType, StringType) else f"cast({c} as string)"
        return f"{text} as {c}" if null_token is None else f"coalesce({text}, {sql_text(null_token)}) as {c}"

    return df.selectExpr(*[cleaned(f) for f in df.schema.fields])


def where_in(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    return df if values is None else df.where(F.col(column).isin(*values))


def where_may_trim_to(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows whose raw text could be one of ``values`` once blanks at its ends are gone.

    Prefix tests reach a parquet scan, a test on the trimmed text does not. What passes
    still needs :func:`where_in` after trimming.
    """
    if values is None or not isinstance(df.select(column).schema[0].dataType, StringType):
        return df
    starts = [F.col(column).startswith(v) for v in (*values, *BLANKS)]
    return df.where(functools.reduce(operator.or_, starts))


def select_map(df: DataFrame, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """Project and rename in one step from ``(new name, source column)`` pairs."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns])


def constants(df: DataFrame, **values: str) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})
