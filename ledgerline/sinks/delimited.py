"""Delimited text reports and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ";",
    quoting: bool = False,
    files: int | None = None,
) -> None:
    """Replace ``path`` with text files: one header each, NULL as blank, plain decimals.

    Values are joined as they are, as report readers expect; ``quoting`` puts
    quotes round values that hold the separator, a quote or a line break.
    ``files`` asks for that many files; the folder of parts is the report.
    """
    if files is not None:
        df = df.repartition(files)
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    writer_sep = sep
    if not quoting:
        # a single column: the joined line under the joined header
        joined = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in text.columns])
        text = text.select(joined.alias(sep.join(text.columns)))
        writer_sep = "\x01"
    writer = (
        text.write.mode("overwrite")
        .option("header", True)
        .option("sep", writer_sep)
        .option("nullValue", "")
        .option("emptyValue", "")
    )
    if not quoting:
        writer = writer.option("quote", "\x00").option("escapeQuotes", False)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def publish_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table with the report."""
    df.write.mode("overwrite").saveAsTable(name)
