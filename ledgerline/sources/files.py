"""Dated snapshots, text lines and rule files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_snapshot(
    spark: SparkSession, root: str, table: str, date: str, fmt: str = "parquet"
) -> DataFrame:
    """One table as of one date: ``<root>/<table>/<date>/*.<fmt>``.

    The date is a path level, so only that day's files are listed and read.
    """
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{table}/{date}/*.{fmt}")


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8", min_partitions: int | None = None) -> DataFrame:
    """Text lines as ``value``, decoded from ``encoding``; plain or gzipped files.

    The text source hands the bytes of each line on untouched, so decoding them
    is a column expression and plain files stay splittable. A gzipped file is one
    task, whatever its size: with ``min_partitions`` the raw lines of a read with
    fewer partitions are dealt round-robin over that many before they are decoded,
    so decoding and all later work use as many tasks. Line order is then not kept;
    rule files, whose first line is the header, are read without it.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    if min_partitions and lines.rdd.getNumPartitions() < min_partitions:
        lines = lines.repartition(min_partitions)
    if encoding.upper() in ("UTF-8", "UTF8"):
        return lines
    return lines.select(F.decode(F.col("value").cast("binary"), encoding.upper()).alias("value"))


def parse_rules(lines: DataFrame, required: Sequence[str] = (), sep: str = ";") -> DataFrame:
    """A delimited table whose first line names the columns; all values are text.

    Every line equal to the header is dropped, as files glued together repeat it.
    """
    lines = lines.select(F.rtrim(F.col("value"), F.lit("\r")).alias("value"))
    first = lines.first()
    header = first["value"] if first else sep.join(required)
    names = header.split(sep)
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"rule file lacks columns {missing}; it has {names}")
    parts = F.split(F.col("value"), "\\Q" + sep + "\\E", -1)
    return (
        lines.where(F.col("value") != header)
        .select(parts.alias("parts"))
        .select(*[F.get("parts", F.lit(i)).alias(name) for i, name in enumerate(names)])
    )


def read_rules(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = (),
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    return parse_rules(read_lines(spark, path, encoding), required, sep)
