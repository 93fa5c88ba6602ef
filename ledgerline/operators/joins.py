"""Lookups: left or inner joins against a table whose size is checked first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.skew import HotKeys, salted_join

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 32


def measured_bytes(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Bytes each table would hold in memory, counted from its rows in one action."""

    def size(name: str, df: DataFrame) -> DataFrame:
        widths = [f"coalesce(octet_length(cast(`{c}` as string)), 0) + 16" for c in df.columns]
        total = " + ".join([str(_ROW_OVERHEAD), *widths])
        rows = df.selectExpr(f"cast({total} as bigint) as bytes")
        return rows.agg(F.lit(name).alias("name"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))

    parts = [size(name, df) for name, df in tables.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return {r["name"]: r["bytes"] for r in union.collect()}  # one row per table


def check_unique(df: DataFrame, keys: list[str]) -> None:
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"lookup table repeats keys {keys}")


MEASURE = "measure"


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    *,
    how: str = "left",
    right_filter: Column | None = None,
    unique: bool = False,
    null_safe: bool = False,
    size: int | str | None = MEASURE,
    limit: int = BROADCAST_BYTES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join ``right``'s columns to ``left`` by equal keys.

    ``on`` maps left columns to right columns; right keys are dropped from the
    result. ``right_filter`` is a condition of the ON clause on the right side
    alone, so rows it leaves unmatched stay in a left join. Repeated right keys
    repeat rows, unless ``unique`` asks to refuse them.

    The right side is broadcast when its ``size`` in bytes (measured unless
    given) is within ``limit``; otherwise it is shuffled, with hot left keys
    salted. That suits a ``left`` too large to shuffle lightly. With
    ``size=None`` nothing is run ahead: both sides may be shuffled, and adaptive
    execution chooses from the sizes it then sees (broadcast, or a sort-merge
    join with skewed partitions split). That suits joins of lookup tables.
    """
    if right_filter is not None:
        right = right.where(right_filter)
    if unique:
        check_unique(right, list(on.values()))
    if size is None:
        return salted_join(left, right, on, how, HotKeys(), null_safe)
    if size == MEASURE:
        size = measured_bytes({"right": right})["right"]
    if size <= limit:
        return salted_join(left, F.broadcast(right), on, how, HotKeys(), null_safe)
    return salted_join(left, right, on, how, hot, null_safe)
