"""Joins that stay balanced when one key holds a large part of the rows.

``hot_keys`` finds such keys with a mergeable heavy-hitter sketch: one narrow
scan, combined on the map side, a bounded number of hashes on the driver. The
sketch only steers the plan; every row is joined whichever way it says.

``salted_join`` spreads the rows of a hot key over as many salts as its share of the
rows needs and repeats the few matching rows of the other side once per salt. Rows of
other keys keep salt 0 and are never repeated.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lineage import stage

_TRACKED = 10_000, 1_000_000  # least and most items in the sketch; counts are off by 3.5 rows in so many

SPREAD = "__spread"


class HotKeys(NamedTuple):
    """Hashes of hot keys by the number of salts they need, a power of two."""

    levels: tuple[tuple[int, tuple[int, ...]], ...] = ()

    @property
    def hashes(self) -> tuple[int, ...]:
        return tuple(h for _, hashes in self.levels for h in hashes)

    @property
    def salts(self) -> int:
        """The most salts of a key."""
        return max((n for n, _ in self.levels), default=1)

    def salts_of(self, key_hash: Column) -> Column:
        out = F.lit(1)
        for n, hashes in self.levels:
            out = F.when(key_hash.isin(*hashes), n).otherwise(out)
        return out


def with_spread(df: DataFrame) -> DataFrame:
    """Add a number to salt by: a hash of the row's file and its place in the file.

    Content hashes would send copies of a row to one salt; this does not, and as it comes
    from the scan itself, a lost task run again, or a shuffle before the join, gives every
    row the same number. It needs a frame that still sees its parquet scan's ``_metadata``
    (a scan, filtered or not); any other frame is first written to the shared folder and
    read back, so that its rows have a file and a place too.
    """
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    try:
        return df.withColumn(SPREAD, place)
    except AnalysisException:
        return stage(df, "spread").withColumn(SPREAD, place)


def _hash(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*columns)


def hot_keys(
    df: DataFrame, key_sets: dict[str, Sequence[str]], min_share: float | None = None
) -> dict[str, HotKeys]:
    """Keys holding at least ``min_share`` of the rows (default: two partitions' worth)."""
    conf = df.sparkSession.conf
    partitions = conf.get("spark.sql.shuffle.partitions")
    partitions = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions))
    share = min_share or min(2.0 / partitions, 1.0)
    hashed = df.select(
        *[_hash([F.col(c) for c in keys]).alias(name) for name, keys in key_sets.items()]
    )
    k = math.ceil(1.0 / share)
    tracked = min(max(_TRACKED[0], 20 * k), _TRACKED[1])
    row = hashed.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.expr(f"approx_top_k(`{name}`, {k}, {tracked})").alias(name) for name in key_sets],
    ).first()
    found = {}
    for name in key_sets:
        shares = {
            item["item"]: item["count"] / row["__rows"]
            for item in (row[name] or [])
            if item["count"] >= share * row["__rows"]
        }
        levels = defaultdict(list)
        for key_hash, part in shares.items():
            levels[1 << max(math.ceil(part * partitions) - 1, 1).bit_length()].append(key_hash)
        found[name] = HotKeys(tuple((n, tuple(levels[n])) for n in sorted(levels)))
    return found


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    how: str = "inner",
    hot: HotKeys | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Equi join (inner or left) with ``left`` the side that may have hot keys.

    ``on`` maps left columns to right columns; the right key columns are dropped.
    Without hot keys it is a plain join with no extra column and no extra shuffle.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join does inner and left joins, not {how}")
    for lk, rk in on.items():
        if left.schema[lk].dataType != right.schema[rk].dataType:
            raise TypeError(f"key types differ: {left.schema[lk]} and {right.schema[rk]}")
    if hot is None:
        hot = hot_keys(left, {"key": list(on)})["key"]

    keys = {lk: f"__key_{i}" for i, lk in enumerate(on)}
    renamed = {rk: keys[lk] for lk, rk in on.items()}
    right = right.select(
        *[F.col(f"`{c}`").alias(renamed.get(c, c)) for c in right.columns]
    )
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")

    def same(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b) if null_safe else a == b

    drop = list(keys.values())
    condition = [same(left[lk], right[rk]) for lk, rk in keys.items()]
    if hot.levels:
        by = F.col(SPREAD) if SPREAD in left.columns else F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
        left = left.withColumn("__salt", _hash([F.col(f"`{c}`") for c in on]))
        left = left.withColumn("__salt", F.pmod(by, hot.salts_of(F.col("__salt"))).cast("int"))
        right = right.withColumn("__salt_r", _hash([F.col(c) for c in keys.values()]))
        right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), hot.salts_of(F.col("__salt_r")) - 1)))
        condition = [same(left[lk], right[rk]) for lk, rk in keys.items()]
        condition.append(left["__salt"] == right["__salt_r"])
        drop += ["__salt", "__salt_r"]
    return left.join(right, condition, how).drop(*drop)
