"""Turning hierarchy records into flat lookup tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import layouts
from ledgerline.functions.text import cut_from
from ledgerline.operators.joins import lookup
from ledgerline.operators.lineage import cut

PATHS = "decimal(38,0)"  # paths multiply; a bigint would overflow in a tree of many diamonds


def first_label(
    code: Column,
    codes: Column,
    descs: Column,
    markers: Sequence[str] = layouts.LINE_MARKERS,
    skip: str = layouts.LINE_SKIP,
) -> Column:
    """Label of the nearest level at or above the record's own one.

    From the first level carrying the record's own code on, the first
    description that has one of the markers and not ``skip``, cut from its
    marker (an earlier marker in ``markers`` wins). '' if the code is on no
    level or no description fits.
    """
    own = F.array_position(codes, code)

    def fits(d: Column) -> Column:
        marked = F.lit(False)
        for m in markers:
            marked = marked | d.contains(m)
        return marked & ~d.contains(skip)

    above = F.slice(descs, F.greatest(own, F.lit(1)).cast("int"), F.size(descs))
    label = F.get(F.filter(above, fits), F.lit(0))
    cut_label = label
    for m in reversed(markers):
        cut_label = F.when(label.contains(m), cut_from(label, m)).otherwise(cut_label)
    return F.when((own > 0) & label.isNotNull(), cut_label).otherwise("")


def code_before_keyword(
    code: Column, codes: Column, descs: Column, word: str = layouts.PORTFOLIO_WORD
) -> Column:
    """Code one level above the first level (below the top) whose description has ``word``."""
    below_top = F.slice(descs, F.lit(2), F.greatest(F.size(descs) - 1, F.lit(0)))
    at = F.array_position(F.transform(below_top, lambda d: d.contains(word)), F.lit(True))
    return F.when(at == 0, code).otherwise(F.get(codes, (at - 1).cast("int")))


def parent_at_level(
    code: Column, codes: Column, level: int = 3, above: str = layouts.NO_MANAGER
) -> Column:
    """Parent code for records of one level (0-based); ``above`` for those higher up; else ''."""
    at = [F.get(codes, F.lit(i)) for i in range(level + 1)]
    return (
        F.when(code == at[level], at[level - 1])
        .when(code.isin(*at[:level]), F.lit(above))
        .otherwise("")
    )


def edges(child: Column, parent: Column, desc: Column) -> list[Column]:
    """Columns child, parent, descr of a tree; descriptions start at their line word."""
    word, skip = layouts.LINE_WORD, layouts.LINE_SKIP
    named = desc.contains(word) & ~desc.contains(skip)
    return [
        child.alias("child"),
        parent.alias("parent"),
        F.when(named, cut_from(desc, word)).otherwise(desc).alias("descr"),
    ]


def is_line(desc: Column) -> Column:
    """The first marker is enough; the second counts only without the skip word."""
    plain, dashed = layouts.LINE_MARKERS
    return desc.contains(plain) | (desc.contains(dashed) & ~desc.contains(layouts.LINE_SKIP))


def nearest_ancestor(
    nodes: DataFrame,
    marked: Callable[[Column], Column] = is_line,
    max_climb: int = layouts.MAX_CLIMB,
    fallback: str = layouts.NO_LINE,
) -> DataFrame:
    """Nearest marked node at or above each node, as ``(child, line, label, copies)``.

    ``nodes`` has distinct ``(child, parent, descr)`` rows. A marked node
    resolves to itself. Any other node climbs its parents, at most ``max_climb``
    of them, to the first marked one; a parent that is no node, or a climb that
    is too long (a cycle, for instance), gives ``(fallback, fallback)``. A node
    with several parents resolves once per path; ``copies`` counts equal results
    instead of repeating them, so paths cannot multiply. Fallback rows of blank
    nodes are left out.

    The climb is done by squaring: a table of where every node gets in k steps,
    joined to itself, says where it gets in 2k. Fifteen climbs need four joins,
    fewer when all nodes are done earlier.
    """
    done = marked(F.col("descr"))
    step = (
        nodes.select(
            F.col("child").alias("key"),
            F.when(~done, F.col("parent")).alias("next"),
            done.alias("done"),
            F.when(done, F.col("child")).alias("line"),
            F.when(done, F.col("descr")).alias("label"),
        )
        .groupBy("key", "next", "done", "line", "label")
        .agg(F.count(F.lit(1)).cast(PATHS).alias("copies"))
    )
    # steps = looks at the node itself plus max_climb looks at parents
    wanted = max_climb + 1
    power = cut(step)
    result, taken, size_of_power = None, 0, 1
    while True:
        if wanted & size_of_power:
            result = power if result is None else _then(result, power, fallback)
            taken += size_of_power
        if taken == wanted:
            break
        if size_of_power > 1 and power.where(~F.col("done")).isEmpty():
            result = power
            break
        power = cut(_then(power, power, fallback))
        size_of_power *= 2
    return (
        result.select(
            F.col("key").alias("child"),
            F.when(F.col("done"), F.col("line")).otherwise(fallback).alias("line"),
            F.when(F.col("done"), F.col("label")).otherwise(fallback).alias("label"),
            F.col("copies"),
        )
        .where((F.col("line") != fallback) | (F.coalesce(F.col("child"), F.lit("")) != ""))
        .groupBy("child", "line", "label")
        .agg(F.sum("copies").cast(PATHS).alias("copies"))
    )


def _then(first: DataFrame, second: DataFrame, fallback: str) -> DataFrame:
    """Where ``first`` and then ``second`` lead; a key ``second`` lacks has no parent."""
    pending = first.where(~F.col("done")).select("key", "next", F.col("copies").alias("times"))
    reached = second.select(
        F.col("key").alias("at"),
        F.col("next").alias("next2"),
        F.col("done").alias("done2"),
        "line",
        "label",
        "copies",
    )
    joined = lookup(pending, reached, {"next": "at"}, size=None)
    missing = F.col("done2").isNull()
    moved = joined.select(
        "key",
        F.col("next2").alias("next"),
        F.coalesce("done2", F.lit(True)).alias("done"),
        F.when(missing, fallback).otherwise(F.col("line")).alias("line"),
        F.when(missing, fallback).otherwise(F.col("label")).alias("label"),
        (F.col("times") * F.coalesce("copies", F.lit(1).cast(PATHS))).cast(PATHS).alias("copies"),
    )
    return (
        first.where("done")
        .select("key", "next", "done", "line", "label", "copies")
        .unionByName(moved)
        .groupBy("key", "next", "done", "line", "label")
        .agg(F.sum("copies").cast(PATHS).alias("copies"))
    )


def repeat(df: DataFrame, copies: str = "copies") -> DataFrame:
    """One row per counted copy, for callers that want the plain bag."""
    return df.withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies).cast("bigint")))
    ).drop("__copy", copies)
