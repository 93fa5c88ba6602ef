"""Linking tool calls of chats to their results.

Calls and results are joined by conversation and identifier; results are reduced to one
row per identifier before the join, so no pair of repeated rows is made. A call depends
on the calls whose identifiers its arguments name as ``{"$ref": "<call id>"}``. Its level
is the length of the longest chain of such references below it; ordering by level, turn
and identifier is a topological order. Arguments are checked against the tool's JSON
schema, and each linked call is written as canonical JSON.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lineage import cut

GROUP = 10_000  # references of a conversation that one task orders; beyond it, rounds of joins
_TURNS = 1024  # turns counted together when positions are given out

_TYPES = {
    "object": dict, "array": list, "string": str, "boolean": bool, "null": type(None),
    "integer": int, "number": (int, float),
}


def canonical(value: Any) -> str:
    """JSON without blanks, keys in UTF-16 order, whole numbers without fraction."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("JSON has no such number")
        if value == int(value) and abs(value) < 1e21:
            return str(int(value))
    return json.dumps(value, ensure_ascii=False)


def problems(value: Any, schema: Mapping[str, Any], at: str = "$") -> list[str]:
    """Where ``value`` breaks the schema (the keywords used for tool arguments).

    A reference stands for another call's result and is not checked."""
    if isinstance(value, dict) and len(value) == 1 and isinstance(value.get("$ref"), str):
        return []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not among the allowed values")
    if _is(value, "number"):
        if value < schema.get("minimum", value):
            out.append(f"{at}: below {schema['minimum']}")
        if value > schema.get("maximum", value):
            out.append(f"{at}: above {schema['maximum']}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: shorter than {schema['minLength']}")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: longer than {schema['maxLength']}")
    if isinstance(value, list):
        for i, item in enumerate(value):
            out += problems(item, schema.get("items", {}), f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k, item in value.items():
            if k in known:
                out += problems(item, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    return out


def _is(value: Any, kind: str) -> bool:
    if isinstance(value, bool) and kind in ("integer", "number"):
        return False
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _TYPES[kind])


def references(value: Any) -> list[str]:
    """Identifiers named anywhere in the arguments, each once, in order."""
    found: dict[str, None] = {}
    rest = [value]
    while rest:
        v = rest.pop()
        if isinstance(v, dict):
            if isinstance(v.get("$ref"), str) and len(v) == 1:
                found[v["$ref"]] = None
            rest += reversed(v.values())
        elif isinstance(v, list):
            rest += reversed(v)
    return list(found)


def _refuse(name: str) -> float:
    raise ValueError(f"JSON has no {name}")


def read(text: str | None) -> tuple[Any, str | None]:
    """The value of a JSON text and what is wrong with it."""
    try:
        return json.loads(text or "", parse_constant=_refuse), None
    except (ValueError, RecursionError):
        return None, "$: not JSON"


def levels(edges: list[tuple[str, str]]) -> dict[str, int | None]:
    """Longest chain below each node of (node, needs) edges; None on or above a cycle."""
    above, waiting, level = defaultdict(list), defaultdict(int), {}
    for node, needs in edges:
        above[needs].append(node)
        waiting[node] += 1
        level.setdefault(node, None)
        level.setdefault(needs, None)
    ready = [n for n in level if not waiting[n]]
    best: dict[str, int] = defaultdict(int)
    while ready:
        n = ready.pop()
        level[n] = best[n]
        for m in above[n]:
            best[m] = max(best[m], level[n] + 1)
            waiting[m] -= 1
            if not waiting[m]:
                ready.append(m)
    return level


def _levels(edges: DataFrame, group: int) -> DataFrame:
    """``conv_id, call_id, level`` of every call with references from or to it."""
    schema = "conv_id long, call_id string, level int"
    sizes = edges.groupBy("conv_id").agg(F.count("*").alias("__n"))
    sized = edges.join(sizes, "conv_id")
    # at most ``group`` references a row, many conversations a batch
    small = sized.where(F.col("__n") <= group).groupBy("conv_id").agg(F.collect_list(F.struct("call_id", "needs")).alias("edges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, calls, depths = [], [], []
            for conv, found in zip(batch.column("conv_id").to_pylist(), batch.column("edges").to_pylist()):
                depth = levels([(e["call_id"], e["needs"]) for e in found])
                convs += [conv] * len(depth)
                calls += depth.keys()
                depths += depth.values()
            values = [pa.array(convs, pa.int64()), pa.array(calls, pa.string()), pa.array(depths, pa.int32())]
            yield pa.RecordBatch.from_arrays(values, ["conv_id", "call_id", "level"])

    out = small.mapInArrow(run, schema)
    rest = cut(sized.where(F.col("__n") > group).drop("__n"))
    if rest.isEmpty():
        return out
    # long conversations: every round settles the calls whose references are all settled
    nodes = rest.select("conv_id", "call_id").union(rest.select("conv_id", "needs")).distinct()
    waiting, done, level = rest, None, 0
    while True:
        free = nodes.join(waiting, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(level))
        free = cut(free)
        if free.isEmpty():
            break
        done = free if done is None else done.union(free)
        keys = ["conv_id", "call_id"]
        nodes = cut(nodes.join(free, keys, "left_anti"))
        settled = free.select("conv_id", F.col("call_id").alias("needs"))
        waiting = cut(waiting.join(settled, ["conv_id", "needs"], "left_anti"))
        level += 1
    stuck = nodes.withColumn("level", F.lit(None).cast("int"))
    return out.union(stuck if done is None else done.union(stuck))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Any]], group: int = GROUP) -> DataFrame:
    """One row per distinct call.

    ``calls``: ``conv_id, turn, call_id, name, arguments`` (JSON text); ``results``:
    ``conv_id, turn, call_id, content``; other columns are not read. The result has the
    columns of ``calls`` and

    * ``valid``, ``errors``: whether the arguments are JSON and meet the tool's schema, name
      no unknown call and no cycle, and what is wrong (joined by ``; ``);
    * ``level`` and ``position`` (from 0 in a conversation; null on or above a cycle);
    * ``status``: ``linked``; ``unanswered`` (no result); ``early`` (answered only before
      the call); ``unnamed`` (null conversation or identifier, never linked);
    * ``n_results``, ``result_turn`` and ``result``: of several results the first not
      before the call's turn, else the first, by turn, then text;
    * ``json``: the canonical record; arguments that are no JSON stay as text.

    Equal call rows are one row. An identifier used by different calls of a conversation
    links each of them. Results no call asked for are left out. Null texts are empty.
    """
    rows = calls.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("call_id").cast("string"),
        F.col("name").cast("string"), F.coalesce(F.col("arguments").cast("string"), F.lit("")).alias("arguments"),
    ).distinct()
    tools = {k: dict(v) for k, v in schemas.items()}

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, errors, texts = [], [], []
            for name, text in zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist()):
                value, wrong = read(text)
                found = [wrong] if wrong else problems(value, tools[name]) if name in tools else ["unknown tool"]
                refs.append([] if wrong else references(value))
                errors.append(found)
                texts.append(canonical(text) if wrong else canonical(value))
            new = [pa.array(refs, pa.list_(pa.string())), pa.array(errors, pa.list_(pa.string())), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "refs", "errors", "canonical"])

    kept = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    checked = cut(rows.mapInArrow(check, f"{kept}, refs array<string>, errors array<string>, canonical string"))

    named = checked.where("conv_id is not null and call_id is not null")
    wanted = named.select("conv_id", "call_id", F.explode("refs").alias("needs")).distinct()
    known = named.select("conv_id", F.col("call_id").alias("needs")).distinct()
    edges = cut(wanted.join(known, ["conv_id", "needs"]).select("conv_id", "call_id", "needs"))
    unknown = wanted.join(known, ["conv_id", "needs"], "left_anti")
    unknown = unknown.groupBy("conv_id", "call_id").agg(F.min("needs").alias("__unknown"))
    level = _levels(edges, group).withColumn("__seen", F.lit(True))

    answers = results.select(
        F.col("conv_id").cast("long"), F.col("call_id").cast("string"), F.col("turn").cast("long").alias("at"),
        F.coalesce(F.col("content").cast("string"), F.lit("")).alias("content"),
    ).where("conv_id is not null and call_id is not null")
    first_turns = named.groupBy("conv_id", "call_id").agg(F.max("turn").alias("__asked"))
    answer = F.struct(F.coalesce(F.col("at") < F.col("__asked"), F.lit(False)).alias("early"), "at", "content")
    answers = answers.join(first_turns, ["conv_id", "call_id"]).groupBy("conv_id", "call_id").agg(
        F.count("*").alias("n_results"), F.min(answer).alias("__answer")
    )
    keys = ["conv_id", "call_id"]
    out = checked.join(answers, keys, "left").join(level, keys, "left").join(unknown, keys, "left")
    cyclic = F.col("__seen") & F.col("level").isNull()
    out = out.withColumn("level", F.when(~F.coalesce(cyclic, F.lit(False)), F.coalesce("level", F.lit(0))))
    errors = F.concat(
        "errors",
        F.when(F.col("__unknown").isNotNull(), F.array(F.concat(F.lit("unknown reference "), "__unknown"))).otherwise(F.array()),
        F.when(F.col("level").isNull(), F.array(F.lit("cyclic reference"))).otherwise(F.array()),
    )
    status = (
        F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "unnamed")
        .when(F.col("__answer").isNull(), "unanswered").when(F.col("__answer.early"), "early").otherwise("linked")
    )
    out = out.withColumns({
        "errors": F.array_join(errors, "; "), "valid": F.size(errors) == 0, "status": status,
        "n_results": F.coalesce("n_results", F.lit(0)), "result_turn": F.col("__answer.at"), "result": F.col("__answer.content"),
    })
    out = _positions(out)

    @F.pandas_udf("string")
    def record(call: pd.Series, name: pd.Series, arguments: pd.Series, result: pd.Series) -> pd.Series:
        rows = zip(arguments, *(v.map(canonical, na_action=None) for v in (call, name, result)))
        return pd.Series(['{"arguments":%s,"id":%s,"name":%s,"result":%s}' % r for r in rows], dtype=object)

    return out.select(
        "conv_id", "turn", "call_id", "name", "arguments", "valid", "errors", "level", "position", "status",
        "n_results", "result_turn", "result", record("call_id", "name", "canonical", "result").alias("json"),
    )


def _positions(df: DataFrame) -> DataFrame:
    """Place in the conversation by level, turn, identifier. Rows are numbered within a
    range of turns and ranges are counted, so a long conversation is many small windows."""
    df = df.withColumn("__turns", F.floor(F.coalesce("turn", F.lit(-1)) / _TURNS))
    counts = df.groupBy("conv_id", "level", "__turns").agg(F.count("*").alias("__n"))
    counts = counts.selectExpr(
        "conv_id", "level", "__turns",
        "sum(__n) over (partition by conv_id order by level nulls last, __turns rows between unbounded preceding and current row) - __n as __before",
    )
    numbered = df.selectExpr(
        "*", "row_number() over (partition by conv_id, level, __turns order by turn nulls first, call_id, name, arguments) - 1 as __in"
    )
    same = [numbered[c].eqNullSafe(counts[c]) for c in ("conv_id", "level")] + [numbered["__turns"] == counts["__turns"]]
    out = numbered.join(counts, same, "left").select(numbered["*"], "__before")
    return out.withColumn("position", F.when(F.col("level").isNotNull(), F.col("__before") + F.col("__in")))
