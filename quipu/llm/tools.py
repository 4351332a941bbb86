"""Tool-call linking for chat data.

Calls and results are joined by conversation and identifier; what has no partner is kept and said so. Calls are
ordered by their dependencies: a call's level is one more than that of the calls whose results it uses. Chains
of calls that use one call each are followed by doubling, in rounds by the logarithm of their length;
calls that use several take one more pass for each layer of such calls. Calls in a circle, or that need a call
which is not there, get no level. Arguments are validated against the tool's schema, and call and result are
serialised as canonical JSON: keys sorted, no blanks, characters as they are, numbers in their shortest form. Numbers
beyond a double, half a surrogate pair and nesting beyond Python's depth are broken arguments.

Nothing is gathered by conversation: the rows carry (level, turn, call_id) as their order, so one conversation may
hold any share of the rows. Repeated calls of one identifier link with the first turn's result each; repeated results
are one, the earliest. Null identifiers match nothing. Null or broken arguments are invalid. Empty tables give empty
results. Columns other than those named are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import staged

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, uses array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"

# JSON types by name.
TYPES: dict[str, tuple[type, ...]] = {
    "string": (str,),
    "integer": (int,),
    "number": (int, float),
    "boolean": (bool,),
    "object": (dict,),
    "array": (list,),
    "null": (type(None),),
}


def canonical(value: Any) -> str:
    """One text for each JSON value; integral floats are written as integers."""

    def plain(x: Any) -> Any:
        if isinstance(x, float) and x.is_integer() and abs(x) < 2**53:
            return int(x)
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _is(value: Any, kind: str) -> bool:
    """Whether a value has a JSON type; 2.0 is an integer, true is no number."""
    if isinstance(value, bool):
        return kind == "boolean"
    return isinstance(value, TYPES[kind]) or (kind == "integer" and isinstance(value, float) and value.is_integer())


def problems(value: Any, schema: dict, path: str = "$") -> list[str]:
    """What of a value breaks a schema (type or types, enum, bounds, required, properties, items), in order."""
    out = []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, kind) for kind in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{path}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{path}: below minimum"] if value < schema.get("minimum", value) else []
        out += [f"{path}: above maximum"] if value > schema.get("maximum", value) else []
    if isinstance(value, str):
        out += [f"{path}: too short"] if len(value) < schema.get("minLength", 0) else []
        out += [f"{path}: too long"] if len(value) > schema.get("maxLength", len(value)) else []
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += problems(x, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += problems(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{k}: unknown")
    return out


def validated(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Adds ``valid``, ``errors`` and ``json`` (the call with its result, canonical) to linked calls."""
    kept = ["conv_id", "turn", "call_id", "name", "arguments", "linked", "content", "level"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    value = json.loads(row["arguments"], parse_constant=_no_constant, parse_float=_finite)
                    schema = schemas.get(row["name"])
                    errors = ["$: unknown tool"] if schema is None else problems(value, schema)
                    text = _whole(row, value)
                    text.encode()
                except (TypeError, ValueError, RecursionError):
                    errors, text = ["$: not JSON"], _whole(row, None)
                out.append((not errors, errors, text))
            if out:
                valid, errors, texts = zip(*out)
                added = [pa.array(valid), pa.array(errors, pa.list_(pa.string())), pa.array(texts)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*kept, "valid", "errors", "json"])

    schema = "conv_id long, turn long, call_id string, name string, arguments string, linked boolean"
    schema += ", content string, level int, valid boolean, errors array<string>, json string"
    return calls.select(*kept).mapInArrow(run, schema)


def _whole(row: dict, value: Any) -> str:
    """A call with its result as one text."""
    call = {"id": row["call_id"], "name": row["name"], "arguments": value}
    return canonical({"call": call, "result": row["content"], "level": row["level"], "linked": row["linked"]})


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _finite(digits: str) -> float:
    if abs(value := float(digits)) == float("inf"):
        raise ValueError(digits)
    return value


def _merged(waits: DataFrame) -> DataFrame:
    """One row for each call that a call waits for, and one for what it need not wait for any more."""
    return waits.groupBy("conv_id", "call_id", "needs", F.col("w").isNull().alias("known")).agg(
        F.max("w").alias("w"), F.max("b").alias("b")
    )


def _led(waits: DataFrame, by: DataFrame) -> DataFrame:
    """Open rows with the call they wait for replaced by what that call waits for, where ``by`` says so."""
    at = by.select(
        "conv_id",
        F.col("call_id").alias("needs"),
        F.col("needs").alias("to"),
        F.col("w").alias("more"),
        F.col("b").alias("least"),
    )
    met = waits.select("conv_id", "call_id", "needs", "w", "b").join(at, ["conv_id", "needs"], "left")
    moved = F.col("least").isNotNull()
    return met.select(
        "conv_id",
        "call_id",
        F.when(moved, F.col("to")).otherwise(F.col("needs")).alias("needs"),
        F.when(moved, F.col("w") + F.col("more")).otherwise(F.col("w")).alias("w"),
        F.when(moved, F.greatest("b", F.col("least") + F.col("w"))).otherwise(F.col("b")).alias("b"),
        moved.alias("moved"),
    )


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of every call that does not wait for a circle or for a missing call.

    A row (call, needs, w, b) says that the call's level is at least b and, where w is not null, at least w more
    than that of the call it needs. Calls that need one call form chains, and each round replaces the call
    at the end of a chain by that call's own end: the reach doubles, so that a chain of n calls takes log n rounds. Calls
    that need several take what their chains lead to; those left with one are a chain again.
    """
    columns = ("conv_id", "call_id", "needs", "w", "b")
    named = calls.where("conv_id is not null and call_id is not null")
    first = named.select(
        "conv_id",
        "call_id",
        F.explode_outer("uses").alias("needs"),
        F.when(F.size("uses") > 0, F.lit(1)).alias("w"),
        F.lit(0).alias("b"),
    )
    waits, settled, chain = staged(_merged(first), "waits"), [], None
    while True:
        each = staged(
            waits.groupBy("conv_id", "call_id").agg(
                F.count("w").alias("open"),
                F.max(F.when(F.col("w").isNotNull(), F.col("needs"))).alias("needs"),
                F.max("w").alias("w"),
                F.max("b").alias("b"),
            ),
            "each",
        )
        if settled and each.where("open < 2").isEmpty():
            break
        settled.append(each.where("open = 0").select(*columns))
        fresh = each.where("open = 1").select(*columns)
        chain = fresh if chain is None else chain.union(fresh)
        for _ in range(chain.count().bit_length() + 1):
            by = chain
            for done in settled:
                by = by.union(done)
            led = staged(_led(chain, by), "led")
            settled.append(led.where("w is null").select(*columns))
            chain = led.where("w is not null").select(*columns)
            if led.where("moved and w is not null").isEmpty():
                break
        else:  # a chain that is still moving after so many rounds leads to a circle
            chain = led.where("w is not null and not moved").select(*columns)
        several = waits.join(each.where("open > 1").select("conv_id", "call_id"), ["conv_id", "call_id"], "left_semi")
        by = chain
        for done in settled:
            by = by.union(done)
        further = _led(several.where("w is not null"), by).select(*columns)
        waits = staged(_merged(further.union(several.where("w is null").select(*columns))), "waits")
        if waits.isEmpty():
            break
    out = settled[0]
    for done in settled[1:]:
        out = out.union(done)
    return out.select("conv_id", "call_id", F.col("b").alias("level"))


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Every call with its result, level, validity and canonical JSON; results without a call come last.

    Columns: conv_id, turn, call_id, name, arguments, linked, content, level, valid, errors, json. A result
    without a call has no name and no arguments.
    """
    first = results.where("call_id is not null").groupBy("conv_id", "call_id")
    first = first.agg(F.min(F.struct("turn", "content")).alias("first"))
    first = first.select("conv_id", "call_id", F.col("first.content").alias("content"), F.col("first.turn").alias("at"))
    both = calls.join(first, ["conv_id", "call_id"], "left").join(levels(calls), ["conv_id", "call_id"], "left")
    found = both.withColumn("linked", F.col("at").isNotNull())
    lone = first.join(calls.where("call_id is not null"), ["conv_id", "call_id"], "left_anti").select(
        "conv_id",
        F.col("at").alias("turn"),
        "call_id",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"),
        F.lit(False).alias("linked"),
        "content",
        F.lit(None).cast("int").alias("level"),
    )
    return validated(found.select(*lone.columns).unionByName(lone), schemas)
