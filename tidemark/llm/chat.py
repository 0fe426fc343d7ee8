"""Chat formatting: tool calls and results are linked, ordered, validated and serialised."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import Work, numbered, packed, piped, unpacked

MESSAGE, CALL, RESULT = "message", "call", "result"
# Edges whose places a task makes at once.
EDGES = 10_000
# Turns of a conversation that are looked at together.
STRETCH = 4096

# Types of JSON schemas.
TYPES = {
    "string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict,
    "array": list, "null": type(None),
}
# Keywords of JSON schemas that are checked, and those that say nothing about values.
CHECKED = {
    "type", "enum", "const", "minLength", "maxLength", "pattern", "minimum", "maximum",
    "exclusiveMinimum", "exclusiveMaximum", "required", "properties", "additionalProperties",
    "items", "minItems", "maxItems",
}
SILENT = {"title", "description", "default", "examples", "$schema", "$comment"}
# An integer of more digits is not read.
DIGITS = 4000


def check_schema(schema: dict, at: str = "") -> None:
    """Refuse a schema with a keyword or type that would not be checked."""
    unknown = sorted(set(schema) - CHECKED - SILENT)
    if unknown:
        raise ValueError(f"schema at {at or '.'}: keyword {unknown[0]!r} is not supported")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind not in TYPES:
            raise ValueError(f"schema at {at or '.'}: type {kind!r} is not known")
    if "pattern" in schema:
        re.compile(schema["pattern"])
    for name, inner in schema.get("properties", {}).items():
        check_schema(inner, f"{at}.{name}")
    for name in ("items", "additionalProperties"):
        if isinstance(schema.get(name), dict):
            check_schema(schema[name], f"{at}.{name}")


def _is(value, kind: str) -> bool:
    if isinstance(value, bool):
        return kind == "boolean"
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, TYPES[kind])


def _same(a, b) -> bool:
    """Whether two JSON values are equal: 1 and 1.0 are, 1 and true are not."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(a[k], b[k]) for k in a)
    return a == b


def schema_errors(value, schema: dict, at: str = "") -> list[str]:
    """What of a JSON value does not fit a JSON schema of the keywords ``CHECKED``."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    here = at or "."
    if kinds and not any(_is(value, kind) for kind in kinds):
        return [f"{here}: not of type {' or '.join(kinds)}"]
    errors = []
    if "enum" in schema and not any(_same(value, v) for v in schema["enum"]):
        errors.append(f"{here}: not one of the values")
    if "const" in schema and not _same(value, schema["const"]):
        errors.append(f"{here}: not the value")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            errors.append(f"{here}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            errors.append(f"{here}: too long")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            errors.append(f"{here}: not of the pattern")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value <= schema.get("exclusiveMinimum", -math.inf):
            errors.append(f"{here}: too small")
        if value > schema.get("maximum", value) or value >= schema.get("exclusiveMaximum", math.inf):
            errors.append(f"{here}: too large")
    if isinstance(value, dict):
        properties, others = schema.get("properties", {}), schema.get("additionalProperties", True)
        errors += [f"{at}.{n}: missing" for n in schema.get("required", []) if n not in value]
        for name, inner in value.items():
            if name in properties:
                errors += schema_errors(inner, properties[name], f"{at}.{name}")
            elif others is False:
                errors.append(f"{at}.{name}: not allowed")
            elif isinstance(others, dict):
                errors += schema_errors(inner, others, f"{at}.{name}")
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            errors.append(f"{here}: not as many items")
        if "items" in schema:
            for n, inner in enumerate(value):
                errors += schema_errors(inner, schema["items"], f"{at}[{n}]")
    return errors


class ArgumentError(ValueError):
    """Why a text is not taken as arguments."""


def parsed_json(text: str):
    """The value of a JSON text. ``ArgumentError`` tells what keeps it from being one, or from
    being written again: NaN and infinities, names given twice, numbers beyond what is read,
    halves of surrogate pairs, and nesting that is too deep."""

    def constant(name: str):
        raise ArgumentError("not JSON")

    def integer(digits: str) -> int:
        if len(digits) > DIGITS:
            raise ArgumentError("number too long")
        return int(digits)

    def number(digits: str) -> float:
        value = float(digits)
        if math.isinf(value):
            raise ArgumentError("number too large")
        return value

    def pairs(items: list[tuple]) -> dict:
        found = dict(items)
        if len(found) < len(items):
            raise ArgumentError("name given twice")
        return found

    try:
        value = json.loads(
            text, parse_constant=constant, parse_int=integer, parse_float=number, object_pairs_hook=pairs
        )
        canonical(value).encode()
    except ArgumentError:
        raise
    except RecursionError:
        raise ArgumentError("nested too deeply") from None
    except UnicodeEncodeError:
        raise ArgumentError("half of a surrogate pair") from None
    except ValueError:
        raise ArgumentError("not JSON") from None
    return value


def canonical(value) -> str:
    """JSON with sorted names, no white space, and characters beyond ASCII as they are."""
    return json.dumps(
        value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False
    )


def _serialized(schemas: dict[str, dict]):
    """Errors of the arguments, and the canonical line, of events (row, kind, role, text,
    call_id, name, arguments, linked)."""

    def one(kind, role, text, call_id, name, arguments, linked) -> tuple[list[str], str]:
        line = {"role": role, "content": text}
        if kind == MESSAGE:
            return [], canonical(line)
        line |= {"call_id": call_id, "linked": linked}
        if kind == RESULT:
            return [], canonical(line)
        try:
            parsed = parsed_json(arguments or "null")
            known = name in schemas
            errors = schema_errors(parsed, schemas[name]) if known else [".: unknown tool"]
        except ArgumentError as error:
            errors, parsed = [f".: {error}"], arguments
        except RecursionError:
            errors, parsed = [".: nested too deeply"], arguments
        del line["content"]
        return errors, canonical(line | {"name": name, "arguments": parsed})

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 9)]
            made = [one(*event) for event in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([e for e, _ in made], pa.list_(pa.string())),
                    pa.array([line for _, line in made], pa.string()),
                ],
                ["_row", "_key", "errors", "json"],
            )

    return serialize


def _cycles(after: dict[int, list[int]]) -> dict[int, int]:
    """A number for the cycle of each vertex: those that reach each other have the same one, and
    a vertex on no cycle has its own (Tarjan, without recursion)."""
    index, low, cycle, open_, path = {}, {}, {}, set(), []
    for start in after:
        if start in index:
            continue
        index[start] = low[start] = len(index)
        path.append(start)
        open_.add(start)
        stack = [(start, iter(after[start]))]
        while stack:
            u, rest = stack[-1]
            for v in rest:
                if v not in index:
                    index[v] = low[v] = len(index)
                    path.append(v)
                    open_.add(v)
                    stack.append((v, iter(after[v])))
                    break
                if v in open_:
                    low[u] = min(low[u], index[v])
            else:
                stack.pop()
                if stack:
                    low[stack[-1][0]] = min(low[stack[-1][0]], low[u])
                if low[u] == index[u]:
                    while True:
                        v = path.pop()
                        open_.discard(v)
                        cycle[v] = low[u]
                        if v == u:
                            break
    return cycle


def places(edges: list[tuple[int, int]], turns: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Rank and depth of each vertex: the latest turn among the vertex and those it depends on,
    and the longest way from there. Edges between vertices of one cycle do not count; all
    others do, also those to and from a cycle."""
    after = {v: [] for v in turns}
    for u, v in edges:
        after[u].append(v)
    cycle = _cycles(after)
    waits = dict.fromkeys(turns, 0)
    for u, v in edges:
        waits[v] += cycle[u] != cycle[v]
    at = {v: (turn, 0) for v, turn in turns.items()}
    ready = [v for v, n in waits.items() if not n]
    while ready:
        u = ready.pop()
        rank, depth = at[u]
        for v in after[u]:
            if cycle[u] != cycle[v]:
                at[v] = max(at[v], (rank, depth + 1))
                waits[v] -= 1
                if not waits[v]:
                    ready.append(v)
    return at


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the vertices of edges (root, u, v, from, to), of which those of a component
    follow each other; ``from`` and ``to`` are the turns of ``u`` and ``v``."""

    def made(edges, turns) -> pa.RecordBatch:
        at = places(edges, turns)
        keys = pa.array(at.keys(), pa.int64())
        ranks, depths = (pa.array([p[i] for p in at.values()], pa.int64()) for i in (0, 1))
        return pa.RecordBatch.from_arrays([keys, ranks, depths], ["_key", "_rank", "_depth"])

    last, edges, turns = None, [], {}
    for batch in batches:
        for root, u, v, turn_u, turn_v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            # Components are taken together until they are many, as a batch has its price.
            if root != last and len(edges) >= EDGES:
                yield made(edges, turns)
                edges, turns = [], {}
            last = root
            edges.append((u, v))
            turns[u], turns[v] = turn_u, turn_v
    if edges:
        yield made(edges, turns)


def _ordered(events: DataFrame, edges: DataFrame, work: Work) -> DataFrame:
    """Add ``_rank`` and ``_depth``: after sorting by them, each event comes after those it
    depends on, but for events of one cycle, which need each other. An event keeps its turn as
    its rank unless something it needs comes later.

    An event whose turn lies in no interval from an event to a later or equal turn that it
    needs keeps its place, whatever it needs: all that is before it. So only edges to events inside such
    intervals are gone through; those of a component by one task, which holds its keys and turns.
    All events of a cycle lie in such intervals.
    """
    turns = events.select("_key", "_turn")
    edges = work.write(
        edges.distinct()
        .join(turns.select(F.col("_key").alias("u"), F.col("_turn").alias("from")), "u")
        .join(turns.select(F.col("_key").alias("v"), F.col("_turn").alias("to")), "v")
        .select("conv_id", "u", "v", "from", "to"),
        "edges",
    )
    rank, depth = F.col("_turn").alias("_rank"), F.lit(0).cast("long").alias("_depth")
    if edges.filter(F.col("from") >= F.col("to")).isEmpty():
        return events.select("*", rank, depth)
    inside = work.write(_inside_intervals(edges), "inside")
    roots = components(inside.select(F.col("u").alias("a"), F.col("v").alias("b")), work, "order")
    inside = inside.join(roots.select(F.col("v").alias("u"), "root"), "u")
    inside = inside.select("root", "u", "v", "from", "to")
    inside = inside.repartition("root").sortWithinPartitions("root")
    schema = "_key bigint, _rank bigint, _depth bigint"
    moved = work.write(piped(inside, [_placed], schema), "order-places")
    moved = moved.select("_key", F.struct("_rank", "_depth").alias("_at"))
    return events.join(moved, "_key", "left").select(
        *events.columns,
        F.coalesce("_at._rank", "_turn").alias("_rank"),
        F.coalesce("_at._depth", F.lit(0).cast("long")).alias("_depth"),
    )


def _inside_intervals(edges: DataFrame) -> DataFrame:
    """Edges to events whose turn lies between the turns of an edge of their conversation that
    goes against the turns, both included. A long conversation is looked at by stretches of turns."""
    reach = F.when(F.col("from") >= F.col("to"), F.col("from"))
    cut = edges.withColumns({"_reach": reach, "_stretch": F.floor(F.col("to") / STRETCH)})
    earlier = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        cut.groupBy("conv_id", "_stretch")
        .agg(F.max("_reach").alias("_most"))
        .withColumn("_before", F.max("_most").over(earlier))
        .select("conv_id", "_stretch", "_before")
    )
    so_far = F.max("_reach").over(Window.partitionBy("conv_id", "_stretch").orderBy("to"))
    cut = cut.withColumn("_so_far", so_far).join(before, ["conv_id", "_stretch"])
    return cut.filter(F.greatest("_so_far", "_before") >= F.col("to")).select(*edges.columns)


def format_chats(events: DataFrame, schemas: dict[str, dict], work: Work) -> DataFrame:
    """Add kind's partner, order, validity and canonical JSON to each event of conversations.

    ``events`` has conv_id, turn, kind (message, call or result), role, text, call_id, name,
    arguments (JSON text of a call) and needs (identifiers of the calls whose results a call
    uses). Added are ``seq`` (0, 1, ... in the conversation), ``linked`` (a result has its
    call, a call has a result; null for messages), ``errors`` (of a call's arguments, against
    the schema of its tool) and ``json``.

    Any text is taken as arguments: one that is no JSON, or cannot be written again (see
    ``parsed_json``), is an error and stays a text. A schema with a keyword that is not checked
    raises ``ValueError``.

    Results join calls by (conv_id, call_id); of calls with the same identifier, the one of the
    lowest turn is linked, and the others are as if without identifier. Events are in order of
    turns, but a result comes after its call, and a call after the results it needs, however
    long the chain; only what events of one cycle need of each other does not count. Events
    with a null conv_id or call_id are never linked; a null turn comes first. Repeated rows
    stay. Columns named like the result are replaced; others are kept. A large conversation is
    sorted by several tasks, and its lines stay rows. Texts of any length are written whole; no
    events give no lines.
    """
    for name, schema in schemas.items():
        check_schema(schema, name)
    added = ["seq", "linked", "errors", "json"]
    rows = events.select(
        packed(events, added).alias("_row"),
        F.monotonically_increasing_id().alias("_key"),
        "conv_id", "kind", "role", "text", "call_id", "name", "arguments", "needs",
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**62))).alias("_turn"),
    )
    rows = work.write(rows, "events")
    calls = (
        rows.filter((F.col("kind") == CALL) & F.col("call_id").isNotNull())
        .groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("_turn", "_key"))["_key"].alias("call"))
    )
    results = rows.filter(F.col("kind") == RESULT).select(
        "conv_id", "call_id", F.col("_key").alias("result")
    )
    links = work.write(results.join(calls, ["conv_id", "call_id"]), "links")
    needed = rows.filter(F.col("kind") == CALL).select(
        "conv_id", F.col("_key").alias("v"), F.explode("needs").alias("call_id")
    )
    edges = links.select("conv_id", F.col("call").alias("u"), F.col("result").alias("v")).unionByName(
        links.join(needed, ["conv_id", "call_id"]).select("conv_id", F.col("result").alias("u"), "v")
    )
    partners = links.select(F.col("result").alias("_key")).unionByName(
        links.select(F.col("call").alias("_key"))
    ).distinct().withColumn("_linked", F.lit(True))
    linked = F.when(F.col("kind") != MESSAGE, F.coalesce("_linked", F.lit(False)))
    ordered = _ordered(rows, edges, work).join(partners, "_key", "left").withColumn("linked", linked)
    ordered = work.write(ordered, "ordered")

    inputs = ["_row", "_key", "kind", "role", "text", "call_id", "name", "arguments", "linked"]
    row = rows.schema["_row"].dataType.simpleString()
    schema = f"_row {row}, _key bigint, errors array<string>, json string"
    lines = piped(ordered.select(*inputs), [_serialized(schemas)], schema)
    keys = ordered.select("conv_id", "_rank", "_depth", "_turn", "_key", "linked")
    places = numbered(keys, "conv_id", ["_rank", "_depth", "_turn", "_key"], "seq", work, "places")
    lines = lines.join(places.select("_key", "seq", "linked"), "_key")
    return lines.select(*unpacked(lines), *added)
