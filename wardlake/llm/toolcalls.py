"""Tool calls of conversations, linked to their results and put in dependency order.

Calls and results meet in a hash join on (conversation, identifier, number of the repeat). A call's arguments are
checked against its tool's schema, and may refer to other calls of the conversation with
{"$ref": "<call id>"}; these references order the calls. Each call becomes one line of canonical
JSON (sorted keys, no spare white space, integral numbers without a fraction).

Scale: everything is keyed by (conversation, identifier, number of the repeat), so a conversation
of any length, or one identifier used throughout, is spread over tasks; none is gathered in one.
Ordering: the references of a conversation that has few of them (``IN_ONE_TASK``) are ordered in
one task, whatever their chain's length. The calls of larger conversations, and those without
one, are peeled off round by round as their references settle; a round joins only the references
of the calls settled last, so the work is linear and the rounds are as many as the longest chain.
What has settled is written once every few rounds, so the plan does not grow with the chain.
"""

from __future__ import annotations

import functools
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Python types of the JSON types of a schema (a boolean is no number).
_TYPES = {"string": (str,), "integer": (int,), "number": (int, float), "boolean": (bool,), "array": (list,),
          "object": (dict,), "null": (type(None),)}


def _same_json(a, b) -> bool:
    """Equality of JSON values: true is not 1."""
    return canonical(a) == canonical(b)


#: Keyword -> fault of a value of the keyword's kind, or none.
_LIMITS = {
    "minimum": ((int, float), lambda v, m: v < m), "maximum": ((int, float), lambda v, m: v > m),
    "exclusiveMinimum": ((int, float), lambda v, m: v <= m), "exclusiveMaximum": ((int, float), lambda v, m: v >= m),
    "minLength": (str, lambda v, m: len(v) < m), "maxLength": (str, lambda v, m: len(v) > m),
    "minItems": (list, lambda v, m: len(v) < m), "maxItems": (list, lambda v, m: len(v) > m),
    "pattern": (str, lambda v, m: not re.search(m, v)),
}
_LISTS = ("anyOf", "oneOf", "allOf")
_KEYWORDS = {"type", "enum", "const", "items", "properties", "required", "additionalProperties", "title", "description",
             "default", *_LIMITS, *_LISTS}


def checked_schema(schema: dict, at: str = "#") -> dict:
    """The schema itself, if every keyword and type in it is one that :func:`faults` knows; else ValueError.
    Nothing in a schema is passed over silently."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema is an object")
    unknown = sorted(set(schema) - _KEYWORDS)
    if unknown:
        raise ValueError(f"{at}: unknown keywords {unknown}")
    for kind in _kinds(schema):
        if kind not in _TYPES:
            raise ValueError(f"{at}: unknown type {kind!r}")
    if "pattern" in schema:
        try:
            re.compile(schema["pattern"])
        except re.error as e:
            raise ValueError(f"{at}: pattern {e}") from None
    for name, part in schema.get("properties", {}).items():
        checked_schema(part, f"{at}/{name}")
    for i, part in enumerate(x for word in _LISTS for x in schema.get(word, [])):
        checked_schema(part, f"{at}/{i}")
    if "items" in schema:
        checked_schema(schema["items"], f"{at}/items")
    if not isinstance(schema.get("additionalProperties", True), bool):
        checked_schema(schema["additionalProperties"], f"{at}/additionalProperties")
    return schema


def _kinds(schema: dict) -> list:
    kinds = schema.get("type", [])
    return kinds if isinstance(kinds, list) else [kinds]


def faults(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with ``value`` under ``schema``: type (one or a list), enum, const, limits of numbers,
    lengths and items, pattern, items, properties, required, additionalProperties, anyOf, oneOf, allOf."""
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []       # its value is not known before the call it names has run
    kinds = _kinds(schema)
    if kinds and not any(isinstance(value, _TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number")) for k in kinds):
        return [f"{at}: not of type {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and not any(_same_json(value, x) for x in schema["enum"]):
        out.append(f"{at}: not one of the values allowed")
    if "const" in schema and not _same_json(value, schema["const"]):
        out.append(f"{at}: not the value allowed")
    for name, (kind, bad) in _LIMITS.items():
        if name in schema and isinstance(value, kind) and not isinstance(value, bool) and bad(value, schema[name]):
            out.append(f"{at}: does not match the pattern" if name == "pattern" else f"{at}: beyond the {name}")
    fits = {word: sum(not faults(value, x, at) for x in schema[word]) for word in _LISTS if word in schema}
    if fits.get("anyOf", 1) == 0 or fits.get("oneOf", 1) != 1 or fits.get("allOf", len(schema.get("allOf", []))) < len(schema.get("allOf", [])):
        out.append(f"{at}: not one of the forms allowed")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += faults(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known, other = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [f"{at}: {name} is missing" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in known:
                out += faults(value[name], known[name], f"{at}.{name}")
            elif other is False:
                out.append(f"{at}: {name} is not allowed")
            elif isinstance(other, dict):
                out += faults(value[name], other, f"{at}.{name}")
    return out


def references(value) -> set[str]:
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return {value["$ref"]}
        return set().union(*map(references, value.values()))
    return set().union(*map(references, value)) if isinstance(value, list) else set()


def _unique(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("an object repeats a key")
    return out


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON number")


def _integral(value):
    if isinstance(value, float):
        return int(value) if value.is_integer() and abs(value) < 2 ** 53 else value
    if isinstance(value, dict):
        return {k: _integral(v) for k, v in value.items()}
    return [_integral(v) for v in value] if isinstance(value, list) else value


def load(text: str | None):
    """Strict JSON: no repeated keys, no NaN or infinity, no lone surrogates."""
    if text is None:
        raise ValueError("no arguments")
    value = _integral(json.loads(text, object_pairs_hook=_unique, parse_constant=_refuse))
    canonical(value).encode()
    return value


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def check(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[str | None, list[str], list[str]]:
    """Canonical arguments (null if they are no JSON), faults and references of one call."""
    try:
        value = load(arguments)
        refs = sorted(references(value))
    except (ValueError, RecursionError) as e:
        return None, [f"$: {type(e).__name__ if isinstance(e, RecursionError) else str(e)[:80]}"], []
    if name not in schemas:
        return canonical(value), ["unknown tool"], refs
    return canonical(value), faults(value, schemas[name]), refs


_SEP = ["conv_id", "call_id"]


def _same(a: str, b: str) -> Column:
    """Keys with prefixes ``a`` and ``b``: conversations null-safe, identifiers equal."""
    return F.col(f"{a}conv_id").eqNullSafe(F.col(f"{b}conv_id")) & (F.col(f"{a}call_id") == F.col(f"{b}call_id"))


def _numbered(rows: DataFrame, prefix: str, *cols: str) -> DataFrame:
    """All rows that have an identifier, each with a ``node`` of its own, its place ``k`` among
    those of its key by position (ties: by a hash of the row), and their number ``n``.

    One key may hold a third of all rows: the sorted rows are cut into ranges, places are counted
    within (range, key), and what the ranges before hold of the key is added."""
    cut = written(rows.where(F.col("call_id").isNotNull())
                  .select(*_SEP, "position", *cols, F.xxhash64(*cols).alias("tie"), F.monotonically_increasing_id().alias("node"))
                  .repartitionByRange(*_SEP, "position", "tie", "node").withColumn("range", F.spark_partition_id()), "ranges")
    key = Window.partitionBy(*_SEP)
    before = (cut.groupBy("range", *_SEP).agg(F.count(F.lit(1)).alias("own"))       # a key: at most a row for each range
              .select(F.col("range").alias("b_range"), F.col("conv_id").alias("b_conv_id"), F.col("call_id").alias("b_call_id"),
                      F.sum("own").over(key).alias("n"), (F.sum("own").over(key.orderBy("range")) - F.col("own")).alias("before")))
    inside = cut.withColumn("inside", F.row_number().over(Window.partitionBy("range", *_SEP).orderBy("position", "tie", "node")))
    return (inside.join(before, (F.col("range") == F.col("b_range")) & F.col("conv_id").eqNullSafe(F.col("b_conv_id"))
                        & (F.col("call_id") == F.col("b_call_id")))
            .select(*[F.col(c).alias(prefix + c) for c in (*_SEP, "position", *cols, "node", "n")],
                    (F.col("inside") + F.col("before")).alias(prefix + "k")))


def _place(prefix: str, alone: int) -> Column:
    """Place under which a row meets the other side. Rows without a conversation may belong to
    different ones, so repeats among them meet nothing: ``alone`` sets the two sides apart."""
    k = F.col(prefix + "k")
    return F.when(F.col(prefix + "conv_id").isNull() & (F.col(prefix + "n") > 1), -2 * k - alone).otherwise(k)


#: So many references of one conversation are ordered in one task.
IN_ONE_TASK = 20_000
_ROUNDS_KEPT = 8


def _order(edges: list[tuple[int, int]]) -> dict[int, int | None]:
    """Level of every node that has references in ``edges`` (node, to); null on a cycle and behind one."""
    waits, next_of = defaultdict(int), defaultdict(list)
    for node, to in edges:
        waits[node] += 1
        next_of[to].append(node)
    level: dict[int, int | None] = {}
    done = [to for to in next_of if to not in waits]
    depth = 0
    while done:
        depth += 1
        freed = []
        for to in done:
            for node in next_of[to]:
                waits[node] -= 1
                if not waits[node]:
                    level[node] = depth
                    freed.append(node)
        done = freed
    return {node: level.get(node) for node in waits}


def _levels_in_tasks(edges: DataFrame) -> DataFrame:
    """(node, level) of the nodes with references; the rows of a conversation lie together in one task,
    which orders whole conversations, some at a time."""
    def leveled(some: list[tuple[int, int]]) -> pa.RecordBatch:
        got = _order(some)
        return pa.RecordBatch.from_arrays([pa.array(list(got), pa.int64()), pa.array(list(got.values()), pa.int32())], ["node", "level"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, last = [], None
        for batch in batches:
            for conv, node, to in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != last and len(some) >= IN_ONE_TASK:
                    yield leveled(some)
                    some = []
                last = conv
                some.append((node, to))
        if some:
            yield leveled(some)

    together = edges.select("conv_id", "node", "to").repartition("conv_id").sortWithinPartitions("conv_id")
    return together.mapInArrow(run, "node long, level int")


def _levels_in_rounds(edges: DataFrame) -> DataFrame:
    """(node, level) of the nodes with references, for conversations of any size."""
    waiting = written(edges.groupBy("node").agg(F.count(F.lit(1)).alias("open")), "waiting")
    back = edges.select(F.col("to").alias("e_to"), F.col("node").alias("e_next"))
    done = edges.select(F.col("to").alias("node")).distinct().join(waiting, "node", "left_anti").select("node", F.lit(0).alias("level"))
    settled, some, level = None, [], 0
    while True:
        level += 1
        freed = (back.join(done.select(F.col("node").alias("d_node")), F.col("e_to") == F.col("d_node"))
                 .groupBy(F.col("e_next").alias("f_node")).agg(F.count(F.lit(1)).alias("freed")))
        left = written(waiting.join(freed, F.col("node") == F.col("f_node"), "left")
                       .select("node", (F.col("open") - F.coalesce("freed", F.lit(0))).alias("open")), "waiting")
        done = left.where("open = 0").select("node", F.lit(level).alias("level"))
        waiting = left.where("open > 0")
        if done.isEmpty():
            break
        some.append(done)
        if len(some) == _ROUNDS_KEPT:
            settled, some = written(functools.reduce(DataFrame.unionByName, some, *([settled] if settled is not None else [])), "settled"), []
    return functools.reduce(DataFrame.unionByName, [*([settled] if settled is not None else []), *some,
                                                    waiting.select("node", F.lit(None).cast("int").alias("level"))])


def levels(nodes: DataFrame, edges: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """(node, level): 0 without references, else one more than the highest level referred to; null
    on a cycle and behind one. ``edges``: conv_id, node -> to; references stay within a conversation."""
    large = (edges.groupBy(F.col("conv_id").alias("l_conv_id")).agg(F.count(F.lit(1)).alias("n"))
             .where((F.col("n") > in_one_task) & F.col("l_conv_id").isNotNull()).drop("n"))     # few or none
    few = written(edges.join(large, F.col("conv_id") == F.col("l_conv_id"), "left").select(
        "conv_id", "node", "to", (F.col("conv_id").isNotNull() & F.col("l_conv_id").isNull()).alias("few")), "ordered-edges")
    found = _levels_in_tasks(few.where("few"))
    many = few.where("NOT few")
    if not many.isEmpty():
        found = found.unionByName(_levels_in_rounds(many))
    found = written(found, "levels").withColumnRenamed("node", "f_node")
    return (nodes.join(found, F.col("node") == F.col("f_node"), "left")
            .select("node", F.when(F.col("f_node").isNull(), F.lit(0)).otherwise(F.col("level")).alias("level")))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and per result without a call of its own.

    ``calls``: conv_id, call_id, name, arguments (JSON text), position; ``results``: conv_id,
    call_id, content, position; other columns are ignored. Returned: conv_id, call_id, position,
    status, level, valid, faults, line. ``status`` is linked, no_result, orphan_result or no_id;
    (level, position, call_id) is a dependency order of the conversation's calls. ``line`` is the
    canonical JSON.

    Repeated identifiers: by position (ties: by a hash of the row), call k gets result k, and its
    references mean call k of the identifier they name, or the last one if there are fewer; what
    is left over is a row too, and the fault lists say so. Null identifiers link to nothing: a row
    each, status no_id. Null conversation: identifiers that occur once there link; of repeated
    ones nobody knows which belong together, so they link to nothing and no reference finds them. Null or broken arguments, unknown tools, references to absent calls,
    and cycles are faults; calls on or behind a cycle have no level. A schema with a keyword or type
    that the check does not know raises ValueError before anything runs. Empty tables: no rows.
    """
    spark = calls.sparkSession
    schemas = {name: checked_schema(schema) for name, schema in schemas.items()}
    pairs = _numbered(calls, "c_", "name", "arguments").withColumn("c_place", _place("c_", 0)).join(
        _numbered(results, "r_", "content").withColumn("r_place", _place("r_", 1)).hint("shuffle_hash"),
        _same("c_", "r_") & (F.col("c_place") == F.col("r_place")), "full")
    shared = spark.sparkContext.broadcast(schemas)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [check(n, a, shared.value) if c is not None else (None, [], [])
                   for c, n, a in zip(batch.column("c_call_id").to_pylist(), batch.column("c_name").to_pylist(),
                                      batch.column("c_arguments").to_pylist())]
            text = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], text),
                 pa.array([x[2] for x in got], text)], [*batch.schema.names, "canonical", "wrong", "refs"])

    checked = written(pairs.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in pairs.dtypes)
                                       + ", canonical string, wrong array<string>, refs array<string>"), "checked-calls")
    asked = checked.select(F.col("c_conv_id").alias("conv_id"), F.col("c_node").alias("node"), F.col("c_k").alias("k"), F.explode("refs").alias("ref"))
    there = (checked.where("c_call_id IS NOT NULL AND c_k = 1")
             .select(F.col("c_conv_id").alias("t_conv_id"), F.col("c_call_id").alias("t_call_id"), F.col("c_n").alias("t_n")))
    named = (asked.join(there, F.col("conv_id").eqNullSafe(F.col("t_conv_id")) & (F.col("ref") == F.col("t_call_id")), "left")
             .select("conv_id", "node", "ref", F.when(F.col("conv_id").isNotNull() | (F.col("t_n") == 1), F.least("k", "t_n")).alias("at")))
    target = checked.where("c_call_id IS NOT NULL").select(
        F.col("c_conv_id").alias("t_conv_id"), F.col("c_call_id").alias("t_call_id"), F.col("c_k").alias("t_k"), F.col("c_node").alias("to"))
    refs = written(named.join(target, F.col("conv_id").eqNullSafe(F.col("t_conv_id")) & (F.col("ref") == F.col("t_call_id"))
                              & (F.col("at") == F.col("t_k")), "left").select("conv_id", "node", "ref", "to"), "references")
    lost = refs.where("to IS NULL").groupBy("node").agg(F.array_sort(F.collect_set("ref")).alias("lost"))    # of one call
    order = levels(checked.where("c_call_id IS NOT NULL").select(F.col("c_node").alias("node")), refs.where("to IS NOT NULL").select("conv_id", "node", "to"))

    ranked = (checked.join(order.select(F.col("node").alias("o_node"), "level"), F.col("c_node") == F.col("o_node"), "left")
              .join(lost.select(F.col("node").alias("l_node"), "lost"), F.col("c_node") == F.col("l_node"), "left"))
    call = F.col("c_call_id").isNotNull()
    more = [F.when(F.col("c_n") > 1, F.lit("call identifier repeats")), F.when(F.col("r_n") > 1, F.lit("more than one result")),
            F.when(call & F.col("level").isNull(), F.lit("references form a cycle")),
            F.when(F.col("r_position") < F.col("c_position"), F.lit("result before call"))]
    wrong = F.concat(F.coalesce("wrong", F.array().cast("array<string>")),
                     F.transform(F.coalesce("lost", F.array().cast("array<string>")), lambda r: F.concat(F.lit("unknown reference "), r)),
                     F.filter(F.array(*more), lambda x: x.isNotNull()))
    status = F.when(~call, "orphan_result").when(F.col("r_call_id").isNull(), "no_result").otherwise("linked")
    out = ranked.select(F.when(call, F.col("c_conv_id")).otherwise(F.col("r_conv_id")).alias("conv_id"),
                        F.coalesce("c_call_id", "r_call_id").alias("call_id"), F.coalesce("c_position", "r_position").alias("position"),
                        status.alias("status"), F.col("level").cast("int").alias("level"), wrong.alias("faults"),
                        F.col("c_name").alias("name"), F.col("canonical"), F.col("r_content").alias("content"))
    none = F.lit(None).cast("string")
    loose = (calls.where(F.col("call_id").isNull()).select("conv_id", "position", F.col("name"), none.alias("content"))
             .unionByName(results.where(F.col("call_id").isNull()).select("conv_id", "position", none.alias("name"), "content"))
             .select("conv_id", none.alias("call_id"), "position", F.lit("no_id").alias("status"), F.lit(None).cast("int").alias("level"),
                     F.array(F.lit("no identifier")).alias("faults"), "name", none.alias("canonical"), "content"))
    return _lines(out.unionByName(loose)).select("conv_id", "call_id", "position", "status", "level",
                                                 (F.size("faults") == 0).alias("valid"), "faults", "line")


def _lines(rows: DataFrame) -> DataFrame:
    """Adds ``line``: keys in order, absent values left out, arguments as checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for x in batch.to_pylist():
                arguments = json.loads(x["canonical"]) if x["canonical"] is not None else None
                full = {"arguments": arguments, "call_id": x["call_id"], "conv_id": x["conv_id"], "faults": x["faults"],
                        "level": x["level"], "name": x["name"], "position": x["position"], "result": x["content"], "status": x["status"]}
                lines.append(canonical({k: v for k, v in full.items() if v is not None}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.string())], [*batch.schema.names, "line"])

    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", line string")


#: Tools of the registered query.
TOOLS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False, "properties": {
        "query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 40},
        "context": {"type": "array", "items": {"type": "object"}}}},
    "translate": {"type": "object", "required": ["query", "language"], "properties": {
        "query": {"type": "string"}, "language": {"type": "string", "enum": ["de", "en", "es", "fr"]},
        "context": {"type": "array", "items": {"type": "object"}}}},
}


def from_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of ``conversations`` stand for: each user turn asks a tool
    (its text is the query), the assistant turn behind it answers. Other arguments, references to
    the question before or after, and mistakes follow from the text's hash. Turns of any other role
    (system) stand for no call."""
    h = F.pmod(F.xxhash64("text"), F.lit(1000))

    def call(turn: Column) -> Column:
        return F.concat(F.lit("call_"), turn.cast("string"))

    refs = F.concat(F.when((F.col("turn") >= 2) & (h % 2 == 0), F.array(F.struct(call(F.col("turn") - 2).alias("$ref")))).otherwise(F.array()),
                    F.when(h % 7 == 0, F.array(F.struct(call(F.col("turn") + 2).alias("$ref")))).otherwise(F.array()))
    context = F.when(F.size(refs) > 0, refs)
    name = F.when(h % 11 == 0, "measure").when(h % 3 == 0, "translate").otherwise("search")
    language = F.get(F.array(*map(F.lit, ["en", "fr", "de", "es", "it"])), (h % 5).cast("int"))
    arguments = F.when(name == "translate", F.to_json(F.struct(F.col("text").alias("query"), language.alias("language"), context.alias("context")))
                       ).otherwise(F.to_json(F.struct((h % 45).alias("limit"), context.alias("context"), F.col("text").alias("query"))))
    asks = conversations.where("role = 'user'").select(
        "conv_id", call(F.col("turn")).alias("call_id"), name.alias("name"), arguments.alias("arguments"), F.col("turn").alias("position"))
    answers = conversations.where("role = 'assistant'").select(
        "conv_id", call(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"), F.col("turn").alias("position"))
    return asks, answers
