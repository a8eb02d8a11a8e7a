"""Tool-call linking, in DataFrame functions only.

Calls and results are joined by identifier; calls are put in the order of their
dependencies by pointer doubling, in as many rounds as the logarithm of the
longest chain; arguments are checked against a table of schemas, and each call is
serialised as canonical JSON (keys in order, no white space).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import settle


@dataclass(frozen=True)
class Argument:
    """Of a tool: an argument's name and JSON type, whether it is required, and the bounds of its value or length."""

    tool: str
    name: str
    type: str
    required: bool = True
    least: float | None = None
    most: float | None = None


#: How each JSON type looks as the text of a value.
TYPES = {"integer": r"\A-?[0-9]+\z", "number": r"\A-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?\z", "boolean": r"\A(true|false)\z", "string": None}


def canonical(json: Column) -> Column:
    """JSON with the keys of every object in order and no white space; null if it is malformed."""
    return F.to_json(F.try_parse_json(json))


def argument_errors(calls: DataFrame, schemas: list[Argument]) -> Column:
    """The errors of `arguments` (JSON) of a call of the tool `name`, in order of the schema."""
    parsed = F.try_parse_json("arguments")
    tools = sorted({a.tool for a in schemas})
    errors = [F.when(F.col("arguments").isNull() | parsed.isNull(), "malformed arguments"), F.when(F.col("name").isNull() | ~F.col("name").isin(tools), "unknown tool")]
    for a in schemas:
        path = f"$['{a.name}']"
        kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
        value = F.try_variant_get(parsed, path, "string")
        missing = value.isNull()
        if a.type == "string":
            wrong, size = kind != "STRING", F.length(value).cast("double")
        else:
            wrong, size = (kind == "STRING") | ~value.rlike(TYPES[a.type]), value.try_cast("double")
        found = F.when(missing, F.lit(f"{a.name}: missing") if a.required else F.lit(None)).when(wrong, f"{a.name}: not {a.type}")
        if a.least is not None:
            found = found.when(size < a.least, f"{a.name}: too small")
        if a.most is not None:
            found = found.when(size > a.most, f"{a.name}: too large")
        errors.append(F.when((F.col("name") == a.tool) & parsed.isNotNull(), found))
    return F.array_compact(F.array(*errors))


def depths(calls: DataFrame) -> DataFrame:
    """(thread, id, depth): how many calls each waits for, along `after`; null in a cycle or behind a missing call.

    Round by round a call points to the one twice as far back.
    """
    at = settle(calls.select("thread", "id", F.col("after").alias("up"), F.when(F.col("after").isNull(), 0).otherwise(1).alias("depth")))
    n = at.count()
    waiting = was = None
    rounds = max(1, n.bit_length() + 1)
    for _ in range(rounds):
        waiting = at.where("up IS NOT NULL").count()
        if not waiting or waiting == was and _stuck(at):
            break
        was = waiting
        back = at.select("thread", F.col("id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"))
        at = settle(at.join(back.withColumn("there", F.lit(True)), ["thread", "up"], "left").select("thread", "id", F.when(F.col("there"), F.col("up2")).otherwise(F.col("up")).alias("up"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth")))
    return at.select("thread", "id", F.when(F.col("up").isNull(), F.col("depth")).cast("long").alias("depth"))


def _stuck(at: DataFrame) -> bool:
    """Does every call that still waits point to a missing one or round a cycle?"""
    done = at.where("up IS NULL").select("thread", F.col("id").alias("up"))
    return at.join(done, ["thread", "up"], "left_semi").isEmpty()


def longest_paths(calls: DataFrame, dependencies: DataFrame) -> DataFrame:
    """(thread, id, depth): the longest path of dependencies (thread, id, after) that leads to each call; null in or behind a cycle or a missing call.

    Layer by layer: a call whose dependencies all have a depth comes after the deepest.
    Rounds are as many as the longest path has calls; each looks at the calls that are
    left only.
    """
    calls = calls.select("thread", "id").distinct()
    edges = settle(dependencies.where("after IS NOT NULL").select("thread", "id", "after").distinct().join(calls.hint("shuffle_hash"), ["thread", "id"], "left_semi"))
    waiting = edges.groupBy("thread", "id").agg(F.count(F.lit(1)).alias("n"))
    done = settle(calls.join(waiting, ["thread", "id"], "left_anti").select("thread", "id", F.lit(0).cast("long").alias("depth")))
    fresh, depth = done, 0
    while not fresh.isEmpty():
        depth += 1
        met = edges.join(done.select("thread", F.col("id").alias("after")), ["thread", "after"], "left_semi").groupBy("thread", "id").agg(F.count(F.lit(1)).alias("met"))
        fresh = settle(met.join(waiting, ["thread", "id"]).where("met = n").join(done, ["thread", "id"], "left_anti").select("thread", "id", F.lit(depth).cast("long").alias("depth")))
        done = done.unionByName(fresh)
    return calls.join(done, ["thread", "id"], "left")


def link_calls(calls: DataFrame, results: DataFrame, schemas: list[Argument], dependencies: DataFrame | None = None) -> DataFrame:
    """A row for each distinct call (thread, id, name, arguments, after) with its result (thread, id, content).

    Returns thread, id, name, depth (its place in topological order: ties by id),
    n_results, errors (array) and json: the call's arguments, id, name and result as
    canonical JSON, null with any error: keys in order, no white space, numbers as the
    VARIANT type holds them.  Calls that wait for several others name them in
    `dependencies` (thread, id, after), which then count in place of `after`.

    Of several calls with the same thread and id the smallest (name, arguments, after)
    counts, and `duplicate id` is an error unless they are equal; of several results
    the smallest content counts, and unequal ones are an error.  A call without a
    result has the error `no result`, one in a cycle or behind a missing call
    `unordered`.  Results without a call, and rows with a null thread or id, are left
    out.  Empty tables: empty result.
    """
    calls = calls.select("thread", "id", "name", "arguments", "after").where("thread IS NOT NULL AND id IS NOT NULL")
    one = F.struct("name", "arguments", "after")
    calls = calls.groupBy("thread", "id").agg(F.min(one).alias("c"), (F.min(one) != F.max(one)).alias("twice")).select("thread", "id", "c.*", "twice")
    answers = results.where("thread IS NOT NULL AND id IS NOT NULL").groupBy("thread", "id").agg(F.count(F.lit(1)).alias("n_results"), F.min("content").alias("result"), (F.min("content") != F.max("content")).alias("unequal"))
    order = depths(calls) if dependencies is None else longest_paths(calls, dependencies)
    linked = calls.join(answers.hint("shuffle_hash"), ["thread", "id"], "left").join(order.hint("shuffle_hash"), ["thread", "id"])
    errors = F.concat(
        argument_errors(linked, schemas),
        F.array_compact(F.array(F.when(F.col("twice"), "duplicate id"), F.when(F.col("n_results").isNull(), "no result"), F.when(F.col("unequal"), "unequal results"), F.when(F.col("depth").isNull(), "unordered"))),
    )
    linked = linked.withColumn("errors", errors)
    json = F.to_json(F.struct(F.try_parse_json("arguments").alias("arguments"), "id", "name", "result"), {"ignoreNullFields": "false"})
    return linked.select("thread", "id", "name", "depth", F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), "errors", F.when(F.size("errors") == 0, json).alias("json"))


#: Calls of the conversations table: a turn of the user asks the tool `reply`, and one of the system sets the tool `configure`.
CONVERSATION_TOOLS = [
    Argument("reply", "text", "string", True, 1), Argument("reply", "turn", "integer", True, 0),
    Argument("configure", "text", "string", True, 1), Argument("configure", "turn", "integer", True, 0),
]


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from turns (conv_id, turn, role, text).

    A turn of the user or the system is a call, its arguments the text and the turn's
    number; the next turn, if it is the assistant's, is its result.  A call waits for
    the one before it in its conversation, if the turn between is the assistant's or
    it follows directly.
    """
    turns = turns.select("conv_id", "turn", "role", "text").where("conv_id IS NOT NULL AND turn IS NOT NULL")
    name = lambda turn: F.format_string("call-%d", turn)
    asks = turns.where("role IN ('user', 'system')")
    before = asks.select("conv_id", "turn").distinct()
    calls = asks.select("conv_id", "turn", F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"), F.to_json(F.struct("turn", "text")).alias("arguments"))
    for back in (1, 2):
        earlier = before.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("turn").alias(f"before{back}"))
        calls = calls.join(earlier.hint("shuffle_hash"), ["conv_id", "turn"], "left")
    calls = calls.select(F.col("conv_id").alias("thread"), name(F.col("turn")).alias("id"), "name", "arguments", F.when(F.coalesce("before1", "before2").isNotNull(), name(F.coalesce("before1", "before2"))).alias("after"))
    results = turns.where("role = 'assistant'").select(F.col("conv_id").alias("thread"), name(F.col("turn") - 1).alias("id"), F.col("text").alias("content"))
    return calls, results
