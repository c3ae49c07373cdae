"""Chat formatting: tool calls linked to their results (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise

#: JSON types and how Spark names them in a variant's schema.
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$",
         "array": "^ARRAY<", "object": "^OBJECT<"}
CALL = ["conv_id", "call_id"]

Schema = dict[str, tuple[str, bool]]


def errors(name: Column, arguments: Column, schemas: dict[str, Schema]) -> Column:
    """What is wrong with a call, sorted: unknown_tool, not_json, missing:field, type:field, unknown:field.

    ``schemas`` gives each tool's fields, their JSON type and whether they are
    required. Arguments must be one JSON object without repeated keys.
    """
    v = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT<"), F.lit(False))

    def of(schema: Schema) -> Column:
        found = []
        for field, (kind, required) in sorted(schema.items()):
            path = "$['" + field.replace("'", "\\'") + "']"
            there = F.array_contains(F.json_object_keys(arguments), field)
            right = F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")).rlike(TYPES[kind]), F.lit(False))
            found.append(F.when(there & ~right, F.lit(f"type:{field}")))
            if required:
                found.append(F.when(~there, F.lit(f"missing:{field}")))
        unknown = F.transform(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in schema]).cast("array<string>")),
                              lambda k: F.concat(F.lit("unknown:"), k))
        return F.array_sort(F.concat(F.array_compact(F.array(*found)).cast("array<string>"), unknown))

    checked = F.array(F.lit("unknown_tool"))
    for tool, schema in sorted(schemas.items()):
        checked = F.when(name == tool, F.when(~is_object, F.array(F.lit("not_json"))).otherwise(of(schema))).otherwise(checked)
    return checked


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): how many calls a call depends on, one after the other.

    ``calls`` (conv_id, call_id, parent_id) has each call once. Every round
    doubles the reach: a call takes its ancestor's ancestor and adds the
    distance. A round that resolves no call leaves only those on a cycle, or
    below one; their level is null. A parent that isn't a call counts as none.
    """
    known = calls.select(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_call"))
    state = calls.join(known, [F.col("conv_id") == F.col("k_conv"), F.col("parent_id") == F.col("k_call")], "left").select(
        *CALL, F.col("k_call").alias("up"), F.when(F.col("k_call").isNull(), 0).otherwise(1).cast("long").alias("level"))
    done = materialise(state, "levels")
    open_ = done.filter("up is not null").count()
    while open_:
        there = done.select(F.col("conv_id").alias("t_conv"), F.col("call_id").alias("t_call"), F.col("up").alias("t_up"), F.col("level").alias("t_level"))
        step = done.join(there, [F.col("conv_id") == F.col("t_conv"), F.col("up") == F.col("t_call")], "left").select(
            *CALL, F.col("t_up").alias("up"), (F.col("level") + F.coalesce("t_level", F.lit(0))).alias("level"))
        done = materialise(step, "levels")
        before, open_ = open_, done.filter("up is not null").count()
        if open_ == before:
            break
    return done.select(*CALL, F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """One row per tool call, and per result without a call, in an order in which calls follow what they depend on.

    ``calls`` (conv_id, call_id, turn, name, arguments, parent_id) and
    ``results`` (conv_id, call_id, turn, content) meet by conversation and
    identifier; where one comes twice or more, the one with the smallest turn
    counts (then the smallest hash), and n_calls and n_results say how many
    there were. Columns: conv_id, call_id, level, turn, status (linked,
    no_result, no_call, cycle), errors (see :func:`errors`; empty for a result
    without a call), n_calls, n_results, and json: the call as canonical JSON,
    keys sorted, no white space, arguments sorted likewise (as a string where
    they are no JSON object). Rows are sorted by conv_id, level (null last),
    turn, call_id; a range sort spreads a hot conversation.

    Rows without a conversation or an identifier are linked with nothing and
    left out; null arguments are not_json; a null name is an unknown tool.
    Other columns are not read; two empty tables give an empty one.
    """
    def once(rows: DataFrame, n: str, *fields: str) -> DataFrame:
        row = F.struct(*fields)
        return rows.dropna(subset=CALL).groupBy(*CALL).agg(F.min_by(row, F.struct(F.col("turn"), F.xxhash64(row))).alias("x"), F.count("*").alias(n))

    made = once(calls.select(*CALL, "turn", "name", "arguments", "parent_id"), "n_calls", "turn", "name", "arguments", "parent_id")
    made = materialise(made.select(*CALL, "n_calls", "x.*"), "calls")
    got = once(results.select(*CALL, "turn", "content"), "n_results", "turn", "content")
    got = got.select(*CALL, "n_results", F.col("x.turn").alias("r_turn"), F.col("x.content").alias("content"))
    made = made.join(levels(made), CALL, "left")
    both = made.join(got, CALL, "full")
    is_call = F.col("n_calls").isNotNull()
    status = (F.when(~is_call, "no_call").when(F.col("level").isNull(), "cycle").when(F.col("n_results").isNull(), "no_result").otherwise("linked"))
    v = F.try_parse_json("arguments")
    parsed = F.when(F.schema_of_variant(v).startswith("OBJECT<"), F.to_json(v)).otherwise(_quoted(F.col("arguments")))
    json = F.concat(F.lit('{"arguments":'), parsed, F.lit(',"call_id":'), _quoted(F.col("call_id")), F.lit(',"name":'), _quoted(F.col("name")),
                    F.lit(',"parent_id":'), _quoted(F.col("parent_id")), F.lit(',"result":'), _quoted(F.col("content")), F.lit("}"))
    out = both.select(
        *CALL, "level", F.coalesce("turn", "r_turn").alias("turn"), status.alias("status"),
        F.when(is_call, errors(F.col("name"), F.col("arguments"), schemas)).otherwise(F.array().cast("array<string>")).alias("errors"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"), json.alias("json"))
    return out.orderBy("conv_id", F.col("level").asc_nulls_last(), "turn", "call_id")


def _quoted(s: Column) -> Column:
    """A string as JSON; null as null."""
    whole = F.to_json(F.struct(s.cast("string").alias("s")))
    return F.when(s.isNull(), F.lit("null")).otherwise(F.substr(whole, F.lit(6), F.length(whole) - 6))
