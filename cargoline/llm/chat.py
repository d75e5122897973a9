"""Tool-call linking, with DataFrame and SQL functions only.

Calls and results meet in a shuffled hash join by conversation and call
identifier; calls are ordered by the longest way back along their ``after``
references.  Stretches where each call waits for one other are followed by pointer doubling (a
chain of n calls takes log2 n joins), calls that wait for several are then settled
one behind the other;
arguments are parsed as JSON variants, checked against the tools' schemas and
serialised with sorted keys and no spaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cargoline.llm.common import land, table

CALL = ["conv_id", "call_id"]


def first_by_id(rows: DataFrame) -> DataFrame:
    """One row per identifier, the least by all its other columns; ``copies`` counts them.

    Aggregated before the shuffle, so an identifier with very many rows is no hot spot.
    """
    rest = [c for c in rows.columns if c not in CALL]
    found = rows.groupBy(*CALL).agg(F.min(F.struct(*rest)).alias("r"), F.count("*").alias("copies"))
    return found.select(*CALL, *[F.col(f"r.{c}").alias(c) for c in rest], "copies")


def predecessors(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, up)``: each call with the calls of its conversation that ``after`` names, text or array of texts."""
    named = F.explode("after") if isinstance(calls.schema["after"].dataType, ArrayType) else F.col("after")
    return calls.select(*CALL, named.alias("up")).distinct().join(calls.select("conv_id", F.col("call_id").alias("up")), ["conv_id", "up"])


def depths(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, depth)``: number of calls on the longest way to this one along ``after``.

    A reference to no call of the conversation counts for nothing.  Calls on a
    cycle, or behind one, get depth null.  Rounds: the logarithm of the longest stretch in which
    each call waits for one other, within one conversation, and then as many as calls
    that wait for several stand one behind the other.
    """
    edges = land(predecessors(calls), "call-edges")
    waits = edges.groupBy(*CALL).agg(F.count("*").alias("n"), F.max("up").alias("up"))
    one = F.coalesce(F.col("n") == 1, F.lit(False))
    # `top` is a call further back, `hops` away; a way ends at a call that waits for none or for several.
    state = land(calls.select(*CALL).join(waits, CALL, "left").select(
        *CALL, "n", F.when(one, F.col("up")).otherwise(F.col("call_id")).alias("top"), one.cast("long").alias("hops"), (~one).alias("ended")
    ), "call-chains")
    limit = calls.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    fields = [*CALL, "top", "hops", "ended"]
    ends, moving, reach = state.where("ended").select(*fields), state.where("NOT ended").select(*fields), 1
    while reach <= limit and not moving.isEmpty():
        ahead = ends.union(moving).select("conv_id", F.col("call_id").alias("top"), F.col("top").alias("_top"), F.col("hops").alias("_hops"), F.col("ended").alias("_ended"))
        moved = land(moving.join(ahead, ["conv_id", "top"]).select(
            *CALL, F.col("_top").alias("top"), (F.col("hops") + F.col("_hops")).alias("hops"), F.col("_ended").alias("ended")
        ), "call-chains")
        ends, moving, reach = ends.union(moved.where("ended")), moved.where("NOT ended"), 2 * reach
    settled = state.where("n IS NULL").select("conv_id", F.col("call_id").alias("top"), F.lit(0).cast("long").alias("base"))
    way = ends.select("conv_id", F.col("call_id").alias("up"), "top", (F.col("hops") + 1).alias("hops"))
    waiting = edges.join(state.where("n > 1").select(*CALL), CALL, "left_semi").join(way, ["conv_id", "up"], "left").join(settled, ["conv_id", "top"], "left")
    waiting = land(waiting.select(*CALL, "top", "hops", "base"), "call-waits")
    while True:
        known = waiting.groupBy(*CALL).agg(F.max(F.col("hops") + F.col("base")).alias("base"), F.count_if(F.col("base").isNull()).alias("_open"))
        new = land(known.where("_open = 0").select("conv_id", F.col("call_id").alias("top"), "base"), "call-depths")
        if new.isEmpty():
            break
        settled = settled.union(new)
        rest = waiting.join(new.select("conv_id", F.col("top").alias("call_id")), CALL, "left_anti")
        more = new.withColumnRenamed("base", "_base")
        waiting = land(rest.join(more, ["conv_id", "top"], "left").select(*CALL, "top", "hops", F.coalesce("base", "_base").alias("base")), "call-waits")
    found = ends.join(settled, ["conv_id", "top"]).select(*CALL, (F.col("hops") + F.col("base")).alias("depth"))
    return calls.select(*CALL).join(found, CALL, "left")


def problems(args: Column, schema: list[tuple[str, str, bool]]) -> Column:
    """Messages on the variant ``args`` against ``(field, type, required)`` rows.

    Types are the variant type names of JSON values: BIGINT, STRING, BOOLEAN, ...
    """
    kind = F.schema_of_variant(args)
    out = [F.when(~F.coalesce(kind, F.lit("VOID")).startswith("OBJECT"), F.lit("not an object"))]
    for field, wanted, required in schema:
        value = F.try_variant_get(args, f"$.{field}", "variant")
        missing = F.lit(f"{field}: missing") if required else F.lit(None).cast("string")
        out.append(F.when(value.isNull(), missing).when(F.schema_of_variant(value) != wanted, F.lit(f"{field}: not {wanted}")))
    return F.array_compact(F.array(*out))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, list[tuple[str, str, bool]]]) -> DataFrame:
    """One row per call identifier and per orphan result.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), after (the
    call it waits for, or an array of them).
    ``results``: conv_id, call_id, turn, content.  ``schemas``: tool name to
    ``(field, type, required)``.

    Returns ``conv_id, call_id, turn, depth, name, status, errors, message``.
    ``depth``, then ``turn``, then ``call_id`` is the topological order.  ``status``:
    ``linked``, ``no_result``, ``orphan_result``, ``early_result`` (at or before its
    call) or ``cycle``.  ``errors`` lists what the arguments violate (``unknown tool``,
    ``not json``, ...); ``message`` is canonical JSON of the call and its result.  Of
    rows that share an identifier the least stays and ``errors`` says ``repeated``.
    Rows with a null identifier are dropped from linking: a call without one counts as
    ``no_result`` and a result without one as ``orphan_result``, folded likewise.  Other
    columns are ignored; empty tables give no rows.
    """
    calls = land(first_by_id(calls.select(*CALL, "turn", "name", "arguments", "after")), "calls")
    results = first_by_id(results.select(*CALL, "turn", "content"))
    answered = results.select(
        *CALL, F.col("turn").alias("_turn"), F.col("content").alias("_content"), (F.col("copies") > 1).alias("_again"), F.lit(True).alias("_result")
    )
    rows = calls.join(depths(calls.where("call_id IS NOT NULL AND conv_id IS NOT NULL")), CALL, "left").withColumn("_call", F.lit(True))
    rows = rows.join(answered.hint("shuffle_hash"), CALL, "full")
    args = F.try_parse_json("arguments")
    checks = F.lit(None).cast("array<string>")
    for name, schema in sorted(schemas.items()):
        checks = F.when(F.col("name") == name, problems(F.col("args"), schema)).otherwise(checks)
    rows = rows.withColumn("args", args)
    errors = F.when(F.col("_call").isNull(), F.array().cast("array<string>")).otherwise(
        F.array_compact(F.concat(
            F.when(F.col("args").isNull(), F.array(F.lit("not json"))).otherwise(F.coalesce(checks, F.array(F.lit("unknown tool")))),
            F.array(F.when((F.col("copies") > 1) | F.coalesce("_again", F.lit(False)), F.lit("repeated"))),
        ))
    )
    status = (
        F.when(F.col("_call").isNull(), "orphan_result").when(F.col("_result").isNull(), "no_result")
        .when(F.col("_turn") <= F.col("turn"), "early_result").when(F.col("depth").isNull(), "cycle").otherwise("linked")
    )
    message = F.parse_json(F.to_json(F.struct(
        F.col("call_id").alias("id"), F.col("name"), F.col("_content").alias("result"),
        F.when(F.col("args").isNull(), F.col("arguments")).alias("raw_arguments"), F.col("args").alias("arguments"),
    )))
    return rows.select(
        *CALL, F.coalesce("turn", "_turn").alias("turn"), "depth", "name", status.alias("status"), errors.alias("errors"), F.to_json(message).alias("message")
    )


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
    """Calls and results read out of plain conversations.

    Each assistant turn is the result of the turn before it, each other turn calls a
    tool named after its role; only user and system are known tools, a null role
    names none.  A call comes after the call two turns earlier.  Arguments hold the turn, the text and its length; where the length
    is a multiple of seven it is given as text, so that checking has work to do.
    """
    ident = lambda turn: F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))
    size = F.char_length(F.coalesce("text", F.lit("")))
    length = F.when(size % 7 == 0, F.concat(F.lit('"'), size.cast("string"), F.lit('"'))).otherwise(size.cast("string"))
    quoted = F.get(F.regexp_extract_all(F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t"))), F.lit(r'(?s)^\{"t":(.*)\}$'), F.lit(1)), F.lit(0))
    arguments = F.concat(F.lit('{"turn": '), F.col("turn").cast("string"), F.lit(', "text": '), quoted, F.lit(', "length": '), length, F.lit("}"))
    asked = turns.where(~F.col("role").eqNullSafe(F.lit("assistant")))
    calls = asked.select(
        "conv_id", ident(F.col("turn")).alias("call_id"), "turn", F.col("role").alias("name"), arguments.alias("arguments"), ident(F.col("turn") - 2).alias("after")
    )
    results = turns.where(F.col("role") == "assistant").select("conv_id", ident(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    fields = [("turn", "BIGINT", True), ("text", "STRING", True), ("length", "BIGINT", True), ("tag", "STRING", False)]
    return calls, results, {"user": fields, "system": fields}


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool-call linking over all of ``conversations``."""
    found = link_calls(*conversation_calls(table(spark, sf_dir, "conversations")))
    return found.withColumn("errors", F.array_join("errors", "; "))


OP1_SQL = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, role AS name, coalesce(text, '') AS text, count(*) AS copies
  FROM (SELECT conv_id, turn, min(role) AS role, min(text) AS text FROM conversations WHERE role IS DISTINCT FROM 'assistant' GROUP BY conv_id, turn)
  GROUP BY ALL),
results AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn),
chain AS (
  SELECT conv_id, turn, 0 AS depth FROM calls c WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, chain.depth + 1 FROM chain JOIN calls c ON c.conv_id = chain.conv_id AND c.turn = chain.turn + 2),
joined AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, 'call-' || coalesce(c.conv_id, r.conv_id) || '-' || coalesce(c.turn, r.turn) AS call_id,
    coalesce(c.turn, r.turn + 1) AS turn, CAST(chain.depth AS BIGINT) AS depth, c.name,
    CASE WHEN c.conv_id IS NULL THEN 'orphan_result' WHEN r.conv_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    CASE WHEN c.conv_id IS NOT NULL AND (c.name IS NULL OR c.name NOT IN ('user', 'system')) THEN 'unknown tool'
      WHEN c.conv_id IS NOT NULL AND length(c.text) % 7 = 0 THEN 'length: not BIGINT' ELSE '' END AS errors, c.text, r.content, c.turn AS call_turn
  FROM calls c LEFT JOIN chain USING (conv_id, turn) FULL JOIN results r ON r.conv_id = c.conv_id AND r.turn = c.turn)
SELECT conv_id, call_id, turn, depth, name, status, errors, '{' || concat_ws(',',
    CASE WHEN call_turn IS NOT NULL THEN '"arguments":{"length":' || CASE WHEN length(text) % 7 = 0 THEN '"' || length(text) || '"' ELSE CAST(length(text) AS VARCHAR) END
      || ',"text":' || to_json(text) || ',"turn":' || call_turn || '}' END,
    '"id":' || to_json(call_id), CASE WHEN name IS NOT NULL THEN '"name":' || to_json(name) END,
    CASE WHEN content IS NOT NULL THEN '"result":' || to_json(content) END) || '}' AS message
FROM joined
"""
