"""Tool-call linking (native: DataFrame and SQL functions only).

``link_tool_calls`` hash-joins calls with results by identifier, orders the
calls topologically by what they depend on, validates arguments against the
tools' schemas and serialises each linked call as canonical JSON (object keys
sorted at every depth, no white space).

Topological levels: nodes with one dependency form chains, which are
contracted by pointer doubling (rounds grow with the logarithm of the longest
chain, not with its length); only calls with several dependencies are then
levelled by rounds over the frontier. Calls on or behind a cycle get a null
level. There is no window over a conversation and no group is gathered, so a
conversation of any size is spread like all others; a hot identifier meets
pre-aggregated results (one row per identifier).

Defined cases: repeated calls of one identifier are all linked, alike; of
several results for an identifier the least (turn, content) is linked and
``n_results`` counts them; a null identifier links with nothing; dependencies
on unknown identifiers are counted in ``n_unknown_deps`` and don't order;
arguments that are no JSON object are invalid and serialised as a string.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframes.session import checkpoint_base

CALL_COLUMNS = "conv_id bigint, turn bigint, call_id string, name string, arguments string, depends_on array<string>"
RESULT_COLUMNS = "conv_id bigint, turn bigint, call_id string, content string"
#: JSON type names by Spark's variant type names
_TYPES = {"STRING": "string", "BIGINT": "integer", "BOOLEAN": "boolean", "VOID": "null"}


def _saved(df: DataFrame) -> DataFrame:
    checkpoint_base(df.sparkSession)
    return df.checkpoint()


def _chains(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root, dist, n_deps): nodes with exactly one dependency point to
    the first node behind them that has none or several; others to themselves.
    A root with one dependency marks a cycle."""
    one = edges.groupBy("id").agg(F.count("*").alias("n_deps"), F.min("dep").alias("dep"))
    state = _saved(nodes.join(one, "id", "left").select(
        "id", F.coalesce("n_deps", F.lit(0)).alias("n_deps"),
        F.when(F.col("n_deps") == 1, F.col("dep")).otherwise(F.col("id")).alias("root"),
        F.when(F.col("n_deps") == 1, 1).otherwise(0).cast("long").alias("dist")))
    links = state.filter("n_deps = 1").count()
    for _ in range(math.ceil(math.log2(links + 1)) + 1):
        behind = state.filter("n_deps = 1").select(F.col("id").alias("root"), F.col("root").alias("_r"), F.col("dist").alias("_d"))
        new = _saved(state.join(behind, "root", "left").select(
            "id", "n_deps", F.coalesce("_r", "root").alias("root"), (F.col("dist") + F.coalesce("_d", F.lit(0))).alias("dist"),
            F.col("_r").isNotNull().alias("_moved")))
        moved = new.filter("_moved").limit(1).count()
        state = new.drop("_moved")
        if not moved:
            break
    return state


def topological_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, level) of a graph: nodes (id) distinct, edges (id, dep) distinct
    with both ends in nodes. level: longest path to a node without
    dependencies; null on or behind a cycle."""
    chain = _chains(nodes, edges)
    level = chain.filter("n_deps = 0").select("id", F.lit(0).cast("long").alias("level"))
    junctions = chain.filter("n_deps > 1").select("id")
    waiting = (edges.join(junctions, "id", "left_semi")
               .join(chain.select(F.col("id").alias("dep"), "root", "dist"), "dep").select("id", "root", "dist"))
    left = junctions.count()
    if left:
        waiting, level = _saved(waiting), _saved(level)
    while left:
        known = waiting.join(level.withColumnRenamed("id", "root"), "root", "left")
        ready = known.groupBy("id").agg(F.max(F.col("level").isNull()).alias("open"), (F.max(F.col("level") + F.col("dist")) + 1).alias("level")).filter("not open")
        ready = _saved(ready.select("id", "level"))
        got = ready.count()
        if not got:
            break
        level, waiting, left = _saved(level.unionByName(ready)), _saved(waiting.join(ready, "id", "left_anti")), left - got
    return (chain.join(level.withColumnRenamed("id", "root"), "root", "left")
            .select("id", (F.col("level") + F.col("dist")).alias("level")))


def _validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds args (variant) and errors, in the calls' own rows."""
    tools = schemas.groupBy(F.col("name").alias("_tool")).agg(
        F.sort_array(F.collect_set(F.struct("param", "type", "required"))).alias("_params"))
    rows = (calls.join(tools, F.col("name") == F.col("_tool"), "left")
            .withColumn("args", F.try_parse_json("arguments"))
            .withColumn("_kind", F.schema_of_variant("args"))
            .withColumn("_map", F.when(F.col("_kind").startswith("OBJECT"), F.expr("try_cast(args as map<string, variant>)"))))

    def kind(v):
        k = F.schema_of_variant(v)
        out = F.when(k.startswith("OBJECT"), "object").when(k.startswith("ARRAY"), "array").when(k.startswith("DECIMAL"), "number").when(k.isin("DOUBLE", "FLOAT"), "number")
        for name, json_type in _TYPES.items():
            out = out.when(k == name, json_type)
        return out.otherwise(F.lower(k))

    def fault(p):
        v = F.try_element_at(F.col("_map"), p["param"])
        fits = (kind(v) == p["type"]) | ((p["type"] == "number") & (kind(v) == "integer"))
        return (F.when(v.isNull(), F.when(p["required"], F.concat(F.lit("missing:"), p["param"])))
                .when(~fits, F.concat(F.lit("type:"), p["param"])))

    known = F.transform("_params", lambda p: p["param"])
    errors = F.array_sort(F.concat(
        F.filter(F.transform("_params", fault), lambda e: e.isNotNull()),
        F.transform(F.array_except(F.map_keys("_map"), known), lambda k: F.concat(F.lit("unknown:"), k))))
    return rows.withColumn(
        "errors", F.when(F.col("_map").isNull(), F.array(F.lit("arguments:not_an_object")))
        .when(F.col("_tool").isNull(), F.array(F.lit("tool:unknown"))).otherwise(errors)).drop("_tool", "_params", "_kind", "_map")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call: conv_id, turn, call_id, name, level, status
    (answered, unanswered), result_turn, n_results, n_unknown_deps, valid,
    errors, json. ``schemas``: (name, param, type, required)."""
    calls = calls.select(*[F.col(c).alias(c) for c in ("conv_id", "turn", "call_id", "name", "arguments", "depends_on")])
    edges = (calls.filter("call_id is not null").select(F.col("call_id").alias("id"), F.explode(F.array_distinct(F.coalesce("depends_on", F.array().cast("array<string>")))).alias("dep"))
             .filter("dep is not null").distinct())
    nodes = calls.filter("call_id is not null").select(F.col("call_id").alias("id")).distinct()
    inside = _saved(edges.join(nodes.withColumnRenamed("id", "dep"), "dep", "left_semi").select("id", "dep"))
    level = topological_levels(nodes, inside)
    unknown = edges.join(nodes.withColumnRenamed("id", "dep"), "dep", "left_anti").groupBy("id").agg(F.count("*").alias("n_unknown_deps"))
    answers = results.filter("call_id is not null").groupBy(F.col("call_id").alias("_rid")).agg(
        F.min(F.struct("turn", "content")).alias("_r"), F.count("*").alias("n_results"))
    rows = _validated(calls, schemas)
    rows = (rows.join(answers, F.col("call_id") == F.col("_rid"), "left")
            .join(level.withColumnRenamed("id", "_lid"), F.col("call_id") == F.col("_lid"), "left")
            .join(unknown.withColumnRenamed("id", "_uid"), F.col("call_id") == F.col("_uid"), "left"))
    status = F.when(F.col("_rid").isNull(), "unanswered").otherwise("answered")
    valid = F.size("errors") == 0
    args = F.coalesce("args", F.to_variant_object(F.struct(F.col("arguments").alias("raw"))))
    json = F.to_json(F.struct(
        args.alias("arguments"), F.array_sort(F.array_distinct(F.coalesce("depends_on", F.array().cast("array<string>")))).alias("depends_on"),
        F.col("call_id").alias("id"), F.col("level").alias("level"), F.col("name").alias("name"),
        F.col("_r.content").alias("result"), valid.alias("valid")))
    return rows.select("conv_id", "turn", "call_id", "name", "level", status.alias("status"), F.col("_r.turn").alias("result_turn"),
                       F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
                       F.coalesce("n_unknown_deps", F.lit(0)).cast("long").alias("n_unknown_deps"),
                       valid.alias("valid"), F.array_join("errors", ",").alias("errors"), json.alias("json"))


# ------------------------------------------------------- chats as calls

def chat_calls(chats: DataFrame) -> DataFrame:
    """Calls of a chat table (conv_id, turn, role, text).

    Texts ``{"tool_calls": [{"id", "name", "arguments", "depends_on"}]}`` of
    assistants hold calls in the open. In plain chats each user turn calls
    the tool ``reply``, and depends on the user turn two before it (its
    history). Identifiers are scoped by the conversation."""
    conv = F.concat(F.col("conv_id").cast("string"), F.lit(":"))
    plain = chats.filter("role = 'user'").select(
        "conv_id", "turn", F.concat(conv, F.col("turn").cast("string")).alias("call_id"), F.lit("reply").alias("name"),
        F.to_json(F.struct("turn", F.col("text").alias("text"), F.length("text").alias("n_chars"))).alias("arguments"),
        F.array(F.concat(conv, (F.col("turn") - 2).cast("string"))).alias("depends_on"))
    held = (chats.filter("role = 'assistant' and ltrim(text) like '{%'")
            .select("conv_id", "turn", F.explode(F.expr("try_cast(try_variant_get(try_parse_json(text), '$.tool_calls', 'variant') as array<variant>)")).alias("v")))
    get = lambda p, t: F.try_variant_get("v", p, t)
    tools = held.select(
        "conv_id", "turn", F.concat(conv, get("$.id", "string")).alias("call_id"), get("$.name", "string").alias("name"),
        F.to_json(get("$.arguments", "variant")).alias("arguments"),
        F.transform(F.expr("try_variant_get(v, '$.depends_on', 'array<string>')"), lambda d: F.concat(conv, d)).alias("depends_on"))
    return plain.unionByName(tools)


def chat_results(chats: DataFrame) -> DataFrame:
    """Results: ``{"tool_call_id", "content"}`` texts of the role tool, and in
    plain chats each assistant turn, for the call of the turn before it."""
    conv = F.concat(F.col("conv_id").cast("string"), F.lit(":"))
    plain = chats.filter("role = 'assistant'").select(
        "conv_id", "turn", F.concat(conv, (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("text").alias("content"))
    v = F.try_parse_json("text")
    tools = chats.filter("role = 'tool'").select(
        "conv_id", "turn", F.concat(conv, F.try_variant_get(v, "$.tool_call_id", "string")).alias("call_id"),
        F.try_variant_get(v, "$.content", "string").alias("content"))
    return plain.unionByName(tools)


#: the tool of plain chats
REPLY_SCHEMA = [("reply", "n_chars", "integer", True), ("reply", "text", "string", True), ("reply", "turn", "integer", True)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call of ``conversations``, linked."""
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    schemas = spark.createDataFrame(REPLY_SCHEMA, "name string, param string, type string, required boolean")
    return link_tool_calls(chat_calls(chats), chat_results(chats), schemas)


ORACLE_SQL = """
WITH RECURSIVE c AS (SELECT conv_id, turn, text, conv_id || ':' || turn AS call_id, conv_id || ':' || (turn - 2) AS dep
  FROM conversations WHERE role = 'user'),
lv AS (SELECT DISTINCT call_id, 0::BIGINT AS level FROM c WHERE dep NOT IN (SELECT call_id FROM c)
  UNION SELECT c.call_id, lv.level + 1 FROM c JOIN lv ON c.dep = lv.call_id),
r AS (SELECT conv_id || ':' || (turn - 1) AS call_id, min(turn) AS result_turn, arg_min(text, (turn, text)) AS content, count(*) AS n_results
  FROM conversations WHERE role = 'assistant' GROUP BY 1)
SELECT c.conv_id, c.turn, c.call_id, 'reply' AS name, lv.level, CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
  r.result_turn, coalesce(r.n_results, 0) AS n_results, CASE WHEN c.dep IN (SELECT call_id FROM c) THEN 0 ELSE 1 END::BIGINT AS n_unknown_deps,
  true AS valid, '' AS errors,
  '{"arguments":{"n_chars":' || length(c.text) || ',"text":' || to_json(c.text)::VARCHAR || ',"turn":' || c.turn || '},"depends_on":["' || c.dep
  || '"],"id":"' || c.call_id || '","level":' || lv.level || ',"name":"reply"'
  || CASE WHEN r.content IS NULL THEN '' ELSE ',"result":' || to_json(r.content)::VARCHAR END || ',"valid":true}' AS json
FROM c LEFT JOIN lv USING (call_id) LEFT JOIN r USING (call_id)"""
