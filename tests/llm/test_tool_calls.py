import json

from pyspark.sql import functions as F

from busframes.llm.tool_calls import CALL_COLUMNS, RESULT_COLUMNS, chat_calls, chat_results, link_tool_calls, topological_levels

SCHEMAS = [("add", "a", "integer", True), ("add", "b", "number", True), ("add", "note", "string", False)]


def linked(spark, calls, results):
    schemas = spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean")
    return link_tool_calls(spark.createDataFrame(calls, CALL_COLUMNS), spark.createDataFrame(results, RESULT_COLUMNS), schemas)


def levels(spark, edges, nodes):
    e = spark.createDataFrame(edges, "id string, dep string")
    n = spark.createDataFrame([(x,) for x in nodes], "id string")
    return {r.id: r.level for r in topological_levels(n, e).collect()}


def longest(edges, nodes):
    deps = {n: [d for i, d in edges if i == n] for n in nodes}
    def walk(n, path):
        if n in path:
            raise RecursionError
        return max((walk(d, path | {n}) + 1 for d in deps[n]), default=0)
    out = {}
    for n in nodes:
        try:
            out[n] = walk(n, frozenset())
        except RecursionError:
            out[n] = None
    return out


def test_levels_against_recursion(spark):
    nodes = [f"n{i}" for i in range(14)]
    edges = [("n1", "n0"), ("n2", "n1"), ("n3", "n2"), ("n3", "n0"), ("n4", "n3"), ("n5", "n4"), ("n6", "n5"), ("n6", "n3"),
             ("n7", "n8"), ("n8", "n7"), ("n9", "n8"), ("n10", "n9"), ("n10", "n1"), ("n11", "n11"), ("n12", "n6")]
    assert levels(spark, edges, nodes) == longest(edges, nodes)


def test_long_chain_takes_few_rounds(spark):
    nodes = [str(i) for i in range(200)]
    edges = [(str(i), str(i - 1)) for i in range(1, 200)]
    assert levels(spark, edges, nodes) == {str(i): i for i in range(200)}


def test_validation_links_and_json(spark):
    calls = [
        (1, 0, "a", "add", '{"b": 2.5, "a": 1}', None), (1, 1, "b", "add", '{"a": "x", "c": 1}', ["a", "gone"]),
        (1, 2, "c", "nope", "{}", ["a", "b", "b"]), (1, 3, "d", "add", "not json", []), (1, 4, "e", "add", "[1]", None),
        (1, 5, None, None, None, None), (2, 0, "a", "add", '{"a": 1, "b": 1, "note": null}', None),
    ]
    results = [(1, 2, "a", "late"), (1, 1, "a", "first"), (9, 9, "zzz", "orphan"), (1, 3, None, "none")]
    got = {(r.conv_id, r.turn): r for r in linked(spark, calls, results).collect()}
    assert len(got) == len(calls)
    a, b, c, d, e, none, twin = (got[k] for k in [(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 0)])
    assert (a.level, a.status, a.result_turn, a.n_results, a.valid) == (0, "answered", 1, 2, True)
    assert a.json == '{"arguments":{"a":1,"b":2.5},"depends_on":[],"id":"a","level":0,"name":"add","result":"first","valid":true}'
    assert (b.level, b.n_unknown_deps, b.errors) == (1, 1, "missing:b,type:a,unknown:c")
    assert (c.level, c.errors, c.status) == (2, "tool:unknown", "unanswered")
    assert d.errors == e.errors == "arguments:not_an_object" and json.loads(d.json)["arguments"] == {"raw": "not json"}
    assert none.status == "unanswered" and none.level is None and not none.valid
    assert twin.status == "answered" and twin.errors == "type:note"


def test_calls_in_the_open(spark):
    held = json.dumps({"tool_calls": [{"id": "x", "name": "add", "arguments": {"b": 2, "a": 1}, "depends_on": ["w"]}, {"id": "w", "name": "add", "arguments": {}}]})
    chats = spark.createDataFrame([
        (5, 0, "user", "do"), (5, 1, "assistant", held), (5, 2, "tool", '{"tool_call_id": "x", "content": "3"}'), (5, 3, "assistant", None), (None, None, None, None),
        (6, 0, "assistant", "{broken"), (6, 0, "assistant", "{broken")], "conv_id long, turn long, role string, text string")
    calls = {r.call_id: r for r in chat_calls(chats).collect()}
    assert set(calls) == {"5:0", "5:x", "5:w"} and calls["5:x"].depends_on == ["5:w"] and calls["5:x"].arguments == '{"a":1,"b":2}'
    assert chat_results(chats).filter("call_id = '5:x'").select("content").first()[0] == "3"


def test_no_python_in_the_plan(spark):
    from busframes.llm.catalog import QUERIES
    df = QUERIES["op1_tool_call_linking"](spark, "/root/testdata/sf0.001").filter(F.lit(True))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
