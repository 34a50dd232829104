"""Tool calls: linking, order, checks and JSON, with repeated, missing and circular ones."""

import json

import duckdb

from tessera.llm.chat import OP6_SQL, link_calls, op6_tool_calls, tool_tables

CALLS = "call_id string, name string, arguments string, after string, DEPTH int, status int"
RESULTS = "call_id string, content string, n_calls int"
SCHEMAS = "name string, parameter string, type string, required boolean"
TOOLS = [("get", "city", "string", True), ("get", "days", "integer", False), ("get", "at", "number", False), ("get", "flag", "boolean", False), ("get", "of", "object", False), ("get", "all", "array", False)]


def linked(spark, calls, results, tools=TOOLS):
    frame = link_calls(
        spark.createDataFrame([(*c, 1, 2) for c in calls], CALLS), spark.createDataFrame([(*r, 1) for r in results], RESULTS), spark.createDataFrame(tools, SCHEMAS)
    )
    return {(r.call_id, r.status): r for r in frame.collect()}


def test_links_and_checks(spark):
    good = '{ "days": 3, "city":"Bône \\"x\\"", "at": 1.5, "flag": true, "of": {"b": 1, "a": [2]}, "all": [1, "x"]}'
    calls = [
        ("a", "get", good, None),
        ("b", "get", '{"days": "3"}', "a"),
        ("c", "get", '{"city": "x", "more": 1, "days": 2.5}', "b"),
        ("d", "none", "{}", "missing"),
        ("e", "get", "[1]", "c"),
        ("f", "get", "{broken", None),
        ("g", "get", None, "a"),
        (None, "get", '{"city": "y"}', None),
    ]
    found = linked(spark, calls, [("a", "sunny\n"), ("c", None), ("z", "no call"), (None, "stray")])
    assert len(found) == 10
    a = found["a", "linked"]
    assert a.valid and a.errors == [] and a.depth == 0
    assert a.json == '{"arguments":{"all":[1,"x"],"at":1.5,"city":"Bône \\"x\\"","days":3,"flag":true,"of":{"a":[2],"b":1}},"call_id":"a","depth":0,"name":"get","result":"sunny\\n"}'
    assert found["b", "no_result"].errors == ["missing city", "type days"] and found["b", "no_result"].depth == 1
    assert found["c", "linked"].errors == ["type days", "unknown more"] and found["c", "linked"].depth == 2
    assert found["d", "no_result"].errors == ["no such tool"] and found["d", "no_result"].depth == 0
    assert found["e", "no_result"].errors == ["not an object"] and found["e", "no_result"].depth == 3
    assert found["f", "no_result"].errors == ["not an object"] and json.loads(found["f", "no_result"].json)["arguments"] is None
    assert not found["g", "no_result"].valid
    z = found["z", "no_call"]
    assert z.name is None and z.valid is None and z.json == '{"arguments":null,"call_id":"z","depth":null,"name":null,"result":"no call"}'
    assert found[None, "no_result"].valid and found[None, "no_call"].n_results == 1


def test_repeats_are_counted_not_multiplied(spark):
    calls = [("h", "get", '{"city":"x"}', None)] * 300 + [("h", "get", '{"city":"w"}', None)]
    found = linked(spark, calls, [("h", f"r{i}") for i in range(400)])
    row = found["h", "linked"]
    assert (row.n_calls, row.n_results, len(found)) == (301, 400, 1)
    assert json.loads(row.json) == {"arguments": {"city": "w"}, "call_id": "h", "depth": 0, "name": "get", "result": "r0"}


def test_long_chains_and_circles(spark):
    chain = [(f"n{i}", "get", '{"city":"x"}', f"n{i - 1}" if i else None) for i in range(100)]
    circle = [("x", "get", "{}", "y"), ("y", "get", "{}", "z"), ("z", "get", "{}", "x"), ("behind", "get", "{}", "x"), ("self", "get", "{}", "self")]
    found = {k[0]: r.depth for k, r in linked(spark, chain + circle, []).items()}
    assert all(found[f"n{i}"] == i for i in range(100))
    assert all(found[k] is None for k in ("x", "y", "z", "behind", "self"))


def test_empty_tables(spark):
    assert linked(spark, [], [], []) == {}
    assert len(linked(spark, [("a", "get", "{}", None)], [], [])) == 1


def test_turns_with_nulls(spark):
    rows = [(1, 0, "system", None), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"), (1, 3, "user", None), (None, 0, "user", "a b"), (2, None, "user", "q"), (3, 0, "assistant", "x"), (4, 0, None, "x"), (4, 1, "tool", "x")]
    calls, results, others = tool_tables(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert {r.call_id: r.after for r in calls.collect()} == {"call_1_0": None, "call_1_1": "call_1_-1", "call_1_3": "call_1_1", "call_null_0": "call_null_-2", "call_2_null": None}
    assert {r.call_id for r in results.collect()} == {"call_1_1", "call_3_-1"}
    assert {r.call_id for r in others.collect()} == {"turn_4_0", "turn_4_1"}


def test_turns_that_break_the_schema(spark, tmp_path):
    texts = {0: "First. Then\nmore", 2: "One line", 4: "Ends here.", 6: "What? Yes. Really", 8: None, 10: ". x\ny", 12: "", 14: "a\nb. c?"}
    rows = [(1, turn, "user", text) for turn, text in texts.items()] + [(1, 1, "system", "s"), (1, 3, "system", None), (2, 0, "tool", "x"), (2, 1, None, "x"), (None, None, "user", "T. x\ny")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.call_id: r for r in op6_tool_calls(spark, str(tmp_path)).collect()}
    errors = {turn: found[f"call_1_{turn}"].errors for turn in texts}
    assert errors == {
        0: "", 2: "missing title,type lines", 4: "missing title,type lines", 6: "type lines,unknown question", 8: "missing text,missing title",
        10: "", 12: "missing title,type lines", 14: "unknown question",
    }
    assert found["call_1_1"].valid and found["call_1_3"].errors == "missing text" and found["call_null_null"].errors == "missing turn"
    assert found["turn_2_0"].status == found["turn_2_1"].status == "other_role" and found["turn_2_0"].valid is None
    assert json.loads(found["call_1_0"].json)["arguments"] == {"lines": 2, "text": "First. Then\nmore", "title": "First", "turn": 0, "words": 3}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    names = list(found["call_1_0"].asDict())
    theirs = con.execute(f"SELECT {', '.join(names)} FROM ({OP6_SQL})").fetchall()
    assert sorted(map(repr, theirs)) == sorted(repr(tuple(r)) for r in found.values())
