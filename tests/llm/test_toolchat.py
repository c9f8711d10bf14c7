import json

import duckdb
import pytest

from medledger.llm import queries, toolchat


def call(i, name, **arguments):
    return {"id": i, "name": name, "arguments": arguments}


@pytest.fixture(scope="module")
def found(spark):
    say = lambda *calls, content="hm": json.dumps({"tool_calls": list(calls), "content": content})
    tell = lambda i, content: json.dumps({"tool_call_id": i, "content": content})
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", say(call("b", "search", text="x", limit=2), call("a", "search", text="$result:c", limit=1))),
        (1, 2, "tool", tell("b", {"z": 1, "a": [1.0, None]})), (1, 3, "assistant", say(call("c", "search", text="é\n\"", limit=1.5))),
        (1, 4, "tool", tell("c", "first")), (1, 5, "tool", tell("c", "second")), (1, 6, "tool", tell("nobody", 1)),
        (2, 0, "assistant", say(call("p", "search", text="$result:q", limit=1))), (2, 1, "assistant", say(call("q", "search", text="$result:p", limit=1))),
        (3, 0, "assistant", say(call("c", "count", limit="many", extra=1))), (3, 1, "assistant", say(call("d", "nosuch"), {"id": "e", "name": "search", "arguments": [1]})),
        (4, 0, "assistant", "{broken"), (4, 1, None, None), (4, 2, "user", '{"tool_calls": []}'), (4, 2, "user", '{"tool_calls": []}'),
        (None, 0, "assistant", say(call("n", "search", text="t", limit=1))), (None, 1, "tool", tell("n", "lost")), (5, 0, "assistant", ""),
    ]
    names = "conv_id long, turn long, role string, text string, call_id string, tool string, spec int, result string, v int"
    table = spark.createDataFrame([(*r, "x", "y", 1, "z", 2) for r in rows], names)
    return toolchat.linked_chats(table, spark.sql(queries.TOOLS)).collect()


def of(found, conv, status=None):
    rows = [r for r in found if r.conv_id == conv and (status is None or r.status == status)]
    return sorted(rows, key=lambda r: (r.order_turn, r.order_step, r.turn, r.part))


def test_calls_meet_results_and_stand_in_order(found):
    calls = [json.loads(r.message) for r in of(found, 1) if r.status in ("linked", "open")]
    assert [c["id"] for c in calls] == ["b", "c", "a"]  # a refers to c, which comes later
    assert [c["result"] for c in calls] == [{"z": 1, "a": [1, None]}, "first", None]
    assert [r.status for r in of(found, 1) if r.part] == ["linked", "linked", "open"]
    assert [json.loads(r.message)["id"] for r in of(found, 1, "orphan")] == ["nobody"]


def test_json_is_canonical(found):
    for r in found:
        told = json.loads(r.message)
        assert list(told) == sorted(told) and ": " not in r.message.replace("é", "")[:12]
    b = next(r.message for r in of(found, 1, "linked"))
    assert b == '{"arguments":{"limit":2,"text":"x"},"errors":[],"id":"b","name":"search","result":{"a":[1,null],"z":1}}'


def test_cycles_are_told(found):
    assert [r.status for r in of(found, 2) if r.part] == ["cycle", "cycle"]


def test_arguments_are_checked(found):
    errors = {json.loads(r.message)["id"]: json.loads(r.message)["errors"] for r in of(found, 3) if r.part}
    assert errors == {"c": ["not integer limit", "unknown extra"], "d": ["unknown tool"], "e": ["arguments are no object"]}


def test_odd_rows_are_shown(found):
    assert [json.loads(r.message) for r in of(found, 4)] == [
        {"content": "{broken", "role": "assistant"}, {"content": None, "role": None},
        {"content": '{"tool_calls": []}', "role": "user"}, {"content": '{"tool_calls": []}', "role": "user"},
    ]
    assert sorted(r.status for r in found if r.conv_id is None) == ["message", "open", "orphan"]
    assert of(found, 5)[0].message == '{"content":"","role":"assistant"}'


def test_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert toolchat.linked_chats(none, spark.sql(queries.TOOLS)).collect() == []


def test_no_python_in_the_plan(spark):
    df = queries.op7_tool_call_linking(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_query_against_duckdb(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    con.execute(queries.ORACLE_SQL["op7_tool_call_linking"])
    names = [d[0] for d in con.description]
    want = sorted(map(str, con.fetchall()))
    got = sorted(str(tuple(r[n] for n in names)) for r in queries.op7_tool_call_linking(spark, sf).collect())
    assert got == want


def test_every_result_is_shown(spark):
    tell = lambda i, **more: json.dumps({"tool_call_id": i, **more})
    rows = [
        (1, 0, "assistant", json.dumps({"tool_calls": [call("c", "search", text="x", limit=1), call("e", "search", text="x", limit=1)]})),
        (1, 1, "tool", tell("c", content="first")), (1, 2, "tool", tell("c", content="second")), (1, 3, "tool", tell("c")),
        (1, 1, "tool", tell("c", content="first")), (1, 4, "tool", tell("e")), (1, None, "tool", tell("e", content=[1])),
        (1, 5, "tool", tell("e", content=None)), (1, 6, "tool", tell("nobody", content=2)), (1, 6, "tool", tell("nobody", content=2)),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = toolchat.linked_chats(table, spark.sql(queries.TOOLS)).collect()
    shown = sorted((r.status, r.turn or 0, json.loads(r.message)["id"], json.loads(r.message).get("content")) for r in found if not r.part and r.status == "repeat" and r.turn != 4)
    assert shown[:3] == [("repeat", 1, "c", "first"), ("repeat", 2, "c", "second"), ("repeat", 3, "c", None)]
    assert sorted(r.status for r in found) == ["linked"] * 2 + ["message"] + ["orphan"] * 2 + ["repeat"] * 5
    # of a chat with a result that has no content alone, the call is linked
    alone = spark.createDataFrame([(1, 0, "assistant", rows[0][3]), (1, 4, "tool", tell("e"))], table.schema)
    linked = [json.loads(r.message) for r in toolchat.linked_chats(alone, spark.sql(queries.TOOLS)).collect() if r.status == "linked"]
    assert [(c["id"], c["result"]) for c in linked] == [("e", None)]
