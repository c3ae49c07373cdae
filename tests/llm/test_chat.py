import json
from collections import Counter

import pytest

from tessera.llm import chat
from tessera.llm.queries import TOOLS, op7_tool_calls

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, parent_id string, level int, json string"
RESULTS = "conv_id long, call_id string, turn long, content string, status string"


def link(spark, calls, results):
    calls = spark.createDataFrame([(*c, 0, "x") for c in calls], CALLS)
    results = spark.createDataFrame([(*r, "x") for r in results], RESULTS)
    return chat.link_tool_calls(calls, results, TOOLS).collect()


def test_linking(spark):
    calls = [
        (1, "a", 1, "search", '{"query": "q \\u00e9\\n", "limit": 3}', None),
        (1, "b", 2, "lookup", '{"strict":true,"id":1}', "a"),
        (1, "b", 5, "lookup", '{"id":9}', None),
        (1, "c", 0, "lookup", '{"id":"1","more":{"z":1,"a":[2,{"y":0,"b":1}]}}', "b"),
        (1, "d", 3, "nothing", "{}", "gone"),
        (1, "e", 4, "search", "not json", "f"),
        (1, "f", 4, "search", None, "e"),
        (1, "g", 6, "search", "[1]", "f"),
        (2, "a", 1, None, '{"query":"x","limit":1.5}', "b"),
        (None, "a", 1, "search", "{}", None), (1, None, 1, "search", "{}", None),
    ]
    results = [(1, "a", 2, 'say "hi"\n'), (1, "a", 3, "late"), (1, "b", 7, None), (1, "zz", 8, "orphan"), (None, "a", 1, "x"), (2, None, 1, "x")]
    rows = link(spark, calls, results)
    got = {(r.conv_id, r.call_id): r for r in rows}
    assert len(rows) == len(got) == 9
    assert [got[1, c].level for c in "abcdefg"] == [0, 1, 2, 0, None, None, None]
    assert [got[1, c].status for c in "abcdeg"] == ["linked", "linked", "no_result", "no_result", "cycle", "cycle"]
    assert got[1, "zz"].status == "no_call" and got[1, "zz"].errors == []
    assert (got[1, "a"].n_results, got[1, "b"].n_calls, got[1, "b"].turn) == (2, 2, 2)
    assert got[1, "a"].errors == [] and got[1, "b"].errors == []
    assert got[1, "c"].errors == ["type:id", "unknown:more"]
    assert got[1, "d"].errors == ["unknown_tool"] == got[2, "a"].errors
    assert got[1, "e"].errors == got[1, "f"].errors == got[1, "g"].errors == ["not_json"]
    assert got[1, "a"].json == '{"arguments":{"limit":3,"query":"q é\\n"},"call_id":"a","name":"search","parent_id":null,"result":"say \\"hi\\"\\n"}'
    assert got[1, "c"].json.startswith('{"arguments":{"id":"1","more":{"a":[2,{"b":1,"y":0}],"z":1}},"call_id":"c"')
    assert [r.call_id for r in rows if r.conv_id == 1 and r.level is not None] == ["d", "a", "b", "c"][0:0] + [c for c in ("a", "d", "b", "c")]
    for r in rows:
        parsed = json.loads(r.json)
        if isinstance(parsed["arguments"], dict):
            assert r.json == json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_long_chain(spark):
    calls = [(1, f"c{i}", i, "lookup", '{"id":1}', f"c{i - 1}") for i in range(300)]
    rows = link(spark, calls, [])
    assert [(r.call_id, r.level) for r in rows] == [(f"c{i}", i) for i in range(300)]


@pytest.mark.parametrize("arguments, want", [
    ('{"query":"a","limit":1}', []), ('{"query":1,"limit":1}', ["type:query"]), ('{"query":"a","limit":1.5}', ["type:limit"]), ("{}", ["missing:limit", "missing:query"]),
    ('{"query":"a","limit":null}', ["type:limit"]), ('{"query":"a","limit":1,"x":0,"y":0}', ["unknown:x", "unknown:y"]), ('{"query":"a"', ["not_json"]), ("7", ["not_json"]),
    ('{"query":"a","query":"b","limit":1}', ["not_json"]), ("", ["not_json"]),
])
def test_validation(spark, arguments, want):
    assert link(spark, [(1, "a", 1, "search", arguments, None)], [])[0].errors == want


def test_query_against_brute_force(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    rows = op7_tool_calls(spark, sf_dir).collect()
    user = Counter((r.conv_id, f"c{r.turn}") for r in turns if r.role == "user")
    answers = Counter((r.conv_id, f"c{r.turn - 1}") for r in turns if r.role == "assistant")
    assert {(r.conv_id, r.call_id) for r in rows} == set(user) | set(answers) and len(rows) == len(set(user) | set(answers))
    parent = {(r.conv_id, f"c{r.turn}"): (r.conv_id, f"c{r.turn - 2}") for r in turns if r.role == "user" and len(r.text) % 4 < 3}

    def level(x):
        return 1 + level(parent[x]) if parent.get(x) in user else 0

    for r in rows:
        key = (r.conv_id, r.call_id)
        assert (r.n_calls, r.n_results) == (user[key], answers[key])
        if key in user:
            assert r.level == level(key)
            assert r.status == ("linked" if key in answers else "no_result")
    place = {(r.conv_id, r.call_id): i for i, r in enumerate(rows)}
    assert all(place[p] < place[c] for c, p in parent.items() if p in user)


def test_empty(spark):
    assert link(spark, [], []) == []
    assert [r.status for r in link(spark, [], [(1, "a", 1, "x")])] == ["no_call"]


def test_query_keeps_whole_texts(spark, tmp_path):
    """Quotes, newlines and escapes far behind the beginning reach the canonical JSON of the call."""
    import duckdb
    import json

    from tessera.llm import queries

    long = 'word ' * 30 + 'he said "no"\n\tC:\\dir é   </end>'
    turns = []
    for conv, pad in enumerate(range(25)):
        turns += [(conv, 0, "user", long + "x" * pad), (conv, 1, "assistant", "ok " * 20 + f'"{pad}"'), (conv, 2, "user", "short" * pad)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op7_tool_calls(spark, str(tmp_path)).collect()
    said = {(c, f"c{t}"): text for c, t, role, text in turns if role == "user"}
    seen = 0
    for r in got:
        call, text = json.loads(r["json"]), said[r["conv_id"], r["call_id"]]
        n = len(text)
        if n % 7 == 0:
            assert call["arguments"] == text
            seen += 1
        elif n % 3 == 0:
            assert call["arguments"]["query"] == text
            seen += 1
    assert seen >= 8 and len(got) == len(said)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.sql(queries.ORACLE["op7_tool_calls"])
    at = want.columns.index("json")
    assert sorted(r[at] for r in want.fetchall()) == sorted(r["json"] for r in got)
