import json

from tokenloom.llm.chat_format import canonical, levels, linked_chats, validated

CHAT = "conv_id long, turn long, role string, text string, row long, kind string"
SPEC = {
    "required": ["q"], "additionalProperties": False,
    "properties": {"q": {"type": "string", "minLength": 1, "maxLength": 5}, "n": {"type": "integer", "minimum": 0, "maximum": 9},
                   "x": {"type": "number"}, "e": {"type": "string", "enum": ["a", "b"]}, "l": {"type": "array"}, "o": {"type": "object"}, "f": {"type": "boolean"}},
}


def schemas(spark):
    return spark.createDataFrame([("find", json.dumps(SPEC)), (None, "{}"), ("any", "{}")], "name string, parameters string")


def calls(*items, content=None):
    return json.dumps({"tool_calls": list(items), "content": content})


def test_validation(spark):
    cases = [
        ('{"q":"ok"}', []), ('{"q":"ok","n":3,"x":1.5,"e":"a","l":[1],"o":{"z":1},"f":true}', []), ("{}", ["missing q"]),
        ('{"q":""}', ["length q"]), ('{"q":"toolong"}', ["length q"]), ('{"q":1}', ["type q"]), ('{"q":"a","n":10}', ["range n"]),
        ('{"q":"a","n":1.5}', ["type n"]), ('{"q":"a","e":"c","zz":1}', ["enum e", "unknown zz"]), ("[1]", ["arguments are no object"]),
        ("{bad", ["arguments are no object"]), (None, ["arguments are no object"]), ('{"q":null}', ["type q"]),
    ]
    df = spark.createDataFrame([(i, "find", a) for i, (a, _) in enumerate(cases)] + [(99, "none", "{}"), (98, "any", '{"w":1}'), (97, None, "{}")], "i int, name string, arguments string")
    got = {r.i: r.errors for r in validated(df, schemas(spark)).collect()}
    assert [got[i] for i in range(len(cases))] == [e for _, e in cases]
    assert got[99] == got[97] == ["unknown tool"] and got[98] == []


def test_levels(spark):
    rows = [(1, "a", []), (1, "b", ["a"]), (1, "c", ["a", "b"]), (1, "d", ["missing"]), (1, "e", ["f"]), (1, "f", ["e"]), (1, "g", ["e"]), (2, "a", ["b"]), (None, "x", []), (None, "y", ["x"])]
    got = {(r.conv, r.id): r.level for r in levels(spark.createDataFrame(rows, "conv long, id string, after array<string>")).collect()}
    assert got == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (None, "x"): 0, (None, "y"): 1}


def test_linking(spark):
    rows = [
        (1, 0, "system", "be kind", 0, ""),
        (1, 1, "assistant", calls({"id": "p", "name": "find", "arguments": {"x": 1, "q": "é\n"}}, {"id": "q", "name": "any", "arguments": {"b": 1, "a": [2, {"d": 1, "c": 0}]}, "after": ["p"]}, content="wait"), 0, ""),
        (1, 2, "tool", json.dumps({"tool_call_id": "q", "content": "second"}), 0, ""),
        (1, 3, "tool", json.dumps({"tool_call_id": "p", "content": "first"}), 0, ""),
        (1, 4, "tool", json.dumps({"tool_call_id": "p", "content": "again"}), 0, ""),
        (1, 5, "assistant", calls({"id": "p", "name": "any", "arguments": {}}), 0, ""),
        (1, 6, "tool", json.dumps({"tool_call_id": "nobody", "content": "x"}), 0, ""),
        (2, 0, "tool", json.dumps({"tool_call_id": "z", "content": "too early"}), 0, ""),
        (2, 1, "assistant", calls({"id": "z", "name": "any", "arguments": {}}, {"id": None, "name": "any", "arguments": {}}), 0, ""),
        (2, 2, "assistant", "{not json", 0, ""),
        (2, 3, "user", None, 0, ""),
        (None, None, None, None, 0, ""),
        (2, 3, "user", None, 0, ""),
    ]
    got = linked_chats(spark.createDataFrame(rows, CHAT).repartition(3), schemas(spark)).collect()
    key = lambda r: (r.conv_id, r.turn, r.kind, r.call_id)
    by = {key(r): r for r in got}
    assert len(got) == 16
    assert by[1, 1, "call", "q"].json == '{"arguments":{"a":[2,{"c":0,"d":1}],"b":1},"id":"q","name":"any","type":"call"}'
    assert by[1, 1, "call", "p"].json == '{"arguments":{"q":"é\\n","x":1},"id":"p","name":"find","type":"call"}'
    assert (by[1, 1, "call", "p"].level, by[1, 1, "call", "q"].level) == (0, 1)
    assert by[1, 1, "call", "p"].linked and by[1, 3, "result", "p"].linked and not by[1, 4, "result", "p"].linked
    assert by[1, 5, "repeated", "p"].level == -1 and not by[1, 6, "result", "nobody"].linked
    assert not by[2, 0, "result", "z"].linked and not by[2, 1, "call", "z"].linked
    assert by[1, 1, "message", None].json == '{"content":"wait","role":"assistant","type":"message"}'
    assert by[2, 2, "message", None].json == '{"content":"{not json","role":"assistant","type":"message"}'
    assert by[2, 3, "message", None].json == '{"role":"user","type":"message"}'
    assert linked_chats(spark.createDataFrame([], CHAT), schemas(spark)).collect() == []


NESTED = {
    "type": "object", "required": ["o"], "oneOf": [],
    "properties": {
        "o": {"type": "object", "required": ["id"], "additionalProperties": False,
              "properties": {"id": {"type": ["integer", "null"]}, "code": {"type": "string", "pattern": "^[A-Z]{2}$"}, "deep": {"type": "object", "properties": {"x": {"type": "number", "exclusiveMinimum": 0}}}}},
        "l": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "maximum": 5}}}},
    },
}


def test_nested_validation(spark):
    free = ["unchecked oneOf"]
    cases = [
        ('{"o":{"id":1.0}}', []), ('{"o":{"id":1e2}}', []), ('{"o":{"id":null,"code":"AB","deep":{"x":0.5}},"l":[{"k":5}]}', []),
        ('{"o":{"id":1.5}}', ["type o.id"]), ('{"o":{}}', ["missing o.id"]), ('{"o":{"id":1,"code":"ab","z":1,"deep":{"x":0}}}', ["pattern o.code", "range o.deep.x", "unknown o.z"]),
        ('{"o":{"id":1},"l":[]}', ["length l"]), ('{"o":{"id":1},"l":[{"k":6},{},{"k":"x"},7]}', ["missing l[1].k", "range l[0].k", "type l[2].k", "type l[3]"]),
        ('{"o":[]}', ["type o"]), ("{}", ["missing o"]),
    ]
    df = spark.createDataFrame([(i, "n", a) for i, (a, _) in enumerate(cases)], "i int, name string, arguments string")
    got = {r.i: r.errors for r in validated(df, spark.createDataFrame([("n", json.dumps(NESTED))], "name string, parameters string")).collect()}
    assert [got[i] for i in range(len(cases))] == [sorted(e + free) for _, e in cases]


def test_equal_numbers_have_one_form(spark):
    texts = ['{"a":1e2}', '{"a":100}', '{"a":100.0}', '{"a":1.0E+2}', '{"a":15e-8,"b":"1e2, \\" 1e2, \\\\"}', '{"a":0.00000015,"b":"1e2, \\" 1e2, \\\\"}', '[true,1E1,false,null]', '{"a":1e400}', "no 1e2 json", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in df.select("i", canonical(df["t"]).alias("c")).orderBy("i").collect()]
    assert set(got[:4]) == {'{"a":100}'} and got[4] == got[5] == '{"a":0.00000015,"b":"1e2, \\" 1e2, \\\\"}'
    assert got[6] == "[true,10,false,null]" and got[8] is got[9] is None


def test_long_chains_take_few_rounds(spark, monkeypatch):
    from tokenloom.llm import chat_format

    rounds = []
    plain = chat_format.written
    monkeypatch.setattr(chat_format, "written", lambda df, name, *a, **k: (rounds.append(name), plain(df, name, *a, **k))[1])
    rows = [(1, str(i), [str(i - 1)] if i else []) for i in range(1000)] + [(1, "top", ["999", "500"]), (1, "after", ["top"])]
    rows += [(2, "a", ["b"]), (2, "b", ["a"]), (2, "c", ["b"]), (2, "d", ["c", "x"]), (2, "x", [])]
    got = {(r.conv, r.id): r.level for r in levels(spark.createDataFrame(rows, "conv long, id string, after array<string>")).collect()}
    assert got == {**{(1, str(i)): i for i in range(1000)}, (1, "top"): 1000, (1, "after"): 1001, (2, "x"): 0}
    assert rounds.count("call_leads") + rounds.count("call_front") < 15
