"""Schemas compiled to columns, and the catalogue's cleaning pass."""

import json

import pytest
from pyspark.sql import functions as F

from tessella.functions import compiled as cp
from tessella.functions import schema as sc
from tessella.operators import catalogue

SCHEMA = {
    "definitions": {"text": {"type": "string"}, "line": {"$ref": "#/definitions/text"}, "loop": {"$ref": "#/definitions/pool"}, "pool": {"$ref": "#/definitions/loop"}, "tone": {"type": "string", "enum": ["red", "blue"]}, "shade": {"$ref": "#/definitions/tone"}},
    "type": "object",
    "properties": {
        "t": {"$ref": "#/definitions/line"}, "list": {"type": "array", "items": {"$ref": "#/definitions/text"}}, "in": {"type": "object", "properties": {"n": {"type": "number"}, "c": {"$ref": "#/definitions/shade"}}},
        "l": {"$ref": "#/definitions/loop"}, "gone": {"$ref": "#/definitions/none"}, "items": {"type": "array", "items": {"type": "object", "properties": {"c": {"$ref": "#/definitions/tone"}, "o": {"type": "boolean"}}}},
    },
}


def ask(spark, column, *docs):
    df = spark.createDataFrame([(i, d if d is None or isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)], "i int, j string")
    out = [r["o"] for r in df.select("i", column.alias("o")).orderBy("i").collect()]
    return out[0] if len(docs) == 1 else out


def test_visits_and_steps(spark):
    doc = {"extra": 0, "gone": "y", "list": ["b", "c"], "t": "a", "in": {"n": 1}, "l": "x"}
    value = cp.parsed(F.col("j"), SCHEMA)
    # The general alias comes first; parents come before children; an unknown definition and absent keys are not visited.
    assert ask(spark, cp.paths(value, SCHEMA), doc) == [
        "|", "text|t", "line|t", "list/array|list", "text|list[0]", "text|list[1]", "in/object|in", "in/n/number|in.n", "pool|l", "loop|l",
    ]
    steps = {"text": F.upper, "line": lambda c: F.concat(c, F.lit("!")), None: lambda d: d.withField("l", F.lit("new")), "in/n/number": lambda n: n * 2}
    out = cp.to_json(cp.visited(value, SCHEMA, steps), cp.others(F.col("j"), SCHEMA))
    assert json.loads(ask(spark, out, doc)) == {"t": "A!", "list": ["B", "C"], "in": {"n": 2.0}, "l": "new", "gone": "y", "extra": 0}
    # Keys come in the schema's order, others behind them; what is no object is null.
    order = F.json_object_keys(cp.to_json(value, cp.others(F.col("j"), SCHEMA)))
    assert ask(spark, order, doc, {"z": {"k": [1]}, "y": 'q"u', "t": ""}, None, "[1]") == [["t", "list", "in", "l", "gone", "extra"], ["t", "z", "y"], None, None]
    whole = cp.to_json(value, cp.others(F.col("j"), SCHEMA))
    assert json.loads(ask(spark, whole, {"z": {"k": [1]}, "y": 'q"\\u', "w": None, "v": True, "t": "a"})) == {"t": "a", "z": {"k": [1]}, "y": 'q"\\u', "w": None, "v": True}
    assert json.loads(ask(spark, whole, {"z": 1})) == {"z": 1} and ask(spark, whole, {}) == "{}"


def test_enums_and_promotion(spark):
    doc = {"in": {"c": "green"}, "items": [{"c": "red"}, {"o": True}, {"c": "x'y"}], "list": "alone"}
    value = cp.parsed(F.col("j"), SCHEMA)
    assert ask(spark, cp.enum_errors(value, SCHEMA), doc) == ["in.c had an invalid enum value: 'green'", "items[2].c had an invalid enum value: 'x'y'"]
    assert ask(spark, value["list"], doc, {"list": ["a", "[b"]}, {"list": "[b"}, {}) == [["alone"], ["a", "[b"], ["[b"], None]
    assert cp.struct_type({"definitions": {"me": {"type": "object", "properties": {"x": {"$ref": "#/definitions/me"}}}}, "$ref": "#/definitions/me"}).simpleString() == "struct<x:string>"


def test_prune_before_leaves_what_becomes_empty(spark):
    schema = {"properties": {"a": {"type": "string"}, "b": {"type": "array", "items": {"properties": {"c": {"type": "string"}}}}, "d": {"properties": {"e": {"type": "string"}}}}}
    kind = cp.struct_type(schema)
    out = ask(spark, F.to_json(cp.pruned_before(cp.parsed(F.col("j"), schema), kind)), {"a": "", "b": [{"c": ""}, {}, {"c": "x"}], "d": {"e": "null"}})
    assert json.loads(out) == {"b": [{}, {"c": "x"}], "d": {}}


def test_reads_schema_files(spark, tmp_path):
    path = tmp_path / "s.json5"
    path.write_text("{// c\n properties: {a: {type: 'string',}}}")
    assert sc.read_schema(spark, str(path)) == {"properties": {"a": {"type": "string"}}}
    path.write_text("{}")
    assert sc.read_schema(spark, str(path)) == {"properties": {"a": {"type": "string"}}}


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([("known (a)",), ("other (b)",)], "n string")


def cleaned(spark, names, *docs, **more):
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=False) if isinstance(d, dict) else d, f"/x/gp00{i}-na-me.yaml") for i, d in enumerate(docs)], "i int, j string, path string")
    rows = catalogue.clean(df, "i", "j", names, "n", **more).orderBy("i").collect()
    return [(None if r["document"] is None else json.loads(r["document"]), r[catalogue.LINT]) for r in rows]


def test_catalogue_cleaning(spark, names):
    doc = {
        "zz": "kept", "empty": "", "lint-errors": ["old"], "learn_before": ["known (a)", "b", "b", ""], "better_grammar_point_name": ["known (a)"], "meaning": " m ", "grammar_point": " 'n (x)' ",
        "examples": [{"english": " “It (is)” ", "japanese": "　「あ」 ", "competing_grammar": [{"competing_japanese": "い"}]}, {"english": 'a "b" c', "japanese": ["", "う"]}],
        "false_friends": [{"grammar_point": "known (a)", "kind": "synonym"}, {"grammar_point": "<suggest>:other (b)"}, {"grammar_point": "new"}, {"grammar_point": "<strongly-suggest>:x"}, {"grammar_point": "<suggest>:a/b", "kind": "odd"}, {"term": ""}],
        "jlpt": "N7",
    }
    out, found = cleaned(spark, names, doc)[0]
    assert list(out) == ["grammar_point", "learn_before", "jlpt", "meaning", "examples", "false_friends", "lint-errors", "zz"]
    assert out["learn_before"] == ["b", "known (a)"] and out["meaning"] == "m"
    assert [f.get("grammar_point") for f in out["false_friends"]] == ["known (a)", "other (b)", "<suggest>:new", "<strongly-suggest>:x", "<suggest>:a/b"]
    assert out["examples"][0]["english"] == "It (is)" and len(out["examples"][0]["japanese"]) == 1 and out["examples"][1]["japanese"] == ["う"]
    assert list(out["examples"][0]) == ["japanese", "english", "competing_grammar"] and out["examples"][0]["competing_grammar"] == [{"competing_japanese": ["い"]}]
    assert out["lint-errors"] == found and "old" not in found
    for part in ("[rule-1]", "[rule-4] warning examples[0].english contains ()", "[rule-4] warning examples[1] has no competing_grammar", "[rule-6]", "[rule-7]", "[rule-12] warning false_friends[5]", "[rule-14] warning false_friends[4]"):
        assert any(part in m for m in found), part
    assert found[-2:] == ["jlpt had an invalid enum value: 'N7'", "false_friends[4].kind had an invalid enum value: 'odd'"]
    # A second pass changes nothing; file names give id and name; what is no document stays null.
    again, more = cleaned(spark, names, out)[0]
    assert {k: v for k, v in again.items() if k != "lint-errors"} == {k: v for k, v in out.items() if k != "lint-errors"} and len(more) >= len(found) - 1
    rows = cleaned(spark, names, {"meaning": "m"}, None, "[]", {}, path="path")
    assert rows[0][0]["id"] == "gp000" and rows[0][0]["grammar_point"] == "na-me" and rows[1][0] is None and rows[2][0] is None and rows[3][0]["id"] == "gp003"
