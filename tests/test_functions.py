"""String, token, matcher and lint functions on literals."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.functions import lint, matcher, text, tokens
from tessella.operators import sequence_rules


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


def many(spark, build, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.x for r in rows.select("i", build(F.col("s")).alias("x")).orderBy("i").collect()]


def test_strip_quotes(spark):
    deep = "“‘" * 30 + "x" + "’”" * 30
    assert many(spark, text.strip_quotes, [deep, deep + "'", "\"'a\"'", "'" * 9, "a\"\n"]) == ["x", deep + "'", "\"'a\"'", "'", "a\"\n"]
    got = many(spark, text.strip_quotes, ['"a"', "'\"a\"'", "「こ」", "「『こ』」", '"a', 'a"', "", None, "“x”", '"', '""'])
    assert got == ["a", "a", "こ", "こ", '"a', 'a"', "", None, "x", '"', ""]


def test_cleaned_values(spark):
    raw = [" a   b \n\n\n c　d", " http：//x  y ", "　\t", "", None, "–’：？", "\n", "x\n http："]
    assert many(spark, text.clean_value, raw) == ["a  b\n\nc d", "http：//x  y", None, None, None, "-':?", "\n", "x\nhttp:"]


def test_meaning(spark):
    assert many(spark, text.meaning, ["A (b)", "A (b) (c)", "A", "A(b)", None, "A (I do)"]) == ["b", "c", None, None, None, "I do"]
    assert many(spark, lambda c: text.meaning_start_ok(c), ["b", "I do", "~x", "Big", "über"]) == [True, True, True, False, True]


def test_suggestions(spark):
    known = lambda c: text.suggested(c, c.isin("a", "<suggest>:a"))
    assert many(spark, known, ["a", "b", "<suggest>:b", "<suggest>:a", "<strongly-suggest>:b"]) == ["a", "<suggest>:b", "<suggest>:b", "a", None]


def test_kana(spark):
    assert many(spark, text.hiragana, ["カタカナ", "かな", "abcヴ"]) == ["かたかな", "かな", "abcヴ"]
    assert many(spark, text.all_hiragana, ["かな", "カナ", ""]) == [True, False, True]
    rows = spark.createDataFrame([("かな", "x"), ("カナ", "y"), ("漢字", "かんじ")], "w string, r string")
    assert [r[0] for r in rows.select(text.dictionary_key(F.col("w"), F.col("r"))).collect()] == ["かな", "かな", "漢字|かんじ"]


def test_name_problems(spark):
    names = ["good (fine)", "bad (Fine)", "a/b", "a (b", "a) (b", "x 1", "①", "[a (b)]", "a + "]
    assert many(spark, text.valid_name, names) == [[], ["meaning-case"], ["slash"], ["brackets"], ["brackets"], [], ["circled-digit"], [], ["separator"]]


def test_html_and_payloads(spark):
    assert one(spark, text.strip_html(F.col("h")), h="<div><ruby>字<rt>じ</rt></ruby> <span>a</span>\n<script>x</script><p> </p></div>") == "<div>字 a </div>"
    assert many(spark, text.marked_payload, ["a BEGIN x END b", "plain"]) == ["x", "plain"]
    assert many(spark, text.without_fences, ["```json\n{}\n```", "{}"])[1] == "{}"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab ，é\n\t　", max_size=12), min_size=1, max_size=20))
def test_trim_is_python_strip(spark, values):
    assert many(spark, text.trim_space, values) == [v.strip() for v in values]


RAW = "食べ\t動詞,一般,*,*,下一段-バ行,連用形-一般,タベル,食べる,食べ,タベ,食べる,タベル\nた\t助動詞,,,,助動詞-タ,終止形-一般,タ,た,た,タ,た,タ\nEOS"


def test_raw_lines_to_compact(spark):
    raw = RAW.replace("*,*", ",")
    got = one(spark, tokens.compact_sentence(tokens.raw_tokens(F.col("r"))), r=raw)
    assert got == "⌈ˢ食べᵖv:general:e-ichidan-ba:conjunctiveᵇ食べるᵈ食べるʳタベ⌉⌈ˢたᵖauxv:auxv-ta:terminalᵇたʳタ⌉"
    assert one(spark, tokens.compact_sentence(tokens.raw_tokens(F.col("r"))), r="x\t未知,,\n") == "⌈ˢxᵖNone⌉"
    with pytest.raises(Exception, match="unmapped detail"):
        one(spark, tokens.compact_sentence(tokens.raw_tokens(F.col("r"))), r=RAW)


def test_spacing(spark):
    compact = "".join(f"⌈ˢ{s}ᵖn⌉" for s in ["{", "私", "}", "は", "。", "行く"])
    assert one(spark, tokens.plain_text(F.col("c"), True), c=compact) == "{私} は。行く"
    assert one(spark, tokens.plain_text(F.col("c")), c=compact) == "{私}は。行く"


def test_injectivity(spark):
    rows = spark.createDataFrame([("c", "r1"), ("c", "r2"), ("d", "r3"), ("d", "r3")], "compact string, raw string")
    assert [tuple(r) for r in tokens.injectivity_conflicts(rows, "compact", "raw").collect()] == [("c", 2, "r1", "r2")]


TO = "⌈ˢとᵖprt:case_particleᵇとʳト⌉"
READ = "⌈ˢ読むᵖv:general:godan-ma:terminalᵇ読むʳヨム⌉"
TE = "⌈ˢてᵖprt:conjunctive_particleᵇてʳテ⌉"
EAT = "⌈ˢ食べᵖv:general:e-ichidan-ba:conjunctiveᵇ食べるʳタベ⌉"
SHINE = "⌈ˢ死ねᵖv:general:godan-na:imperativeᵇ死ぬʳシネ⌉"
PLEASE = "⌈ˢくださいᵖv:non_self_reliant:godan-ra:imperativeᵇくださるᵈ下さるʳクダサイ⌉"
NICE = "⌈ˢ高いᵖadj:general:adjective:terminalᵇ高いʳタカイ⌉"
CASES = [
    ("{to}", TO, "と"), ("{to}", READ, None), ("{verb-dictionary}", READ, "読む"), ("{verb-dictionary}", TE + READ, None), ("{verb-te}", EAT + TE, "食べ て"),
    ("{verb-imperative}", SHINE, "死ね"), ("{verb-imperative}", PLEASE, None), ("{i-adjective-dictionary}", NICE, "高い"), ("{noun}", "⌈ˢ本ᵖn:common_noun⌉", "本"),
    ("{noun} {to}", "⌈ˢ本ᵖn:common_noun⌉" + TO, "本 と"), ("{verb-dictionary}{to}", READ + TO, "読む と"), ("⌈~ᵖadj~⌉", NICE + TO, "高い"),
]


@pytest.mark.parametrize(("rule", "sentence", "expected"), CASES)
def test_matcher(spark, rule, sentence, expected):
    assert one(spark, matcher.match(F.col("c"), matcher.compile_matcher(rule)), c=sentence) == expected


def test_grouping_of_loose_macros():
    assert re.search(matcher.compile_matcher("{verb-te}{to}"), EAT + TE + TO).group(0) == EAT + TE + TO
    assert not re.search(matcher.compile_matcher("{verb-te}{to}"), EAT + TE)
    assert re.search(matcher.compile_matcher("{verb-te}{to}", grouped=False), EAT + TE)
    with pytest.raises(ValueError):
        matcher.compile_matcher("{unknown}")


def test_rules_in_turn(spark):
    compact = READ + TO
    rules = lambda table: sequence_rules.rules_from(spark, table)
    assert one(spark, sequence_rules.annotate(F.col("c"), rules({"ᵇ読": "V", "と": "P"})), c=compact) == READ.replace("⌉", "ᵍV⌉") + TO.replace("⌉", "ᵍP⌉")
    assert one(spark, sequence_rules.labels(F.col("c"), rules({"ᵇ読|と": "VP", "と|ᵇ読": "PV"})), c=compact) == ["VP"]


def document(spark, **fields):
    blank = {f.name: None for f in spark.createDataFrame([], lint.DOCUMENT).schema}
    return spark.createDataFrame([tuple((blank | fields).values())], lint.DOCUMENT)


def test_lint_of_one_document(spark):
    example = ('He said "x" (y)', ["a"], [], None)
    doc = document(spark, grammar_point="p (Big)", better_grammar_point_name=["p (Big)"], jlpt="N7", examples=[example, ("fine", ["a", "b"], [([], "e")], None)], false_friends=[("t", "m", "odd", " ")])
    messages = lint.lint(doc).first()["lint-errors"]
    for wanted in ("[rule-1]", "[rule-4] warning examples[0].english contains ()", "[rule-4] warning examples[0] has no", "[rule-6]", "[rule-7]", "[rule-14]", "[rule-9]", "meaning is required", "[rule-12]", "jlpt: N7", "kind: odd"):
        assert any(wanted in m for m in messages), (wanted, messages)
    assert lint.lint(document(spark, grammar_point="p (ok)", meaning="ok")).first()["lint-errors"] == []


def test_clean_is_idempotent(spark):
    doc = document(spark, grammar_point="p", meaning="null", learn_before=["b", "a", "b", ""], examples=[('"quoted"', ["「こ」", "あ：い"], None, "")], false_friends=[])
    once = lint.clean(doc)
    row = once.first()
    assert row.meaning is None and row.learn_before == ["a", "b"] and row.false_friends is None
    assert row.examples[0].english == "quoted" and row.examples[0].japanese == ["こ", "あ:い"]
    assert lint.clean(once).first() == row


def test_schema_helpers():
    from tessella.functions import schema as sc

    schema = {
        "definitions": {"text": {"type": "string"}, "line": {"$ref": "#/definitions/text"}, "loop": {"$ref": "#/definitions/pool"}, "pool": {"$ref": "#/definitions/loop"}, "me": {"type": "object", "properties": {"x": {"$ref": "#/definitions/me"}}}},
        "properties": {"b": {"$ref": "#/definitions/line"}},
    }
    assert sc.alias_chains(schema) == {"text": ["text"], "line": ["line", "text"], "loop": ["loop", "pool"], "pool": ["pool", "loop"], "me": ["me"]}
    assert sc.dereferenced(schema)["properties"]["b"] == {"type": "string"} and "definitions" not in sc.dereferenced(schema)
    assert sc.dereferenced({"definitions": schema["definitions"], "$ref": "#/definitions/me"}) == {"type": "object", "properties": {"x": {}}}
    assert sc.parse_json5("{a: 1, /* c */ 'b': \"// no\", c: [1, 2,], // end\n}") == {"a": 1, "b": "// no", "c": [1, 2]}
    assert sc.repaired('```json\n{"a": [1, {"b": "x') == {"a": [1, {"b": "x"}]}
    assert sc.repaired('say {"a": 1, "b":') == {"a": 1, "b": None} and sc.repaired('{"a": 1,} tail') == {"a": 1} and sc.repaired("none") is None


def test_meanings_are_complete(spark):
    from tessella.functions import lint

    docs = spark.createDataFrame([("a", ""), ("b", "old")], "grammar_point string, meaning string")
    put = lambda *m: lint.checked_meanings(docs, spark.createDataFrame(list(m), "name string, meaning string"))
    assert sorted(tuple(r) for r in put(("a", "new")).collect()) == [("a", "new"), ("b", "old")]
    for bad in ([("b", "x")], [("a", "x"), ("zz", "y")]):
        with pytest.raises(Exception, match="meaning"):
            put(*bad).collect()


def test_matchers_are_tried_at_tokens_only(spark):
    every = {m: matcher.compile_matcher("{" + m + "}") for m in matcher.MACROS}
    assert {m for m, p in every.items() if not matcher.at_tokens(p).startswith("(?=⌈)")} == {"mo"}
    for loose in ("⌈?a", "(?:⌈a|b)", "(?:⌈a)*", "⌈a|b", "(⌈a)", "[⌈]a", "(?:⌈a)?⌈b", r"\⌈a"):
        assert matcher.at_tokens(loose) == loose
    both = [("⌈ˢ犬ᵖnᵇ犬⌉⌈ˢ飲むᵖv:general:godan-ma:terminalᵇ飲むʳノム⌉", "飲む"), ("⌈ˢ犬ᵖnᵇ犬⌉", None), ("", None)]
    df = spark.createDataFrame([(c,) for c, _ in both], "c string")
    assert [r[0] for r in df.select(matcher.match(F.col("c"), every["verb-dictionary"])).collect()] == [w for _, w in both]


def test_plain_text_leaves_texts_without_marks_and_parts_need_no_expression(spark):
    odd = ["⌈ˢaᵖn:x:yᵇbᵈdʳp⌉", "⌈ˢaᵖ⌉", "⌈ˢa⌉", "⌈ˢᵖnᵇʳ⌉", "⌈ˢaˢbᵖnᵈxᵇ⌉ᵖzᵇq", "", None, "ᵖˢa\nbᵖn:\nʳé"]
    rows = spark.createDataFrame([(x,) for x in odd], "t string")
    x = F.col("t")
    after = lambda mark: F.nullif(F.regexp_extract(x, f"{mark}([^ᵇᵈʳ⌉]*)", 1), F.lit(""))
    tags = F.split(F.regexp_extract(x, "ᵖ([^ᵇᵈʳ⌉]*)", 1), ":")
    want = F.struct(F.regexp_extract(x, "ˢ([^ᵖ]*)ᵖ", 1).alias("surface"), F.get(tags, F.lit(0)).alias("pos"), F.slice(tags, 2, 9).alias("details"), after("ᵇ").alias("base"), after("ᵈ").alias("lemma"), after("ʳ").alias("pron"))
    own = rows.select(tokens.parse_token(x).alias("a"), want.alias("b"))
    assert [r["a"] for r in own.collect()] == [r["b"] for r in own.collect()]
    assert "regexp_extract" not in own.select("a")._jdf.queryExecution().optimizedPlan().toString()
    words = ["a", "*", "b", "。", "(", "c", ")", "", "d", "-"]
    rows = spark.createDataFrame([("".join(f"⌈ˢ{w}ᵖn⌉" for w in some),) for some in (words, words[::-1], ["a", "b"], [])], "t string")
    chain = tokens.plain_text(F.col("t"), True, False)
    for mark in tokens.PUNCTUATION:
        chain = F.replace(F.replace(chain, F.lit(f" {mark}"), F.lit(mark)), F.lit(f"{mark} "), F.lit(mark))
    assert all(r[0] == r[1] for r in rows.select(tokens.plain_text(F.col("t"), True), chain).collect())


def test_quotes_are_stripped_with_each_step_written_once(spark):
    """In a lambda nothing is shared, so an expression written n times is worked out n times for every line."""
    shown = F.transform(F.array(F.col("id").cast("string")), lambda x: text.strip_quotes(text.trim_space(x))).alias("x")
    plan = spark.range(1).select(shown)._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("regexp_extract") == 2 and plan.count("trim(") == 1 and "regexp_replace" not in plan
    cases = {"“'a'”": "a", "'“a'”": "'“a'”", "''": "", "'": "'", "'''": "'", "「『x』」": "x", "“'x”'": "“'x”'", None: None, "": "", "\"a\nb\"": "a\nb", "a'": "a'"}
    df = spark.createDataFrame(list(cases.items()), "k string, v string")
    assert [r for r in df.select("k", "v", text.strip_quotes(F.col("k")).alias("x")).collect() if r["v"] != r["x"]] == []
    white = "　 \t\n\x85\xa0   "
    assert one(spark, text.trim_space(F.col("t")), t=f"{white}a b​{white}") == "a b​"
