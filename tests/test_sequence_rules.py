"""Rule tables against the regular expressions that define them."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tessella.functions.matcher import sequence_pattern
from tessella.operators import sequence_rules as sr

SURFACES = "a b ab ba abc cab c bc ccc x xa".split()


def sentence(rng):
    word = lambda: rng.choice(SURFACES)
    tokens = [f"⌈ˢ{word()}ᵖn{'ᵇ' + word() if rng.random() < 0.7 else ''}ʳ{word().upper()}⌉" for _ in range(rng.randint(0, 8))]
    return "".join(tokens) if rng.random() < 0.9 else " と ".join(tokens)


def rule(rng):
    part = lambda: rng.choice([rng.choice(SURFACES), "ᵇ" + rng.choice(SURFACES), "○○", ".*" + rng.choice(SURFACES), rng.choice(SURFACES) + ".*", "[ab]c?", "a.*b"])
    return "|".join(part() for _ in range(rng.choice([1, 1, 2, 2, 3, 4, 5])))


def marked(text, rules):
    for r, name in rules:
        m = re.search(sequence_pattern(r), text)
        if m:
            text = text[: m.start()] + m.group().replace("⌉", f"ᵍ{name}⌉") + text[m.end() :]
    return text


@pytest.mark.parametrize("seed", range(2))
def test_table_equals_the_expressions(seed):
    rng = random.Random(seed)
    rules = [(r, name) for r in (rule(rng) for _ in range(800)) for name in ([f"n{rng.randrange(90)}"] if rng.random() < 0.8 else ["ab", "x-c"])]
    sentences = [sentence(rng) for _ in range(20)] + [None, "", "no token"]
    table = sr.Table(rules)
    assert sum(r.blocks is not None for r in table.rules) > 300
    want = [None if s is None else sorted({n for r, n in rules if re.search(sequence_pattern(r), s)}) for s in sentences]
    assert sr.labels_of(table, sentences) == want
    few = rules[:60]
    assert sr.annotations_of(sr.Table(few), sentences) == [None if s is None else marked(s, few) for s in sentences]


def test_greedy_spans():
    table = sr.Table([("a|○○|b", "g"), ("○○|c", "l"), ("x.*", "t"), (".*bc", "h"), ("a|b", "p")])
    places = lambda words: {lit: [i for i, w in enumerate(words) if lit in table.literals(f"⌈ˢ{w}ᵖn⌉")] for rule in table.rules for lit in rule.literals}
    words = "z a q b q b c x bc".split()
    assert [sr.span(r, places(words), len(words)) for r in table.rules if all(places(words)[lit] for lit in r.literals)] == [(1, 9), (0, 7), (7, 9), (0, 9), None]


def test_time_is_linear_in_tokens():
    import time

    table = sr.Table([("and|○○|of", "g"), (".*ing", "h")])
    took = []
    for n in (20_000, 80_000):
        text = "".join(f"⌈ˢ{'and' if i % 2 else 'w' + str(i % 97)}ᵖn⌉" for i in range(n))
        began = time.process_time()
        assert sr.labels_of(table, [text]) == [[]]
        took.append(time.process_time() - began)
    assert took[1] < 10 * max(took[0], 0.01)


def test_columns_and_tables_of_several_passes(spark):
    rng = random.Random(11)
    rules = {rule(rng): f"n{i % 7}" if i % 3 else [f"n{i % 7}", "two"] for i in range(90)}
    pairs = [(r, n) for r, names in rules.items() for n in ([names] if isinstance(names, str) else names)]
    sentences = [sentence(rng) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sentences)], "i int, c string")
    table = sr.rules_from(spark, rules)
    for each in (5000, 13):
        rows = df.select("i", sr.labels(F.col("c"), table, each).alias("l"), sr.annotate(F.col("c"), table, each).alias("a")).orderBy("i").collect()
        assert [r["l"] for r in rows] == [None if s is None else sorted({n for r, n in pairs if re.search(sequence_pattern(r), s)}) for s in sentences]
        assert [r["a"] for r in rows] == [None if s is None else marked(s, pairs) for s in sentences]
    none = df.select(sr.labels(F.col("c"), table.where("false")).alias("l"), sr.annotate(F.col("c"), table.where("false")).alias("a")).collect()
    assert none[0]["l"] == [] and none[0]["a"] == sentences[0] and none[60]["l"] is None


def test_reads_rule_files(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"に": ["に", "に/へ"], "と|いう": "という", "で|も": "[でも]"}, ensure_ascii=False))
    rows = [tuple(r) for r in sr.read_rules(spark, str(path)).orderBy("place").collect()]
    assert rows == [(0, "に", "に"), (1, "に", "に/へ"), (2, "と|いう", "という"), (3, "で|も", "[でも]")]


def test_a_rule_is_matched_in_all_sentences_at_once(monkeypatch):
    """No step of a rule goes sentence by sentence."""
    called = []
    monkeypatch.setattr(sr, "span", lambda *a: called.append(a))
    monkeypatch.setattr(sr, "_starts", lambda *a: called.append(a))
    word = lambda w: f"⌈ˢ{w}ᵖn⌉"
    sentences = [word("a") + word("b") * (k % 3) + word("c") for k in range(3000)]
    rules = [("a|b", "p"), ("a|○○|c", "g"), ("b.*", "n1"), (".*n1", "seen")]
    assert sr.labels_of(sr.Table(rules), sentences) == [sorted({n for r, n in rules if re.search(sequence_pattern(r), s)}) for s in sentences]
    assert sr.annotations_of(sr.Table(rules), sentences) == [marked(s, rules) for s in sentences]
    assert not called


def test_a_sentence_is_matched_once_where_the_result_has_a_condition(spark):
    """A condition on the result must not run the rules again below it; names are counted where they are written."""
    rules = {"a|b": "p", "a|○○|c": ["g", "ab"], ".*ab": "seen"}
    pairs = [(r, n) for r, names in rules.items() for n in ([names] if isinstance(names, str) else names)]
    rng = random.Random(4)
    sentences = [sentence(rng) for _ in range(40)] + [None, "", "no token"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sentences)], "i int, c string")
    table = sr.rules_from(spark, rules)
    for each, passes in ((5000, 1), (3, 2)):
        for column in (sr.names_taken(F.col("c"), table, each), F.length(sr.annotate(F.col("c"), table, each)) - F.length("c")):
            n = df.select("i", column.alias("n")).where("n > 0")
            assert str(n._jdf.queryExecution().executedPlan()).count("ArrowEvalPython") <= passes
        n = df.select("i", sr.names_taken(F.col("c"), table, each).alias("n"))
        assert [r["n"] for r in n.orderBy("i").collect()] == [None if s is None else marked(s, pairs).count("ᵍ") for s in sentences]
    assert df.select(sr.names_taken(F.col("c"), table.where("false")).alias("n")).where("n > 0").count() == 0
