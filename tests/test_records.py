"""Catalogue records on literals: carries and resets, errors, orders, fix-ups."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tessella.operators import records
from tessella.sources import readers, writers


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def record(spark, **keys):
    return spark.createDataFrame([(1, keys)], "k int, r map<string,string>")


def sentences(n, **more):
    own = {"englishTermMeaning": "m"}
    for i in range(1, n + 1):
        own |= {f"japaneseSentence{i if i > 1 else ''}": f"j{i}", f"englishSentenceMeaning{i if i > 1 else ''}": f"e{i}"}
    return own | more


def test_a_blank_level_ends_the_carry_and_a_blank_meaning_does_not(spark):
    r = record(spark, **sentences(5, level="N5", level3="", level5="N1", englishTermMeaning2="", englishTermMeaning4="x", nuance2="it's"))
    out = records.numbered_sentences(r, "k", "r").orderBy("pos").collect()
    assert [x["level"] for x in out] == ["N5", "N5", "", "", "N1"]
    assert [x["meaning"] for x in out] == ["m", "", "m", "x", "x"]
    assert [x["nuance"] for x in out] == ["", "it's", "", "", ""]
    assert [x["english"] for x in out] == ["e1", "e2", "e3", "e4", "e5"]


def test_sentences_end_at_the_first_gap(spark):
    keys = sentences(4)
    del keys["japaneseSentence3"]
    assert [x["japanese"] for x in records.numbered_sentences(record(spark, **keys), "k", "r").orderBy("pos").collect()] == ["j1", "j2"]
    assert records.numbered_sentences(record(spark, level="N5"), "k", "r").count() == 0


@pytest.mark.parametrize(("change", "told"), [({"englishSentenceMeaning2": None}, "no translation: j2"), ({"englishTermMeaning": None}, "lacks its term meaning"), ({"nuance2": "'a'"}, "more than one single quote")])
def test_faulty_records_raise(spark, change, told):
    keys = {k: v for k, v in (sentences(2) | change).items() if v is not None}
    with pytest.raises(Exception, match=told):
        records.numbered_sentences(record(spark, **keys), "k", "r").collect()


def test_keys_are_matched_as_a_whole(spark):
    r = record(spark, level="a", level2="b", levels="c", my_level="d")
    assert rows(r.select(F.map_keys(records.keys_like(F.col("r"), r"level\d*")))) == [(["level", "level2"],)]


def test_duplicates_raise(spark):
    once = spark.createDataFrame([("a", 1), (None, 2)], "n string, v int")
    assert rows(records.unique_or_error(once, "n")) == rows(once)
    with pytest.raises(Exception, match="duplicate n: a"):
        records.unique_or_error(once.union(once.where("n = 'a'")), "n").collect()
    with pytest.raises(Exception, match="duplicate n: null"):
        records.unique_or_error(once.union(once.where("n is null")), "n").collect()


def test_merged_lists_keep_the_first_order(spark):
    old = spark.createDataFrame([(0, "b", "x"), (1, "a", "y"), (2, "c", "z")], "at int, k string, v string")
    new = spark.createDataFrame([(0, "d", "1"), (1, "a", None), (2, "A", "3")], "at int, k string, v string")
    out = records.merged_lists(old, new, "k", [F.col("at")], [F.col("at")]).orderBy("pos").collect()
    assert [(r["k"], r["v"]) for r in out] == [("b", "x"), ("a", None), ("c", "z"), ("d", "1"), ("A", "3")]
    assert records.merged_lists(old.where("at > 5"), new.where("at > 5"), "k", [F.col("at")], [F.col("at")]).count() == 0


def test_accumulated_counts_what_is_new(spark):
    held = spark.createDataFrame([("k", "a"), ("k", "a"), ("l", "b")], "k string, v string")
    more = spark.createDataFrame([("k", "c"), ("k", "a"), ("m", "d"), ("m", "d"), ("m", None)], "k string, v string")
    assert rows(records.accumulated(held, more, "k", "v")) == [("k", ["a", "c"], 1), ("l", ["b"], 0), ("m", ["d"], 1)]


def test_fix_ups_by_url_and_term(spark):
    docs = spark.createDataFrame([("u", "p", [("t", 1), ("s", 2)], 9), ("v", None, None, 8), (None, "q", [], 7)], "url string, grammar_point string, false_friends array<struct<term string, n int>>, x int")
    names = spark.createDataFrame([("u", "P"), ("w", "z")], "url string, new string")
    terms = spark.createDataFrame([("u", "t", "T"), ("u", "s", "s"), ("u", "absent", "r")], "url string, term string, new string")
    fixed, idle = records.fixed_up(docs, names, terms)
    assert fixed.columns == docs.columns
    assert rows(fixed.select("url", "grammar_point", "false_friends.term", "false_friends.n", "x")) == sorted([("u", "P", ["T", "s"], [1, 2], 9), ("v", None, None, None, 8), (None, "q", [], [], 7)], key=repr)
    assert rows(idle) == [("u", "s", "s")]
    assert rows(records.fixed_up(docs, spark.createDataFrame([("u", "p")], "url string, new string"), terms.limit(0))[1]) == [("u", None, "p")]


def test_source_report(spark):
    r = spark.createDataFrame([("a", ["b", "x"]), ("a", None), ("b", ["x"])], "n string, refs array<string>")
    assert rows(records.source_report(r, "n", "refs", r, "n")) == [("dangling", "x", 2), ("duplicate", "a", 2)]


def test_xml_sink_keeps_attributes(spark, tmp_path):
    schema = "s array<struct<_VALUE string, `_xml:lang` string>>"
    held = spark.createDataFrame([([("<a> & b", "jpn")],), ([],)], schema)
    writers.write_xml(held, f"{tmp_path}/x", "entry", "all")
    assert rows(readers.read_xml(spark, f"{tmp_path}/x", "entry", schema).where("s is not null")) == [([("<a> & b", "jpn")],)]


def test_listed_paths(spark, tmp_path):
    (tmp_path / "l").write_text("a b\n\n  \nc\n")
    assert rows(readers.listed(spark, str(tmp_path / "l"))) == [("a b",), ("c",)]


def test_yaml_keeps_the_order_of_keys(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("b: 1\na: {d: é, c: [2]}\n")
    (tmp_path / "b.yaml").write_text("a: [")
    read = readers.yaml_json(readers.whole_files(spark, str(tmp_path))).orderBy("name").collect()
    assert read[0]["json"] == '{"b": 1, "a": {"d": "é", "c": [2]}}' and read[0]["error"] is None
    assert read[1]["json"] is None and read[1]["error"]


def test_lesson_order_is_stable(spark):
    out = spark.createDataFrame([(7, "a"), (None, "a"), (None, None)], "own int, n string").select(records.lesson_order(F.col("own"), F.col("n")))
    assert [r[0] for r in out.collect()] == [7, int(hashlib.md5(b"a").hexdigest()[:8], 16) % 10000, None]


def test_examples_without_their_label_get_a_rule(spark):
    examples = spark.createDataFrame([("p/q○○", "s1", "aᵍx"), ("p/q○○", "s2", "aᵍq○○"), ("z", "s3", None)], "name string, japanese string, tokens string")
    terms = spark.createDataFrame([("q○○", [("食べ", "動詞", "食べる"), ("XXX", "名詞", "x")])], "term string, parts array<struct<surface string, pos string, base string>>")
    assert rows(records.compliance(examples, terms).select("japanese", "term", "rule")) == [("s1", "p", None), ("s1", "q○○", "ᵇ食べる|○○"), ("s3", "z", None)]
