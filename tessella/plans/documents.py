"""Validation queries: catalogue documents built from the test tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import compiled, lint
from ..operators import catalogue
from .tables import table


def _catalog(spark, sf_dir):
    """Documents of the table as catalogue documents, all lines of their texts as examples."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    example = lambda e, i: F.struct(
        e.alias("english"), F.when(i % 2 == 0, F.array(e)).otherwise(F.array(e, F.lit("v"))).alias("japanese"),
        F.when(i % 3 == 0, F.array(F.struct(F.array().cast("array<string>").alias("competing_japanese"), F.lit("x").alias("english")))).alias("competing_grammar"),
        F.lit("r").alias("register"),
    )
    k = F.col("doc_id")
    name = F.concat(F.lit("point"), F.when(k % 2 == 0, " (good)").when(k % 3 == 0, " (Bad)").otherwise(""))
    friend = F.struct(
        F.lit("t").alias("term"), F.lit("m").alias("meaning"), F.when(k % 5 == 0, "homonym").otherwise("synonym").alias("kind"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, "a/b").when(k % 4 == 2, "<suggest>:c").otherwise("point (good)").alias("grammar_point"),
    )
    return d.select(
        "doc_id", name.alias("grammar_point"), F.when(k % 7 == 0, F.array(name)).alias("better_grammar_point_name"),
        F.array(F.lit("b"), F.lit("a"), F.lit("b")).alias("learn_before"), F.when(k % 6 != 0, "m").alias("meaning"),
        F.when(k % 9 == 0, "N9").otherwise("N3").alias("jlpt"), F.array(friend).alias("false_friends"), F.transform("lines", example).alias("examples"),
    )


def _count(spark, sf_dir, *names):
    docs = _catalog(spark, sf_dir)
    return docs.select("doc_id", *[F.size(lint.RULES[n]()).alias(n) for n in names])


def _messages(spark, sf_dir, name):
    found = lint.RULES[name]()
    return _catalog(spark, sf_dir).select("doc_id", F.size(found).alias(name), F.md5(F.array_join(found, "\n")).alias("digest"))


def lint_quotes(spark, sf_dir):
    return _messages(spark, sf_dir, "quotes")


def lint_brackets(spark, sf_dir):
    return _messages(spark, sf_dir, "brackets")


def lint_counts(spark, sf_dir):
    return _count(spark, sf_dir, "missing_competing", "example_count", "competing_count", "japanese_count")


def lint_names(spark, sf_dir):
    return _count(spark, sf_dir, "better_name", "name_meaning", "required")


def lint_references(spark, sf_dir):
    return _count(spark, sf_dir, "friend_reference", "special_characters")


def lint_unknown_refs(spark, sf_dir):
    docs = _catalog(spark, sf_dir).withColumn("names", F.array(F.lit("point (good)"), F.lit("point")))
    return docs.select("doc_id", F.size(lint.unknown_references("names")).alias("n"))


def lint_enum(spark, sf_dir):
    return _catalog(spark, sf_dir).select("doc_id", F.array_join(lint.enums(), "; ").alias("messages"))


def lint_report(spark, sf_dir):
    return lint.lint(_catalog(spark, sf_dir)).select("doc_id", F.size("lint-errors").alias("n"))


def clean_documents(spark, sf_dir):
    """Every line of every text cleaned, in quotes that enclose it twice."""
    docs = _catalog(spark, sf_dir)
    quoted = F.transform("examples", lambda x: x.withField("english", F.concat(F.lit(" “'"), x["english"], F.lit("'” "))))
    once = lint.clean(docs.withColumn("examples", quoted))
    lines = F.transform("examples", lambda x: x["english"])
    return once.select("doc_id", F.array_join("learn_before", ",").alias("learn_before"), "meaning", F.md5(F.array_join(lines, "\n")).alias("digest"))


SCHEMA = {
    "definitions": {"name": {"type": "string"}, "friend": {"$ref": "#/definitions/name"}, "level": {"enum": ["de", "en", "es"]}},
    "type": "object",
    "properties": {
        "lang": {"$ref": "#/definitions/level"}, "source": {"$ref": "#/definitions/friend"},
        "lines": {"type": "array", "items": {"type": "object", "properties": {"t": {"type": "string"}}}},
    },
}


def _json(spark, sf_dir):
    """Documents as JSON; keys in two orders, some without a language, some with a key that the schema lacks."""
    lines = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("t"))).alias("lines")
    k = F.col("doc_id")
    lang = F.when(k % 5 != 0, F.col("lang")).alias("lang")
    json = F.when(k % 2 == 0, F.to_json(F.struct("source", lines, lang))).otherwise(F.to_json(F.struct(F.lit("x").alias("zz"), lines, lang, "source")))
    return table(spark, sf_dir, "documents").select("doc_id", json.alias("json"))


def schema_visits(spark, sf_dir):
    """What a visitor that the schema compiles to sees in every document."""
    seen = _json(spark, sf_dir).select("doc_id", compiled.paths(compiled.parsed(F.col("json"), SCHEMA), SCHEMA).alias("v"))
    own = F.filter("v", lambda x: x.startswith("lines/t/string|"))
    return seen.select("doc_id", F.size("v").cast("long").alias("n"), F.substring_index(F.element_at("v", -1), "|", -1).alias("last"), F.size(own).cast("long").alias("n_lines"))


def schema_enums(spark, sf_dir):
    found = compiled.enum_errors(compiled.parsed(F.col("json"), SCHEMA), SCHEMA)
    return _json(spark, sf_dir).select("doc_id", F.get(found, F.lit(0)).alias("message"))


def schema_key_order(spark, sf_dir):
    out = compiled.to_json(compiled.parsed(F.col("json"), SCHEMA), compiled.others(F.col("json"), SCHEMA))
    return _json(spark, sf_dir).select("doc_id", F.array_join(F.json_object_keys(out), ",").alias("keys"))


def catalogue_cleaning(spark, sf_dir):
    """Documents as catalogue entries with shuffled and missing keys, quoted lines and references; names come from the parts."""
    k = F.col("doc_id")
    lines = F.transform(F.split("text", "\n"), lambda t: F.struct(F.concat(F.lit(" “'"), t, F.lit("'” ")).alias("english"), F.lit("あ").alias("japanese")))
    friends = F.array(F.struct(F.lit("antonym").alias("kind"), F.concat(F.lit("Brand#"), (k % 40).cast("string")).alias("grammar_point")))
    one = F.struct(lines.alias("examples"), F.lit("zz").alias("other"), F.when(k % 3 != 0, "m").alias("meaning"), F.lit(" n (x) ").alias("grammar_point"), F.array(F.lit("b"), F.lit("a"), F.lit("b"), F.lit("")).alias("learn_before"))
    two = F.struct(F.lit("N9").alias("jlpt"), friends.alias("false_friends"), F.lit("n (x)").alias("grammar_point"), F.array(F.lit("old")).alias("lint-errors"), F.lit("m").alias("meaning"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(k % 2 == 0, F.to_json(one)).otherwise(F.to_json(two)).alias("json"))
    out = catalogue.clean(docs, "doc_id", "json", table(spark, sf_dir, "part"), "p_brand")
    english = F.array_join(F.from_json(F.get_json_object("document", "$.examples"), "array<struct<english string>>")["english"], "\n")
    return out.select(
        "doc_id", F.array_join(F.json_object_keys("document"), ",").alias("keys"), F.size(catalogue.LINT).cast("long").alias("n"), F.md5(F.coalesce(english, F.lit(""))).alias("digest"),
        F.get_json_object("document", "$.false_friends[0].grammar_point").alias("friend"), F.get_json_object("document", "$.learn_before[0]").alias("first"),
    )


def prune_nested(spark, sf_dir):
    """Lines of every text, pruned of blank ones, in structs whose other parts are empty."""
    part = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("t"), F.array(F.lit("null")).alias("a"), F.create_map(F.lit("k"), F.lit("")).alias("m")))
    docs = table(spark, sf_dir, "documents").select("doc_id", part.alias("x"))
    kept = docs.select("doc_id", lint.pruned(F.col("x"), docs.schema["x"].dataType).alias("x"))
    others = F.exists("x", lambda p: p["a"].isNotNull() | p["m"].isNotNull())
    return kept.select("doc_id", F.size("x").alias("n"), others.alias("others"), F.md5(F.array_join(F.transform("x", lambda p: p["t"]), "\n")).alias("digest"))


E = """k as (select doc_id, text, string_split(text, chr(10)) as lines from documents), c as (select doc_id, unnest(lines) as e, generate_subscripts(lines, 1) - 1 as i from k)"""
BRACKET = "regexp_matches(e, '[\\(\\)\\[\\]{{}}<>]')".replace("{{}}", "{}")
COUNTS = f"""count_if(contains(e, '"')) as quotes, count_if({BRACKET}) as brackets, count_if(i % 3 <> 0) as missing_competing, (count(*) < 10)::int as example_count,
  count_if(i % 3 = 0) as competing_count, count_if(i % 2 = 0) as japanese_count,
  (doc_id % 7 = 0)::int + (doc_id % 2 <> 0 and doc_id % 3 <> 0)::int as better_name,
  case when doc_id % 2 = 0 then 0 when doc_id % 3 = 0 then 1 else 1 end as name_meaning, (doc_id % 6 = 0)::int as required,
  (doc_id % 4 = 0)::int as friend_reference, (doc_id % 4 = 1)::int as special_characters, (doc_id % 9 = 0)::int + (doc_id % 5 = 0)::int as enums"""
ALL = f"with {E}, n as (select doc_id, {COUNTS} from c group by doc_id)"
INT = lambda *names: ", ".join(f"{n}::int as {n}" for n in names)
QUERIES = {
    "lint_quotes": (lint_quotes, f"""with {E} select doc_id, count_if(contains(e, '"'))::int as quotes,
      md5(coalesce(string_agg('[rule-1] warning examples[' || i || '].english contains a double quote: "' || e, chr(10) order by i) filter (contains(e, '"')), '')) as digest from c group by 1"""),
    "lint_brackets": (lint_brackets, f"""with {E}, f as (select *, case when regexp_matches(e, '[()]') then '()' when contains(e, '[') or contains(e, ']') then '[]' when contains(e, chr(123)) or contains(e, chr(125)) then chr(123) || chr(125) when regexp_matches(e, '[<>]') then '<>' end as b from c)
      select doc_id, count(b)::int as brackets, md5(coalesce(string_agg('[rule-4] warning examples[' || i || '].english contains ' || b, chr(10) order by i) filter (b is not null), '')) as digest from f group by 1"""),
    "lint_counts": (lint_counts, f"{ALL} select doc_id, {INT('missing_competing', 'example_count', 'competing_count', 'japanese_count')} from n"),
    "lint_names": (lint_names, f"{ALL} select doc_id, {INT('better_name', 'name_meaning', 'required')} from n"),
    "lint_references": (lint_references, f"{ALL} select doc_id, {INT('friend_reference', 'special_characters')} from n"),
    "lint_unknown_refs": (lint_unknown_refs, f"with {E} select doc_id, (doc_id % 4 in (0, 1))::int as n from k"),
    "lint_enum": (lint_enum, f"""with {E} select doc_id, array_to_string(list_filter([case when doc_id % 9 = 0 then 'error jlpt: N9 is not allowed' end,
      case when doc_id % 5 = 0 then 'error false_friends[0].kind: homonym is not allowed' end], lambda x: x is not null), '; ') as messages from k"""),
    "lint_report": (lint_report, f"""{ALL} select doc_id, (quotes + brackets + missing_competing + example_count + competing_count + japanese_count + better_name + name_meaning + required
      + friend_reference + special_characters + enums)::int as n from n"""),
    "clean_documents": (clean_documents, f"""with {E} select doc_id, 'a,b' as learn_before, case when doc_id % 6 <> 0 then 'm' end as meaning, md5(string_agg(e, chr(10) order by i)) as digest from c group by 1"""),
    "schema_visits": (schema_visits, f"""with {E} select k.doc_id, 4 + (k.doc_id % 5 <> 0 and lang is not null)::int + 2 * len(lines) as n, 'lines[' || (len(lines) - 1) || '].t' as last, len(lines) as n_lines
      from k join documents using (doc_id)"""),
    "schema_enums": (schema_enums, "select doc_id, case when doc_id % 5 <> 0 and lang not in ('de', 'en', 'es') then 'lang had an invalid enum value: ' || chr(39) || lang || chr(39) end as message from documents"),
    "schema_key_order": (schema_key_order, """select doc_id, case when doc_id % 5 <> 0 and lang is not null then 'lang,' else '' end || 'source,lines' || case when doc_id % 2 <> 0 then ',zz' else '' end as keys from documents"""),
    "catalogue_cleaning": (catalogue_cleaning, f"""with {E}, b as (select distinct p_brand from part),
      x as (select doc_id, count(*) as n, count_if(contains(e, '"')) as q, count_if({BRACKET}) as br, count_if(trim(e, ' ' || chr(9) || chr(13)) <> '') as kept, string_agg(e, chr(10) order by i) as all_lines from c group by 1)
      select doc_id, case when doc_id % 2 = 0 then 'grammar_point,learn_before,' || case when doc_id % 3 <> 0 then 'meaning,' else '' end || 'examples,lint-errors,other' else 'grammar_point,jlpt,meaning,false_friends,lint-errors' end as keys,
        case when doc_id % 2 = 0 then q + br + 2 * n + (n < 10)::int + (doc_id % 3 = 0)::int else 1 + (p_brand is null and false)::int end as n,
        md5(case when doc_id % 2 = 0 then all_lines else '' end) as digest, case when doc_id % 2 <> 0 then case when p_brand is null then '<suggest>:' else '' end || 'Brand#' || doc_id % 40 end as friend,
        case when doc_id % 2 = 0 then 'a' end as first
      from x left join b on p_brand = 'Brand#' || doc_id % 40"""),
    "prune_nested": (prune_nested, f"""with {E} select doc_id, nullif(count_if(e not in ('', 'null')), 0)::int as n, case when count_if(e not in ('', 'null')) > 0 then false end as others,
      md5(string_agg(e, chr(10) order by i) filter (e not in ('', 'null'))) as digest from c group by 1"""),
}
