"""Queries on catalogue records and matcher macros, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lint, matcher, text
from ..operators import records
from ..operators import relational as rel
from .tables import table


def _records(spark, sf_dir):
    """Documents as records with numbered keys, one sentence a line; the twelfth line's key is missing, so later ones do not count."""
    lines = F.transform(F.split("text", "\n"), lambda t, i: F.struct((i + 1).alias("i"), t.alias("t")))
    entry = lambda name, value: lambda x: F.struct(F.concat(F.lit(name), F.when(x["i"] > 1, x["i"].cast("string")).otherwise(F.lit(""))).alias("key"), value(x).alias("value"))
    some = lambda items, every, at: F.filter(items, lambda x: x["i"] % every == at)
    items = F.concat(
        F.transform(F.filter(lines, lambda x: x["i"] != 12), entry("japaneseSentence", lambda x: x["t"])), F.transform(lines, entry("englishSentenceMeaning", lambda x: F.md5(x["t"]))),
        F.transform(some(lines, 3, 1), entry("level", lambda x: F.when(x["i"] % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("N"), x["i"].cast("string"))))),
        F.transform(some(lines, 4, 1), entry("englishTermMeaning", lambda x: F.when(x["i"] % 8 == 5, F.lit("")).otherwise(F.concat(F.lit("m"), x["i"].cast("string"))))),
        F.transform(some(lines, 5, 0), entry("nuance", lambda x: F.lit("one's"))),
    )
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.map_from_entries(items).alias("record"))


def numbered_records(spark, sf_dir):
    out = records.numbered_sentences(_records(spark, sf_dir), "doc_id", "record")
    return out.select("doc_id", "pos", "level", F.md5("japanese").alias("digest"), F.col("english") == F.md5("japanese"), "meaning", "nuance").toDF("doc_id", "pos", "level", "digest", "own", "meaning", "nuance")


def record_levels(spark, sf_dir):
    """The level keys of every record."""
    own = records.keys_like(F.col("record"), r"level\d*")
    return _records(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(F.map_keys(own)), ",").alias("keys"), F.size(own).cast("long").alias("n"))


def unique_names(spark, sf_dir):
    named = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    return records.unique_or_error(named, "s_name")


def merge_lists(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 3 <> 0").select("c_custkey", "c_name", F.lit("old").alias("side"))
    new = c.where("c_custkey % 2 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), F.lit("new").alias("side"))
    return records.merged_lists(old, new, "c_custkey", [-F.col("c_custkey")], [F.col("c_custkey")])


def accumulated_labels(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v"), "o_orderstatus")
    out = records.accumulated(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F'"), "k", "v")
    return out.select("k", F.array_join("items", ",").alias("items"), "n_new")


def _fix_ups(spark, sf_dir):
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("/"), k.cast("string")).alias("url"), "p_partkey", "p_name", "p_brand", "p_type")
    docs = p.select("url", F.col("p_name").alias("grammar_point"), F.array(*[F.struct(F.col(c).alias("term"), F.lit(c).alias("kind")) for c in ("p_brand", "p_type")]).alias("false_friends"))
    names = p.where(k % 3 == 0).select("url", F.when(k % 2 == 0, F.col("p_name")).otherwise(F.upper("p_name")).alias("new"))
    terms = p.where(k % 5 == 0).select("url", F.col("p_brand").alias("term"), F.lower("p_brand").alias("new")).unionByName(p.where(k % 7 == 0).select("url", F.col("p_type").alias("term"), F.col("p_type").alias("new")))
    return records.fixed_up(docs, names, terms)


def nested_fixups(spark, sf_dir):
    return _fix_ups(spark, sf_dir)[0].select("url", "grammar_point", F.array_join("false_friends.term", ",").alias("terms"), F.array_join("false_friends.kind", ",").alias("kinds"))


def idle_fixups(spark, sf_dir):
    return _fix_ups(spark, sf_dir)[1]


def source_report(spark, sf_dir):
    """Parts that share a name, and their references to brands, half of which are not in the catalogue."""
    p = table(spark, sf_dir, "part").select("p_name", F.array("p_brand", F.concat(F.lit("no "), "p_brand")).alias("refs"))
    return records.source_report(p, "p_name", "refs", table(spark, sf_dir, "part"), "p_brand")


def checked_meanings(spark, sf_dir):
    """Parts as entries, a third without a meaning of their own; a second table gives it."""
    k = F.col("p_partkey")
    name = F.concat("p_name", F.lit(" "), k.cast("string"))
    p = table(spark, sf_dir, "part")
    docs = p.select(name.alias("grammar_point"), F.when(k % 3 != 0, F.col("p_type")).otherwise(F.lit(" ")).alias("meaning"))
    return lint.checked_meanings(docs, p.where(k % 3 == 0).select(name.alias("name"), F.col("p_brand").alias("meaning")))


def lesson_ranks(spark, sf_dir):
    """Parts as points of two sources: some of one only; the first source gives the lesson's place."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.when(k % 3 != 0, F.concat(F.lit("N"), (F.col("p_size") % 6).cast("string"))).alias("a"),
        F.when((k % 3 == 0) | (k % 2 == 0), F.element_at(F.array(*map(F.lit, ("Basic", "Intermediate", "Advanced"))), (F.col("p_size") % 3 + 1).cast("int"))).alias("b"),
    )
    first, second = rel.level_rank(F.col("a"), {f"N{n}": 5 - n for n in range(6)}), rel.level_rank(F.col("b"), {"Basic": 0, "Intermediate": 3, "Advanced": 5})
    return p.select("p_partkey", rel.combined_rank(first, second).cast("long").alias("rank"), records.lesson_order(F.when(F.col("a").isNotNull(), k), F.col("p_name")).alias("lesson"))


def compliance_rules(spark, sf_dir):
    """Turns of conversations as examples of two terms; words of seven letters or more carry their own label."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))
    marked = F.array_join(F.transform(words, lambda w: F.when(F.length(w) >= 7, F.concat(w, F.lit("ᵍ"), w)).otherwise(w)), " ")
    turns = table(spark, sf_dir, "conversations").where("text is not null")
    second = F.coalesce(F.get(F.filter(words, lambda w: F.length(w) == 9), F.lit(0)), F.lit("none"))
    examples = turns.select(F.concat(F.coalesce("role", F.lit("")), F.lit("/"), second).alias("name"), F.md5("text").alias("japanese"), marked.alias("tokens"))
    token = lambda surface, pos, base: F.struct(surface.alias("surface"), F.lit(pos).alias("pos"), base.alias("base"))
    roles = turns.select(F.col("role").alias("term")).distinct()
    terms = roles.select("term", F.array(token(F.lit("XXX"), "名詞", F.lit("x")), token(F.lit("a"), "動詞", F.upper("term")), token(F.col("term"), "名詞", F.lit("y"))).alias("parts"))
    return records.compliance(examples, terms).select("name", "term", "japanese", F.md5("tokens").alias("digest"), "rule")


def cleaned_values(spark, sf_dir):
    """Whole texts with blanks and odd characters at every line's ends; every fifth is a URL, every seventh blank."""
    k = F.col("doc_id")
    long = F.concat(F.lit(" x："), F.replace("text", F.lit("\n"), F.lit("？  \n\n\n　–a    b’ ")), F.lit("　"))
    raw = F.when(k % 5 == 0, F.concat(F.lit(" http："), "text")).when(k % 7 == 0, F.lit(" \t　")).otherwise(long)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean_value(raw)).alias("digest"))


#: Tokens for the words of a text, and what each macro finds in them, as patterns over the tokens' letters a, b, c, ..
TOKENS = (
    "⌈ˢとᵖprt:case_particleᵇとʳト⌉", "⌈ˢ犬ᵖn:commonᵇ犬ʳイヌ⌉", "⌈ˢ飲むᵖv:general:godan-ma:terminalᵇ飲むʳノム⌉", "⌈ˢてᵖprt:conjunctive_particleᵇてʳテ⌉",
    "⌈ˢ飲んᵖv:general:godan-ma:conjunctiveᵇ飲むʳノン⌉", "⌈ˢ高いᵖadj:general:adjective:terminalᵇ高いʳタカイ⌉", "⌈ˢないᵖadj:non_self_reliant:adjective:terminalᵇないᵈ無いʳナイ⌉",
    "⌈ˢにᵖprt:case_particleᵇにʳニ⌉", "⌈ˢもᵖprt:binding_particleᵇもʳモ⌉", "⌈ˢするᵖv:non_self_reliant:sa-irregular:terminalᵇするᵈ為るʳスル⌉", "⌈ˢですᵖauxvʳデス⌉",
    "⌈ˢましょうᵖauxv:auxv-masu:volitional-presumptiveᵇますᵈますʳマショー⌉", "⌈ˢ飲めᵖv:general:godan-ma:conditionalᵇ飲むʳノメ⌉", "⌈ˢばᵖprt:conjunctive_particleᵇばʳバ⌉",
    "⌈ˢ飲めᵖv:general:godan-ma:imperativeᵇ飲むʳノメ⌉", "⌈ˢ高くᵖadj:general:adjective:conjunctiveᵇ高いᵈ高いʳタカク⌉", "⌈ˢかったᵖadj:general:adjective:stemᵇかったいᵈ固いʳカッタ⌉",
)
FOUND = {
    "to": "a", "i-adjective-past": "[a-q]q", "i-adjective-negative": "pg", "verb-dictionary": "(^|[^d])[cj]", "i-adjective-dictionary": "f", "noun": "b", "ni": "h", "mo": "i", "nai": "g",
    "suru": "j", "desu": "k", "verb-te": "[cejmo]d", "verb-volitional": "l", "verb-eba": "[em]n", "verb-imperative": "o",
}


def matcher_macros(spark, sf_dir):
    """The macros that match the first lines' tokens, and all that match somewhere in the text."""
    words = F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1))
    listed = F.array(*[F.lit(t) for t in TOKENS])
    compact = F.array_join(F.transform(words, lambda w, i: F.get(listed, ((F.length(w) * 5 + i) % len(TOKENS)).cast("int"))), "")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(compact, F.lit("")).alias("compact"))
    found = [F.when(F.col("compact").rlike(matcher.at_tokens(matcher.compile_matcher("{" + m + "}"))), F.lit(m)) for m in sorted(FOUND)]
    return docs.select("doc_id", F.array_join(F.filter(F.array(*found), lambda x: x.isNotNull()), ",").alias("macros"))


N = len(TOKENS)
LETTERS = "".join(chr(ord("a") + i) for i in range(N))
MACRO_SQL = ", ".join(f"case when regexp_matches(s, '{FOUND[m]}') then '{m}' end" for m in sorted(FOUND))
LINES = "l as (select doc_id, unnest(string_split(text, chr(10))) as t, generate_subscripts(string_split(text, chr(10)), 1) as i from documents where text is not null)"
QUERIES = {
    "numbered_records": (numbered_records, f"""with {LINES}, k as (select * from l where i < 12),
      v as (select *, case when i % 3 = 1 then case when i % 2 = 0 then '' else 'N' || i end end as lv, case when i % 4 = 1 then case when i % 8 = 5 then '' else 'm' || i end end as me from k)
      select doc_id, (i - 1)::int as pos, last_value(lv ignore nulls) over w as level, md5(t) as digest, true as own,
        coalesce(me, last_value(nullif(me, '') ignore nulls) over w) as meaning, case when i % 5 = 0 then 'one''s' else '' end as nuance
      from v window w as (partition by doc_id order by i rows between unbounded preceding and current row)"""),
    "record_levels": (record_levels, f"""with {LINES}, k as (select doc_id, 'level' || case when i > 1 then i::varchar else '' end as key from l where i % 3 = 1)
      select doc_id, string_agg(key, ',' order by key) as keys, count(*) as n from k group by 1"""),
    "unique_names": (unique_names, "select s_name, s_nationkey from supplier"),
    "merge_lists": (merge_lists, """with j as (select c_custkey, c_custkey % 2 = 0 as n, c_custkey % 3 <> 0 as o, c_name from customer where c_custkey % 2 = 0 or c_custkey % 3 <> 0)
      select row_number() over (order by not o, case when o then -c_custkey else c_custkey end) - 1 as pos, c_custkey, case when n then upper(c_name) else c_name end as c_name, case when n then 'new' else 'old' end as side from j"""),
    "accumulated_labels": (accumulated_labels, """with d as (select o_custkey as k, o_orderpriority as v, bool_and(o_orderstatus <> 'F') as fresh from orders group by 1, 2)
      select k, string_agg(v, ',' order by v) as items, count_if(fresh)::bigint as n_new from d group by 1"""),
    "nested_fixups": (nested_fixups, """select '/' || p_partkey as url, case when p_partkey % 3 = 0 and p_partkey % 2 <> 0 then upper(p_name) else p_name end as grammar_point,
      case when p_partkey % 5 = 0 then lower(p_brand) else p_brand end || ',' || p_type as terms, 'p_brand,p_type' as kinds from part"""),
    "idle_fixups": (idle_fixups, """select '/' || p_partkey as url, null as term, p_name as new from part where p_partkey % 6 = 0
      union all select '/' || p_partkey, p_type, p_type from part where p_partkey % 7 = 0"""),
    "source_report": (source_report, """select 'duplicate' as problem, p_name as name, count(*) as n from part group by 2 having count(*) > 1
      union all select 'dangling', 'no ' || p_brand, count(*) from part group by 2"""),
    "checked_meanings": (checked_meanings, "select p_name || ' ' || p_partkey as grammar_point, case when p_partkey % 3 = 0 then p_brand else p_type end as meaning from part"),
    "lesson_ranks": (lesson_ranks, """with p as (select *, case when p_partkey % 3 <> 0 then 5 - p_size % 6 end as a, case when p_partkey % 3 = 0 or p_partkey % 2 = 0 then [0, 3, 5][p_size % 3 + 1] end as b from part)
      select p_partkey, (coalesce(a, b) + coalesce(b, a))::bigint as rank, case when a is not null then p_partkey else ('0x' || substr(md5(p_name), 1, 8))::bigint % 10000 end as lesson from p"""),
    "compliance_rules": (compliance_rules, r"""with t as (select *, regexp_extract_all(lower(text), '[a-z]+') as ws from conversations where text is not null),
      e as (select coalesce(role, '') as r, coalesce(list_filter(ws, lambda w: length(w) = 9)[1], 'none') as s, md5(text) as japanese, coalesce(array_to_string(list_transform(ws, lambda w: case when length(w) >= 7 then w || 'ᵍ' || w else w end), ' '), '') as tokens from t),
      f as (select * from e where not contains(tokens, 'ᵍ' || r) and not contains(tokens, 'ᵍ' || s))
      select r || '/' || s as name, r as term, japanese, md5(tokens) as digest, case when r <> '' then '○○|ᵇ' || upper(r) || '|' || r end as rule from f
      union all select r || '/' || s, s, japanese, md5(tokens), null from f"""),
    "cleaned_values": (cleaned_values, r"""with r as (select doc_id, case when doc_id % 5 = 0 then ' http：' || text when doc_id % 7 = 0 then '' else ' x：' || replace(text, chr(10), '？  ' || chr(10) || chr(10) || chr(10) || '　–a    b’ ') || '　' end as t from documents),
      l as (select doc_id, array_to_string(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^[\s\x{0B}\x{85}\x{A0}\x{2028}\x{2029}\x{3000}]+|[\s\x{0B}\x{85}\x{A0}\x{2028}\x{2029}\x{3000}]+$', '', 'g')), chr(10)) as t from r),
      c as (select doc_id, case when starts_with(t, 'http') then t else replace(replace(replace(replace(replace(replace(replace(t, '  ', ' '), chr(10) || chr(10) || chr(10), chr(10) || chr(10)), '　', ' '), '–', '-'), '’', chr(39)), '：', ':'), '？', '?') end as t from l)
      select doc_id, md5(nullif(t, '')) as digest from c"""),
    "matcher_macros": (matcher_macros, rf"""with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '\p{{L}}+') as ws from documents),
      s as (select doc_id, coalesce(array_to_string(list_transform(ws, lambda w, i: substr('{LETTERS}', ((length(w) * 5 + i - 1) % {N} + 1)::int, 1)), ''), '') as s from w)
      select doc_id, array_to_string(list_filter([{MACRO_SQL}], lambda x: x is not null), ',') as macros from s"""),
}
