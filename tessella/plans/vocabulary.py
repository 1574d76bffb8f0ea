"""Queries on dictionary entries, word annotation and keys, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import vocabulary
from .tables import table

WORDS = r"\p{L}+"


def _entries(spark, sf_dir):
    """Every word of the benchmark as an entry: itself marked as reading, itself and the word without its end as senses."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(f"({WORDS})"), F.lit(1))).alias("w"))
    word = F.lower("w")
    return words.select(word.alias("word")).distinct().select("word", F.concat(F.lit("r-"), "word").alias("reading"), F.array("word", F.concat(F.lit("to xx "), F.col("word"), F.lit(" (rare), no "), F.col("word"))).alias("senses"))


def dictionary_index(spark, sf_dir):
    return vocabulary.dictionary_index(_entries(spark, sf_dir)).select("key", F.array_join("senses", ";").alias("senses"))


def annotated_words(spark, sf_dir):
    """The whole texts of documents, their own words as the tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.lower("text").alias("low"))
    words = F.regexp_extract_all("low", F.lit(f"({WORDS})"), F.lit(1))
    keyed = docs.select("doc_id", "text", F.transform(words, lambda w: F.concat(w, F.lit("|r-"), w)).alias("keys"))
    out = vocabulary.annotated(keyed, "doc_id", "text", "keys", vocabulary.dictionary_index(_entries(spark, sf_dir)))
    marks = F.size(F.regexp_extract_all("annotated", F.lit(r"\[([^\]|]*\|[^\]]*)\]"), F.lit(1)))
    return out.select("doc_id", marks.cast("long").alias("n_marks"), F.md5("annotated").alias("digest"))


def spaced_tokens(spark, sf_dir):
    """Turns of conversations as tokens: letters and digits as words, everything else as symbols."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.regexp_extract_all("text", F.lit(r"([a-zA-Z0-9]+|[^a-zA-Z0-9 ])"), F.lit(1)).alias("t"))
    tokens = F.transform("t", lambda s: F.struct(s.alias("surface"), F.when(s.rlike("^[a-zA-Z0-9]"), "名詞").otherwise(vocabulary.SYMBOL).alias("pos")))
    return turns.select("conv_id", "turn", F.md5(vocabulary.spaced(tokens)).alias("digest"))


def single_quotes(spark, sf_dir):
    quotes = F.expr("repeat(\"'\", int(p_partkey % 4))")
    return table(spark, sf_dir, "part").select("p_partkey", text.strip_single_quotes(F.concat(F.lit(" "), quotes, "p_name", quotes)).alias("name"))


def split_keys(spark, sf_dir):
    key = F.when(F.col("p_size") % 2 == 0, F.concat_ws("|", "p_brand", "p_type", "p_name")).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", text.split_key(key).alias("k")).select("p_partkey", "k.name", "k.source")


def resolved_meanings(spark, sf_dir):
    """Customers and suppliers of one number as two sources."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_nationkey").cast("string")).alias("a"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").cast("string").alias("b"))
    out = c.join(s, "k", "left").select("k", text.resolved_meaning(F.col("a"), F.col("b"), ("first", "second")).alias("m"))
    return out.select("k", *[F.try_element_at("m", F.lit(n)).alias(n) for n in ("meaning", "first", "second")])


def constraint_violations(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_size") % 10 == 0, F.lit(" ")).when(F.col("p_size") % 10 > 1, F.col("p_type")).alias("kind"))
    return vocabulary.constraint_violations(p, "p_partkey", ["p_name"], ["kind"])


ENTRIES = f"""e as (select distinct lower(unnest(regexp_extract_all(text, '{WORDS}'))) as w from benchmark)"""
QUERIES = {
    # A sense that starts with "to " loses three characters in each part: "no w" gives "w".
    "dictionary_index": (dictionary_index, f"""with {ENTRIES}, k as (select w, unnest([w || '|r-' || w, 'r-' || w || '|r-' || w]) as key from e),
      p as (select distinct key, unnest([w, 'xx ' || w]) as sense from k) select key, string_agg(sense, ';' order by sense) as senses from p group by key"""),
    "annotated_words": (annotated_words, f"""with {ENTRIES}, d as (select doc_id, text, regexp_extract_all(text, '(\\s+|[^\\p{{L}}\\p{{N}}_\\s]|[\\p{{L}}\\p{{N}}_]+)') as t from documents),
      t as (select doc_id, unnest(t) as w, generate_subscripts(t, 1) as i from d),
      m as (select distinct doc_id, lower(unnest(regexp_extract_all(text, '{WORDS}'))) as w from documents), k as (select m.doc_id, m.w from m join e on m.w = e.w),
      j as (select t.doc_id, t.w, i, coalesce(a.w, b.w, c.w) as r from t left join k a on t.doc_id = a.doc_id and lower(t.w) = a.w
        left join k b on t.doc_id = b.doc_id and lower(t.w) like '%s' and substr(lower(t.w), 1, length(t.w) - 1) = b.w
        left join k c on t.doc_id = c.doc_id and lower(t.w) like '%ing' and substr(lower(t.w), 1, length(t.w) - 3) = c.w),
      g as (select doc_id, count(r) as n_marks, md5(string_agg(w || case when r is null then '' else '[' || r || '|r-' || r || ']' end, '' order by i)) as digest from j group by 1)
      select doc_id, coalesce(n_marks, 0) as n_marks, case when text is not null then coalesce(digest, md5('')) end as digest from documents left join g using (doc_id)"""),
    "spaced_tokens": (spaced_tokens, """select conv_id, turn, md5(trim(regexp_replace(regexp_replace(array_to_string(regexp_extract_all(text, '([a-zA-Z0-9]+|[^a-zA-Z0-9 ])'), ' '), ' +([^a-zA-Z0-9 ])', '\\1', 'g'), '([^a-zA-Z0-9 ]) +', '\\1', 'g'))) as digest from conversations"""),
    "single_quotes": (single_quotes, "select p_partkey, case when p_partkey % 4 = 3 then '''' || p_name || '''' else p_name end as name from part"),
    "split_keys": (split_keys, "select p_partkey, p_brand as name, case when p_size % 2 = 0 then p_type || '|' || p_name end as source from part"),
    "resolved_meanings": (resolved_meanings, """with j as (select c_custkey as k, case when c_custkey % 5 > 0 then c_nationkey::varchar end as a, s_nationkey::varchar as b from customer left join supplier on c_custkey = s_suppkey)
      select k, case when a = b or a is null or b is null then coalesce(a, b) end as meaning, case when a <> b then a end as first, case when a <> b then b end as second from j"""),
    "constraint_violations": (constraint_violations, """select 'p_name' as column, 'duplicate' as problem, p_name as value, min(p_partkey) as first, count(*) as n from part group by p_name having count(*) > 1
      union all select 'kind', 'missing', null, min(p_partkey), count(*) from part where p_size % 10 < 2 having count(*) > 0"""),
}
