"""Catalogue records: numbered keys to rows, ordered upserts, accumulated labels, nested fix-ups, reports.

Defined cases: null values of a record's keys count as blank where the key is
present; a null key of a table is a key of its own; empty tables give empty
tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import numbered

# Fixed value: the tagger's name of verbs.
VERB = "動詞"


def keys_like(record: Column, pattern: str) -> Column:
    """The entries of a map whose whole key matches a pattern."""
    return F.map_filter(record, lambda k, _: k.rlike(f"^(?:{pattern})$"))


def numbered_sentences(rows: DataFrame, key: str, record: str) -> DataFrame:
    """key, pos, level, japanese, english, meaning, nuance of a map with numbered keys (``level``, ``level2``, ..).

    Sentences run up to the first number without ``japaneseSentence``. A level holds for the sentences that
    follow, a blank one ends it. A term meaning holds too, but a blank one counts for its own sentence only.
    A sentence without a translation, a record without a term meaning and a nuance with several single quotes
    raise an error. ``key`` is unique.
    """
    held = F.col(record)
    sentences = F.map_keys(keys_like(held, r"japaneseSentence\d*"))
    places = rows.select(key, record, F.posexplode(F.sequence(F.lit(1), F.size(sentences) + 1)).alias("_p", "_i"))
    name = lambda base: F.when(F.col("_i") == 1, F.lit(base)).otherwise(F.concat(F.lit(base), F.col("_i").cast("string")))
    value = lambda base: F.when(F.map_contains_key(held, name(base)), F.coalesce(F.try_element_at(held, name(base)), F.lit("")))
    each = places.select(
        key, F.col("_p").alias("pos"), value("level").alias("_level"), value("japaneseSentence").alias("japanese"), value("englishSentenceMeaning").alias("english"),
        value("englishTermMeaning").alias("_meaning"), F.coalesce(value("nuance"), F.lit("")).alias("nuance"), F.map_contains_key(held, F.lit("englishTermMeaning")).alias("_whole"),
    )
    upto = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last(F.when(F.col("_meaning") != "", F.col("_meaning")), ignorenulls=True).over(upto)
    out = each.withColumns({
        "_open": F.min(F.col("japanese").isNotNull()).over(upto), "level": F.coalesce(F.last("_level", ignorenulls=True).over(upto), F.lit("")),
        "meaning": F.coalesce("_meaning", carried, F.lit("")),
    }).where("_open")
    fault = (
        F.when(~F.col("_whole"), F.lit("a record lacks its term meaning")).when(F.col("english").isNull(), F.concat(F.lit("no translation: "), F.col("japanese")))
        .when(F.regexp_count("nuance", F.lit("'")) > 1, F.concat(F.lit("more than one single quote: "), F.col("nuance")))
    )
    sound = out.where(F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(fault).cast("boolean")))
    return sound.select(key, "pos", "level", "japanese", "english", "meaning", "nuance")


def unique_or_error(rows: DataFrame, key: str) -> DataFrame:
    """The rows; a value of ``key`` that two rows have raises an error when they are read."""
    # The condition reads the count, so that it stays above the aggregation.
    told = F.raise_error(F.concat(F.lit(f"duplicate {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")
    failed = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.when(F.col("_n") > 1, told).otherwise(F.lit(False)))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != key]
    return rows.unionByName(failed.select(key, *none))


def merged_lists(old: DataFrame, new: DataFrame, key: str, old_order: Sequence[Column], new_order: Sequence[Column]) -> DataFrame:
    """``pos`` and the rows of two lists with unique keys: a row of ``new`` takes the place of the ``old`` row with its key, other new rows follow."""
    at = [F.struct(*order) for order in (old_order, new_order)]
    a = old.select(F.col(key).alias("_a"), at[0].alias("_old_at"), F.struct(*old.columns).alias("_old"))
    b = new.select(F.col(key).alias("_b"), at[1].alias("_new_at"), F.struct(*[F.col(c) for c in old.columns]).alias("_new"))
    both = a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "full_outer")
    placed = numbered(both, [F.col("_old_at").isNull(), F.col("_old_at"), F.col("_new_at")], "pos")
    return placed.select("pos", F.when(F.col("_new_at").isNotNull(), F.col("_new")).otherwise(F.col("_old")).alias("r")).select("pos", "r.*")


def accumulated(table: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, the sorted distinct values of both tables, and how many of them the first table lacked."""
    each = table.select(key, value, F.lit(False).alias("_new")).unionByName(rows.select(key, value, F.lit(True).alias("_new")))
    once = each.groupBy(key, value).agg(F.min("_new").alias("_new"))
    return once.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("items"), F.count_if(F.col("_new") & F.col(value).isNotNull()).alias("n_new"))


def fixed_up(docs: DataFrame, names: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with the fix-ups put in, and the fix-ups that change nothing as (url, term, new).

    ``docs`` have url, grammar_point and false_friends (array of structs with a term); ``names`` are (url, new)
    with unique urls, ``terms`` (url, term, new) with unique pairs. An unused term whose document lacks it, or a
    url that no document has, is no error: a fix-up file serves many documents.
    """
    by_url = terms.groupBy(F.col("url").alias("_t")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "new")))).alias("_terms"))
    named = names.select(F.col("url").alias("_n"), F.col("new").alias("_name"))
    joined = docs.join(named, F.col("url") == F.col("_n"), "left").join(by_url, F.col("url") == F.col("_t"), "left")
    new = lambda f: F.try_element_at("_terms", f["term"])
    friends = F.transform("false_friends", lambda f: f.withField("term", F.coalesce(new(f), f["term"])))
    fixed = joined.withColumns({"_friends": friends, "_point": F.coalesce("_name", "grammar_point")})
    kept = [F.col({"false_friends": "_friends", "grammar_point": "_point"}.get(c, c)).alias(c) for c in docs.columns]
    idle = joined.where(F.col("_name") == F.col("grammar_point")).select("url", F.lit(None).cast("string").alias("term"), F.col("_name").alias("new"))
    same = joined.select("url", F.explode("false_friends").alias("f"), "_terms").where(new(F.col("f")) == F.col("f.term")).select("url", "f.term", F.col("f.term").alias("new"))
    return fixed.select(*kept), idle.unionByName(same.distinct())


def source_report(rows: DataFrame, key: str, references: str, catalog: DataFrame, catalog_key: str) -> DataFrame:
    """problem, name and n: names that several rows have, and references (an array) to names that the catalogue lacks. Rows mean a failed check."""
    twice = rows.groupBy(F.col(key).alias("name")).agg(F.count("*").alias("n")).where("n > 1")
    asked = rows.select(F.explode(references).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    absent = asked.join(catalog.select(F.col(catalog_key).alias("_k")).distinct(), F.col("name") == F.col("_k"), "left_anti")
    return twice.select(F.lit("duplicate").alias("problem"), "name", "n").unionByName(absent.select(F.lit("dangling").alias("problem"), "name", "n"))


def lesson_order(own: Column, name: Column) -> Column:
    """A lesson's own place; without one a number below 10000 that depends on its name only."""
    return F.coalesce(own.cast("long"), F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") % 10000)


def rule_of(tokens: Column) -> Column:
    """The sequence rule that finds a term's tokens (surface, pos, base): base forms of verbs, surfaces of others; XXX stands for a gap."""
    part = lambda t: F.when(t["pos"] == VERB, F.concat(F.lit("ᵇ"), t["base"])).otherwise(t["surface"])
    return F.replace(F.array_join(F.transform(tokens, part), "|"), F.lit("XXX"), F.lit("○○"))


def compliance(examples: DataFrame, terms: DataFrame) -> DataFrame:
    """name, term, japanese, tokens and a proposed rule for every example whose tokens carry none of its point's labels.

    ``examples`` are (name, japanese, tokens) with the terms of a name between slashes; ``terms`` are (term, parts)
    with the tokens of each term, unique by term. A term without tokens has no rule.
    """
    own = F.split("name", "/")
    labelled = F.exists(own, lambda t: F.coalesce(F.col("tokens"), F.lit("")).contains(F.concat(F.lit("ᵍ"), t)))
    failing = examples.where(~labelled).select("name", "japanese", "tokens", F.explode(own).alias("term"))
    rules = terms.select(F.col("term").alias("_t"), rule_of(F.col("parts")).alias("rule"))
    return failing.join(rules, F.col("term") == F.col("_t"), "left").drop("_t")
