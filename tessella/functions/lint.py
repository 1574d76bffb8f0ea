"""Validation of catalogue documents: cleaning steps and a registry of rules over a document table.

Documents have the columns of :data:`DOCUMENT`; a rule is a Column that gives an
array of messages (possibly empty). ``lint`` adds their concatenation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text

DOCUMENT = """
grammar_point string, matcher string, matcher_enforce_examples boolean, better_grammar_point_name array<string>, learn_before array<string>,
id string, meaning string, meaning_warning string, jlpt string, writeup string,
false_friends array<struct<term:string,meaning:string,kind:string,grammar_point:string>>,
examples array<struct<english:string,japanese:array<string>,competing_grammar:array<struct<competing_japanese:array<string>,english:string>>,register:string>>
"""
# Allowed values of enumerated fields.
KINDS = ("synonym", "antonym")
LEVELS = ("N0", "N1", "N2", "N3", "N4", "N5")
BRACKETS = (("(", ")"), ("[", "]"), ("{", "}"), ("<", ">"))
LEAST_EXAMPLES, LEAST_VARIANTS = 10, 2


def _each(items: str, rule) -> Column:
    """Messages over an array's items; ``rule`` gets the item and its path."""
    path = lambda i: F.concat(F.lit(f"{items}["), i.cast("string"), F.lit("]"))
    made = F.transform(F.coalesce(F.col(items), F.expr(f"filter({items}, x -> false)")), lambda x, i: rule(x, path(i)))
    return F.filter(F.coalesce(made, F.array().cast("array<string>")), lambda m: m.isNotNull())


def _if(condition: Column, message: Column | str) -> Column:
    own = F.lit(message) if isinstance(message, str) else message
    return F.filter(F.array(F.when(F.coalesce(condition, F.lit(False)), own)), lambda m: m.isNotNull())


def quotes() -> Column:
    return _each("examples", lambda x, p: F.when(x["english"].contains('"'), F.concat(F.lit("[rule-1] warning "), p, F.lit('.english contains a double quote: "'), x["english"])))


def brackets() -> Column:
    def found(x: Column, p: Column) -> Column:
        first = reduce(lambda c, b: c.when(x["english"].contains(b[0]) | x["english"].contains(b[1]), F.lit("".join(b))), BRACKETS[1:], F.when(x["english"].contains(BRACKETS[0][0]) | x["english"].contains(BRACKETS[0][1]), F.lit("".join(BRACKETS[0]))))
        return F.when(first.isNotNull(), F.concat(F.lit("[rule-4] warning "), p, F.lit(".english contains "), first))

    return _each("examples", found)


def missing_competing() -> Column:
    return _each("examples", lambda x, p: F.when(F.coalesce(F.size(x["competing_grammar"]), F.lit(0)) < 1, F.concat(F.lit("[rule-4] warning "), p, F.lit(" has no competing_grammar"))))


def example_count() -> Column:
    return _if(F.size("examples") < LEAST_EXAMPLES, F.concat(F.lit("[rule-6] warning examples has "), F.size("examples").cast("string"), F.lit(f" items, fewer than {LEAST_EXAMPLES}")))


def competing_count() -> Column:
    empty = lambda x: F.exists(x["competing_grammar"], lambda c: F.coalesce(F.size(c["competing_japanese"]), F.lit(0)) < 1)
    return _each("examples", lambda x, p: F.when(empty(x), F.concat(F.lit("warning "), p, F.lit(".competing_grammar has an item without sentences"))))


def japanese_count() -> Column:
    return _each("examples", lambda x, p: F.when(F.size(x["japanese"]) < LEAST_VARIANTS, F.concat(F.lit("[rule-7] warning "), p, F.lit(f".japanese has fewer than {LEAST_VARIANTS} variants"))))


def better_name() -> Column:
    better = F.col("better_grammar_point_name")
    same = (F.size(better) == 1) & (F.get(better, F.lit(0)) == F.col("grammar_point"))
    known = text.meaning(F.col("grammar_point")).isNotNull() | F.coalesce(F.exists(better, lambda n: text.meaning(n).isNotNull()), F.lit(False))
    return F.concat(_if(same, "[rule-14] warning better name equals the name"), _if(~known, "[rule-8] warning no name has a (meaning)"))


def required() -> Column:
    return _if(F.col("meaning").isNull() | (F.trim("meaning") == ""), "error meaning is required")


def name_meaning() -> Column:
    own = text.meaning(F.col("grammar_point"))
    return F.concat(_if(own.isNull(), "[rule-8] warning the name has no (meaning)"), _if(own.isNotNull() & ~text.meaning_start_ok(own), "[rule-9] warning the meaning starts with a capital"))


def friend_reference() -> Column:
    return _each("false_friends", lambda x, p: F.when(F.trim(F.coalesce(x["grammar_point"], F.lit(""))) == "", F.concat(F.lit("[rule-12] warning "), p, F.lit(" has no grammar_point"))))


def special_characters() -> Column:
    return _each("false_friends", lambda x, p: F.when(text.without_suggestion(x["grammar_point"]).rlike("[/:]"), F.concat(F.lit("[rule-14] warning "), p, F.lit(".grammar_point has an illegal character"))))


def enums() -> Column:
    level = _if(~F.col("jlpt").isin(*LEVELS), F.concat(F.lit("error jlpt: "), F.col("jlpt"), F.lit(" is not allowed")))
    kind = _each("false_friends", lambda x, p: F.when(~x["kind"].isin(*KINDS), F.concat(F.lit("error "), p, F.lit(".kind: "), x["kind"], F.lit(" is not allowed"))))
    return F.concat(level, kind)


def unknown_references(names: str) -> Column:
    """Strongly suggested references; ``names`` is an array column of catalogue names."""
    unknown = lambda n: n.isNotNull() & ~n.startswith("<suggest>:") & ~F.array_contains(F.col(names), n)
    return _each("false_friends", lambda x, p: F.when(unknown(x["grammar_point"]), F.concat(F.lit("[rule-13] warning "), p, F.lit(".grammar_point is unknown: "), x["grammar_point"])))


RULES = {
    "quotes": quotes, "brackets": brackets, "missing_competing": missing_competing, "example_count": example_count, "competing_count": competing_count,
    "japanese_count": japanese_count, "better_name": better_name, "required": required, "name_meaning": name_meaning, "friend_reference": friend_reference,
    "special_characters": special_characters, "enums": enums,
}


def lint(docs: DataFrame, rules: dict | None = None, column: str = "lint-errors") -> DataFrame:
    """Add the messages of all rules, in their order."""
    return docs.withColumn(column, F.concat(*[rule() for rule in (rules or RULES).values()]))


def clean(docs: DataFrame) -> DataFrame:
    """Quotes stripped, characters and space normalised, references sorted and distinct, empty values null. Idempotent."""
    japanese = lambda a: F.transform(a, lambda s: text.normal_japanese(text.strip_quotes(text.trim_space(s))))
    examples = F.transform("examples", lambda x: x.withField("english", text.strip_quotes(text.trim_space(x["english"]))).withField("japanese", japanese(x["japanese"])))
    blank = lambda c: F.when(~F.lower(F.trim(c)).isin("", "null"), F.col(c))
    strings = [f.name for f in docs.schema.fields if f.dataType.simpleString() == "string"]
    arrays = [f.name for f in docs.schema.fields if f.dataType.simpleString().startswith("array")]
    out = docs.withColumn("examples", examples).withColumn("learn_before", F.array_sort(F.array_distinct(F.filter("learn_before", lambda x: x != ""))))
    out = out.withColumns({s: blank(s) for s in strings})
    return out.withColumns({a: F.when(F.size(a) > 0, F.col(a)) for a in arrays})


def pruned(column: Column, kind: T.DataType) -> Column:
    """The value of a type without empty parts ("", "null", empty arrays, maps and structs), inmost first; null if nothing is left."""
    if isinstance(kind, T.StringType):
        return F.when(~column.isin("", "null"), column)
    if isinstance(kind, T.ArrayType):
        kept = F.filter(F.transform(column, lambda x: pruned(x, kind.elementType)), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(kind, T.MapType):
        kept = F.map_filter(F.transform_values(column, lambda _, v: pruned(v, kind.valueType)), lambda _, v: v.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(kind, T.StructType):
        parts = [pruned(column[f.name], f.dataType) for f in kind.fields]
        some = reduce(lambda a, b: a | b, [p.isNotNull() for p in parts])
        return F.when(some, F.struct(*[p.alias(f.name) for p, f in zip(parts, kind.fields, strict=True)]))
    return column


def in_schema_order(docs: DataFrame, names: list[str]) -> DataFrame:
    """Columns in the order of a schema's names, others behind them."""
    return docs.select(*[n for n in names if n in docs.columns], *[c for c in docs.columns if c not in names])


def _nested(items: str, rule) -> Column:
    """Messages of a rule that gives an array of them for each item."""
    path = lambda i: F.concat(F.lit(f"{items}["), i.cast("string"), F.lit("]"))
    made = F.flatten(F.filter(F.transform(F.col(items), lambda x, i: rule(x, path(i))), lambda m: m.isNotNull()))
    return F.filter(F.coalesce(made, F.array().cast("array<string>")), lambda m: m.isNotNull())


def competing_matches(pattern: str = "matcher_regex") -> Column:
    """Competing sentences (compact) that the document's own matcher, a column of compiled expressions, finds."""
    def of_example(x: Column, p: Column) -> Column:
        def of_group(g: Column, i: Column) -> Column:
            where = F.concat(p, F.lit(".competing_grammar["), i.cast("string"), F.lit("].competing_japanese["))
            return F.transform(g["competing_japanese"], lambda s, j: F.when(F.rlike(s, F.col(pattern)), F.concat(F.lit("[rule-17] error "), where, j.cast("string"), F.lit("] matches the document's own matcher: "), s)))

        return F.flatten(F.filter(F.transform(x["competing_grammar"], of_group), lambda g: g.isNotNull()))

    return _nested("examples", of_example)


def example_mismatches(pattern: str = "matcher_regex") -> Column:
    """Own sentences (compact) that the matcher does not find, where the document enforces it."""
    def of_example(x: Column, p: Column) -> Column:
        unlike = lambda s: F.col("matcher_enforce_examples") & ~F.rlike(s, F.col(pattern))
        return F.transform(x["japanese"], lambda s, j: F.when(unlike(s), F.concat(F.lit("[rule-18] error "), p, F.lit(".japanese["), j.cast("string"), F.lit("] does not match the document's matcher: "), s)))

    return _nested("examples", of_example)


def training_sentences(docs: DataFrame, pattern: str = "matcher_regex") -> DataFrame:
    """grammar_point, sentence, positive, as_expected of compact own and competing sentences; braces go.

    ``as_expected`` is null without a matcher.
    """
    bare = lambda a: F.transform(a, lambda s: F.translate(s, "{}", ""))
    each = docs.select("grammar_point", pattern, F.explode("examples").alias("x"))
    own = each.select("grammar_point", pattern, F.explode(bare("x.japanese")).alias("sentence"), F.lit(True).alias("positive"))
    rival = each.select("grammar_point", pattern, F.explode("x.competing_grammar").alias("c"))
    rival = rival.select("grammar_point", pattern, F.explode(bare("c.competing_japanese")).alias("sentence"), F.lit(False).alias("positive"))
    found = F.rlike(F.col("sentence"), F.col(pattern))
    return own.unionByName(rival).withColumn("as_expected", found == F.col("positive")).drop(pattern)


def augmented(sentences: DataFrame, matchers: dict[str, str]) -> DataFrame:
    """sentence and its sorted labels: of rows that hold it positively, and of matchers (name to expression) that find it.

    A sentence with negative rows only becomes positive where a matcher finds it;
    otherwise it has an empty array.
    """
    held = sentences.groupBy("sentence").agg(F.collect_set(F.when(F.col("positive"), F.col("grammar_point"))).alias("own"))
    found = F.filter(F.array(*[F.when(F.col("sentence").rlike(p), F.lit(n)) for n, p in matchers.items()]).cast("array<string>"), lambda x: x.isNotNull())
    return held.select("sentence", F.array_sort(F.array_union("own", found)).alias("labels"))


def checked_meanings(docs: DataFrame, meanings: DataFrame) -> DataFrame:
    """Documents with the meanings of (name, meaning) put in; a blank meaning that is left, or an unused name, raises an error."""
    table = meanings.select(F.col("name").alias("_name"), F.col("meaning").alias("_meaning"))
    joined = docs.withColumn("_doc", F.lit(True)).join(table, F.col("grammar_point") == F.col("_name"), "full_outer")
    joined = joined.withColumn("meaning", F.coalesce("_meaning", "meaning"))
    fault = F.when(F.col("_doc").isNull(), F.concat(F.lit("unused meaning: "), F.col("_name"))).when(
        F.coalesce(F.trim("meaning"), F.lit("")) == "", F.concat(F.lit("blank meaning: "), F.coalesce("grammar_point", F.lit("")))
    )
    return joined.where(F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(fault).cast("boolean"))).drop("_doc", "_name", "_meaning")


def split_predecessor() -> Column:
    """Documents that still name the one they were split from."""
    return _if(F.col("split_predecessor").isNotNull(), "[rule-18] warning split_predecessor is present")


def promote(column: Column) -> Column:
    """A single string as an array of one."""
    return F.when(column.isNotNull(), F.array(column))


def key_from_name(name: Column) -> Column:
    """id and grammar_point of a file name ``id-name.ext``."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.struct(F.regexp_extract(stem, "^([^-]*)-(.*)$", 1).alias("id"), F.regexp_extract(stem, "^([^-]*)-(.*)$", 2).alias("grammar_point"))
