"""Catalogue documents as JSON: cleaned, checked, pruned and put in order in one projection.

Which references the catalogue knows comes from a join on the references, so the
names are never collected; each document gets those of its own references that exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import compiled, lint, text

_STRINGS = {"type": "array", "items": {"type": "string"}}
SCHEMA = {
    "definitions": {
        "grammarType": {"type": "string"}, "knownGrammarType": {"$ref": "#/definitions/grammarType"}, "japanese": {"type": "string"}, "exampleEnglish": {"type": "string"},
        "level": {"type": "string", "enum": list(lint.LEVELS)}, "kind": {"type": "string", "enum": list(lint.KINDS)},
    },
    "type": "object",
    "properties": {
        "id": {"type": "string"}, "grammar_point": {"type": "string"}, "better_grammar_point_name": _STRINGS, "split_predecessor": {"type": "string"}, "learn_before": _STRINGS,
        "jlpt": {"$ref": "#/definitions/level"}, "meaning": {"type": "string"}, "meaning_warning": {"type": "string"}, "matcher": {"type": "string"},
        "matcher_enforce_examples": {"type": "boolean"}, "writeup": {"type": "string"},
        "examples": {"type": "array", "items": {"type": "object", "properties": {
            "japanese": {"type": "array", "items": {"$ref": "#/definitions/japanese"}}, "english": {"$ref": "#/definitions/exampleEnglish"}, "register": {"type": "string"},
            "competing_grammar": {"type": "array", "items": {"type": "object", "properties": {
                "competing_japanese": {"type": "array", "items": {"$ref": "#/definitions/japanese"}}, "english": {"$ref": "#/definitions/exampleEnglish"},
            }}},
        }}},
        "false_friends": {"type": "array", "items": {"type": "object", "properties": {
            "term": {"type": "string"}, "meaning": {"type": "string"}, "kind": {"$ref": "#/definitions/kind"}, "grammar_point": {"$ref": "#/definitions/grammarType"},
        }}},
    },
}
LINT = "lint-errors"


def _bare(name: Column) -> Column:
    """A reference without its mark."""
    return text.trim_space(F.regexp_replace(text.trim_space(name), "^<(strongly-)?suggest>:", ""))


def with_known(docs: DataFrame, key: str, document: str, names: DataFrame, name: str) -> DataFrame:
    """Add ``_known``: the references of each document (better names, predecessors, false friends) that the names hold."""
    none = F.array().cast("array<string>")
    d = F.col(document)
    refs = F.concat(F.coalesce(d["better_grammar_point_name"], none), F.coalesce(d["learn_before"], none), F.coalesce(F.transform(d["false_friends"], lambda f: f["grammar_point"]), none))
    each = docs.select(F.col(key).alias("_k"), F.explode(F.array_distinct(F.transform(refs, lambda r: _bare(text.strip_quotes(r))))).alias("_ref"))
    held = each.join(names.select(F.col(name).alias("_ref")).distinct(), "_ref", "left_semi").groupBy("_k").agg(F.collect_set("_ref").alias("_known"))  # a document's own references
    return docs.join(held, F.col(key) == F.col("_k"), "left").drop("_k").withColumn("_known", F.coalesce("_known", none))


def steps(known: Column) -> dict:
    """What happens to the values of each type."""
    trimmed = text.trim_space
    is_known = lambda n: F.array_contains(known, _bare(n))

    def reference(n: Column) -> Column:
        own = text.strip_quotes(trimmed(n))
        return F.when(own.startswith("<strongly-suggest>:"), own).when(is_known(own), _bare(own)).otherwise(F.concat(F.lit("<suggest>:"), _bare(own)))

    def root(d: Column) -> Column:
        better = F.filter(d["better_grammar_point_name"], lambda n: ~F.array_contains(known, n))
        d = d.withField("better_grammar_point_name", F.when(F.size(better) > 0, better))
        return d.withField("learn_before", F.array_sort(F.array_distinct(F.filter(d["learn_before"], lambda n: n.isNotNull()))))

    plain = {f"{p}/string": trimmed for p in ("id", "grammar_point", "meaning", "meaning_warning", "matcher", "writeup", "split_predecessor", "learn_before", "better_grammar_point_name", "examples/register", "false_friends/term", "false_friends/meaning")}
    return plain | {
        None: root, "grammarType": reference, "level": trimmed, "kind": trimmed,
        "japanese": lambda s: text.normal_japanese(text.strip_quotes(trimmed(s))), "exampleEnglish": lambda s: text.strip_quotes(trimmed(s)),
    }


def clean(docs: DataFrame, key: str, json: str, names: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """key, document (JSON) and ``lint-errors`` of JSON documents; a text that is no JSON object gives null.

    The order is that of the editor's own pass: id and name from the file name (column
    ``path``), old messages dropped, single strings promoted, values cleaned, rules and
    enums checked, empty parts pruned, keys in the schema's order, others behind them.
    """
    kind = compiled.struct_type(SCHEMA)
    own = docs.withColumn("_doc", compiled.parsed(F.col(json), SCHEMA)).withColumn("_more", F.map_filter(compiled.others(F.col(json), SCHEMA), lambda k, _: k != LINT))
    if path is not None:
        stem = lint.key_from_name(F.substring_index(path, "/", -1))
        own = own.withColumn("_doc", F.col("_doc").withField("id", stem["id"]).withField("grammar_point", stem["grammar_point"]))
    own = with_known(own, key, "_doc", names, name)
    own = own.withColumn("_doc", compiled.visited(F.col("_doc"), SCHEMA, steps(F.col("_known"))))
    flat = own.select(key, "_doc", "_more", "_known", "_doc.*")
    rules = dict(lint.RULES) | {"unknown": lambda: lint.unknown_references("_known"), "split": lint.split_predecessor}
    rules.pop("enums")  # the schema has them
    found = [F.coalesce(rule(), F.array().cast("array<string>")) for rule in rules.values()]
    checked = flat.withColumn(LINT, F.concat(*found, compiled.enum_errors(F.col("_doc"), SCHEMA)))
    told = T.StructType([*kind.fields, T.StructField(LINT, T.ArrayType(T.StringType()))])
    whole = lint.pruned(F.col("_doc").withField(f"`{LINT}`", F.col(LINT)), told)
    return checked.select(key, F.when(F.col("_doc").isNotNull(), compiled.to_json(whole, F.map_filter("_more", lambda _, v: ~v.isin("", "null", "[]", "{}")))).alias("document"), F.col(LINT))
