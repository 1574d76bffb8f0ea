"""Dictionary index and annotation of English words with the readings of a sentence's words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

# Fixed value: the part of speech of symbols.
SYMBOL = "補助記号"


def spaced(tokens: Column) -> Column:
    """Surfaces of tokens (surface, pos) joined by spaces; symbols and spaces stand tight on both sides."""

    def add(sofar: Column, token: Column) -> Column:
        tight = (token["surface"] == " ") | (token["pos"] == SYMBOL)
        return F.when(tight, F.concat(F.trim(sofar), token["surface"])).otherwise(F.concat(sofar, token["surface"], F.lit(" ")))

    return tx.trim_space(F.aggregate(tokens, F.lit(""), add))


def dictionary_index(entries: DataFrame) -> DataFrame:
    """key and its distinct senses, sorted, of entries (word, reading, senses).

    Every entry counts under its own key and under its reading's; blank keys go, and so do null words, readings and senses.
    """
    word, reading = F.col("word"), F.col("reading")
    keys = F.array(tx.dictionary_key(word, reading), tx.dictionary_key(reading, reading))
    each = entries.where("word is not null and reading is not null").select(F.explode(keys).alias("key"), "senses")
    senses = each.where(tx.trim_space(F.col("key")) != "").select("key", F.explode("senses").alias("sense")).where("sense is not null")
    parts = senses.select("key", F.explode(tx.sense_parts(F.col("sense"))).alias("sense")).distinct()
    return parts.groupBy("key").agg(F.array_sort(F.collect_list("sense")).alias("senses"))


def annotated(rows: DataFrame, doc: str, english: str, keys: str, index: DataFrame) -> DataFrame:
    """``doc`` and ``annotated``: its English words, each followed by the [key] of the last token that has it as a sense.

    ``keys`` holds the dictionary keys of the sentence's tokens in their order. A word without a sense is looked up
    without a final ``s`` or, if it has none, without a final ``ing``. Null English gives null; ids must be unique.
    """
    # The last token of a key is the first from behind; a document's keys and words stay with it, and only its different keys are joined.
    tokens = rows.select(F.col(doc).alias("_doc"), F.posexplode(F.array_distinct(F.reverse(keys))).alias("_at", "_key"))
    senses = tokens.join(index.select(F.col("key").alias("_key"), "senses"), "_key").select("_doc", "_at", "_key", F.explode("senses").alias("_sense"))
    last = senses.groupBy("_doc", "_sense").agg(F.min_by("_key", "_at").alias("_key"))
    held = last.groupBy("_doc").agg(F.collect_list(F.struct("_sense", "_key")).alias("_found"))
    texts = rows.select(F.col(doc).alias("_doc"), tx.english_tokens(F.col(english)).alias("_words")).join(held, "_doc", "left")
    words = texts.select("_doc", "_words", F.transform("_words", lambda w: F.lower(w)).alias("_low"), F.col("_found._sense").alias("_senses"), F.col("_found._key").alias("_keys"))
    return words.select(F.col("_doc").alias(doc), F.pandas_udf(_marked, "string")("_words", "_low", "_senses", "_keys").alias("annotated"))


def _marked(words: pd.Series, low: pd.Series, senses: pd.Series, keys: pd.Series) -> pd.Series:
    """Words joined, each with the [key] of its sense or of its form without an end."""

    def one(words, low, senses, keys) -> str | None:
        if words is None:
            return None
        found = {} if senses is None else dict(zip(senses, keys, strict=True))
        out = []
        for word, w in zip(words, low, strict=True):
            key = found.get(w)
            if key is None:
                key = found.get(w[:-1]) if w.endswith("s") else found.get(w[:-3]) if w.endswith("ing") else None
            out.append(word if key is None else f"{word}[{key}]")
        return "".join(out)

    return pd.Series([one(*row) for row in zip(words, low, senses, keys, strict=True)], dtype=object)


def constraint_violations(rows: DataFrame, key: str, unique: list[str], required: list[str]) -> DataFrame:
    """column, problem, value, first (least key) and n: values of ``unique`` columns found twice, ``required`` columns null or blank."""
    cell = lambda c, kind: F.struct(F.lit(c).alias("column"), F.lit(kind).alias("problem"), F.col(c).cast("string").alias("value"))
    cells = F.array(*[cell(c, "duplicate") for c in unique], *[cell(c, "missing") for c in required])
    each = rows.select(F.col(key).alias("_key"), F.explode(cells).alias("_c")).select("_key", "_c.*")
    blank = F.coalesce(tx.trim_space(F.col("value")) == "", F.lit(True))
    judged = each.where(F.when(F.col("problem") == "missing", blank).otherwise(F.col("value").isNotNull()))
    told = judged.withColumn("value", F.when(F.col("problem") == "duplicate", F.col("value")))
    counts = told.groupBy("column", "problem", "value").agg(F.min("_key").alias("first"), F.count("*").alias("n"))
    return counts.where("problem = 'missing' or n > 1")


def require_valid(violations: DataFrame) -> None:
    """Raise an error that names the first violation."""
    worst = violations.orderBy("column", "problem", "first").limit(1).collect()
    if worst:
        v = worst[0]
        raise ValueError(f"{v['problem']} {v['column']}: {v['value']!r} (first at {v['first']}, {v['n']} rows)")
