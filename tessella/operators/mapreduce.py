"""Map stages, folds, memo tables and bounded repair loops over document tables."""

from __future__ import annotations

import inspect
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Stage = Callable[[DataFrame], DataFrame]


def map_stages(docs: DataFrame, stages: dict[str, Callable[[Column], Column]], column: str, preprocess: Callable[[Column], Column] | None = None) -> DataFrame:
    """Apply named stages in order to a column; null stops the later ones and keeps the original. Adds ``changed``."""
    for name, stage in stages.items():
        if inspect.iscoroutinefunction(stage):
            raise ValueError(f"stage {name} is a coroutine; stages build columns")
    original = F.col(column)
    value = preprocess(original) if preprocess else original
    for stage in stages.values():
        value = F.when(value.isNotNull(), stage(value))
    out = docs.withColumn("_new", value)
    new = F.coalesce(F.col("_new"), original)
    return out.withColumn("changed", ~new.eqNullSafe(original)).withColumn(column, new).drop("_new")


def map_documents(docs: DataFrame, function: Callable[[str, str], str | None], path: str, column: str) -> DataFrame:
    """A Python map ``function(document, path)`` in Arrow batches; null keeps the original."""

    @F.pandas_udf("string")
    def mapped(values: pd.Series, paths: pd.Series) -> pd.Series:
        out = [function(v, p) for v, p in zip(values, paths, strict=True)]
        return pd.Series([v if o is None else o for v, o in zip(values, out, strict=True)], dtype=object)

    return docs.withColumn("_new", mapped(column, path)).withColumn("changed", ~F.col("_new").eqNullSafe(F.col(column))).withColumn(column, F.col("_new")).drop("_new")


def fold(docs: DataFrame, keys: list[str], start: Column, item: Column, merge: Callable[[Column, Column], Column], order: Column) -> DataFrame:
    """Fold the items of each key, in a stated order, from a start value."""
    held = docs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), item.alias("x")))).alias("_items"))
    return held.withColumn("folded", F.aggregate("_items", start, lambda acc, s: merge(acc, s["x"]))).drop("_items")


def summarise(docs: DataFrame, name: str, fields: list[str]) -> DataFrame:
    """name and JSON of the fields that are present."""
    return docs.select(name, F.to_json(F.struct(*fields)).alias("summary"))


def route(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a blank key, and the rest."""
    blank = F.coalesce(F.trim(key) == "", F.lit(True))
    return rows.where(blank), rows.where(~blank)


def protect(rows: DataFrame, fields: list[str], transform: Stage) -> DataFrame:
    """Run a transform that must not change some fields: they are put aside and restored."""
    kept = rows.withColumn("_kept", F.struct(*fields)).withColumns({f: F.lit(None).cast(rows.schema[f].dataType) for f in fields})
    out = transform(kept)
    return out.withColumns({f: F.col(f"_kept.{f}") for f in fields}).drop("_kept")


def changed(old: Column, new: Column) -> Column:
    """Whether two documents differ as JSON."""
    return ~F.to_json(old).eqNullSafe(F.to_json(new))


def memo_lookup(rows: DataFrame, memo: DataFrame, key: Column, compute: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``value`` from the memo or computed, and the memo with what it lacked."""
    keyed = rows.withColumn("key", key)
    hits = keyed.join(memo.select("key", "value"), "key")
    misses = compute(keyed.join(memo.select("key"), "key", "left_anti"))
    return hits.unionByName(misses.select(hits.columns)), memo.unionByName(misses.select("key", "value").dropDuplicates(["key"]))


def memo_touch(memo: DataFrame, reads: DataFrame) -> DataFrame:
    """key, value, last_access, callers after reads (key, caller, at)."""
    seen = reads.groupBy("key").agg(F.max("at").alias("_at"), F.collect_set("caller").alias("_by"))
    out = memo.join(seen, "key", "left")
    return out.select("key", "value", F.greatest("last_access", "_at").alias("last_access"), F.array_sort(F.array_union("callers", F.coalesce("_by", F.array().cast("array<string>")))).alias("callers"))


def repair_loop(rows: DataFrame, enrich: Stage, problems: Callable[[DataFrame], DataFrame], rounds: int = 5) -> DataFrame:
    """Enrich rows until none has problems, at most ``rounds`` times. Adds ``round`` and ``problems``.

    Each round runs on the rows that still have problems, and is cut from its lineage.
    """
    done, left = None, rows
    for n in range(1, rounds + 1):
        judged = problems(enrich(left)).withColumn("round", F.lit(n)).checkpoint()
        good = judged.where(F.size("problems") == 0) if n < rounds else judged
        done = good if done is None else done.unionByName(good)
        bad = judged.where(F.size("problems") > 0)
        if n == rounds or bad.isEmpty():
            break
        left = bad.drop("problems", "round")
    return done


def enrich_documents(docs: DataFrame, answer: Callable[[str], str], prompt: Column, schema: str) -> DataFrame:
    """Ask a pluggable model for JSON of a schema; adds ``answer`` (a struct, null if invalid) and ``valid``."""

    @F.pandas_udf("string")
    def asked(prompts: pd.Series) -> pd.Series:
        return prompts.map(answer)

    out = docs.withColumn("_raw", asked(prompt)).withColumn("answer", F.from_json("_raw", schema))
    return out.withColumn("valid", F.col("answer").isNotNull()).drop("_raw")


def retrying(answer: Callable[[str], str], retries: int = 10, backoff: float = 60, exhausted: str = "RESOURCE_EXHAUSTED") -> Callable[[str], str]:
    """``answer`` tried again after errors: at once, or after a pause where the error names an exhausted quota.

    The last attempt's error is raised; a quota exhausted in the last attempt raises a RuntimeError.
    """

    def run(prompt: str) -> str:
        for attempt in range(retries):
            try:
                return answer(prompt)
            except Exception as e:  # noqa: BLE001  the model is the user's, and so are its errors
                if exhausted in str(e):
                    time.sleep(backoff)
                elif attempt == retries - 1:
                    raise
        raise RuntimeError(f"no answer after {retries} attempts")

    return run


def variants(answer: Callable[[str], str], accept: Callable[[str], str], tries: int = 6, raise_at: int = 2) -> Callable[[str], str | None]:
    """Prompt variants, numbered from 0, until ``accept`` takes an answer; only the error of attempt ``raise_at`` is raised.

    The number is part of the prompt, so a memo keeps each attempt apart. Without an accepted answer the result is None.
    """

    def run(prompt: str) -> str | None:
        for attempt in range(tries):
            try:
                return accept(answer(f"{prompt}{attempt}"))
            except Exception:  # noqa: BLE001  a rejected answer leads to the next variant
                if attempt == raise_at:
                    raise
        return None

    return run
