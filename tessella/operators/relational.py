"""Relational operators: merges, lookups, set operations, windows, statistics.

All are compositions of DataFrame operations. Ties are broken by keys, never by
arrival, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a hot group that are combined before they meet.
SLICES = 64

#: Rows of a partition where the number of partitions follows the input, so that a task's memory does not grow with it.
ROWS_EACH = 500_000


def last_per_key(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the last in ``order``."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[c.desc() for c in order]))
    return rows.withColumn("_n", place).where("_n = 1").drop("_n")


def full_merge(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str], order: tuple[Sequence[Column], Sequence[Column]]) -> DataFrame:
    """Full outer merge of two sources by key; each side becomes a struct, null where absent.

    Keys that repeat on a side keep their last row in that side's order.
    """
    sides = []
    for rows, by, name in zip((left, right), order, names, strict=True):
        one = last_per_key(rows, key, by)
        sides.append(one.select(F.col(key), F.struct(*[c for c in one.columns if c != key]).alias(name)))
    return sides[0].join(sides[1], key, "full_outer")


def merge_statistics(merged: DataFrame, a: str, b: str) -> DataFrame:
    """How many merged rows have both sides, one of them, or any."""
    has_a, has_b = F.col(a).isNotNull(), F.col(b).isNotNull()
    return merged.agg(
        F.count_if(has_a & has_b).alias("n_both"), F.count_if(has_a & ~has_b).alias(f"n_only_{a}"),
        F.count_if(has_b & ~has_a).alias(f"n_only_{b}"), F.count("*").alias("n_total"),
    )


def level_rank(level: Column, ranks: dict[str, int]) -> Column:
    """The rank of a level; null stays null, an unknown level raises."""
    cases = reduce(lambda c, kv: c.when(level == kv[0], F.lit(kv[1])), ranks.items(), F.when(level.isNull(), F.lit(None).cast("int")))
    return cases.otherwise(F.raise_error(F.concat(F.lit("unknown level: "), level)).cast("int"))


def combined_rank(a: Column, b: Column) -> Column:
    """The sum of two ranks; an absent side takes the other's."""
    return F.coalesce(a, b) + F.coalesce(b, a)


def numbered_ids(rows: DataFrame, order: Sequence[Column], prefix: str = "gp", width: int = 4) -> DataFrame:
    """Add id: prefix and the zero-padded place in the total order.

    Places come from per-range counts, so only range totals meet, not the rows.
    """
    place = F.format_string(f"{prefix}%0{width}d", F.col("_tessella_place") + 1)
    return numbered(rows, order, "_tessella_place").withColumn("id", place).drop("_tessella_place")


def priority_lookup(rows: DataFrame, table: DataFrame, key: str, source: Column, name: str, value: str) -> DataFrame:
    """Look up ``key|source`` first, then ``key``; null if neither is there."""
    special = table.select(F.col(name).alias("_n1"), F.col(value).alias("_v1"))
    general = table.select(F.col(name).alias("_n2"), F.col(value).alias("_v2"))
    found = rows.join(special, F.concat_ws("|", F.col(key), source) == F.col("_n1"), "left").join(general, F.col(key) == F.col("_n2"), "left")
    return found.withColumn(value, F.coalesce("_v1", "_v2")).drop("_n1", "_n2", "_v1", "_v2")


def override(rows: DataFrame, table: DataFrame, key: str, column: str, new: str) -> DataFrame:
    """Replace ``column`` where the override table has the key; adds ``no_op`` for overrides that change nothing."""
    own = table.select(F.col(key).alias("_k"), F.col(new).alias("_new"))
    joined = rows.join(own, F.col(key) == F.col("_k"), "left")
    no_op = F.coalesce(F.col("_new") == F.col(column), F.lit(False))
    return joined.withColumn("no_op", no_op).withColumn(column, F.coalesce("_new", column)).drop("_k", "_new")


def dangling(rows: DataFrame, key: str, catalog: DataFrame, catalog_key: str) -> DataFrame:
    """Rows whose reference is not in the catalog."""
    return rows.join(catalog.select(F.col(catalog_key).alias("_k")), F.col(key) == F.col("_k"), "left_anti")


def known(rows: DataFrame, key: str, catalog: DataFrame, catalog_key: str) -> DataFrame:
    """Rows whose reference is in the catalog."""
    return rows.join(catalog.select(F.col(catalog_key).alias("_k")), F.col(key) == F.col("_k"), "left_semi")


def reference_state(rows: DataFrame, key: str, catalog: DataFrame, catalog_key: str, renames: DataFrame) -> DataFrame:
    """Add state: known, renamed or unknown. ``renames`` has old and new."""
    cat = catalog.select(F.col(catalog_key).alias("_k")).distinct()
    old = renames.select(F.col("old").alias("_o")).distinct()
    joined = rows.join(cat, F.col(key) == F.col("_k"), "left").join(old, F.col(key) == F.col("_o"), "left")
    state = F.when(F.col("_k").isNotNull(), "known").when(F.col("_o").isNotNull(), "renamed").otherwise("unknown")
    return joined.withColumn("state", state).drop("_k", "_o")


def rename_references(refs: DataFrame, owner: str, ref: str, renames: DataFrame) -> DataFrame:
    """Replace references by their new names (one to many and many to one); regrouped, sorted, distinct.

    ``renames`` has old and new; a new name of null deletes the reference.
    """
    table = renames.select(F.col("old").alias("_o"), F.col("new").alias("_new"))
    joined = refs.join(table, F.col(ref) == F.col("_o"), "left")
    target = F.when(F.col("_o").isNull(), F.col(ref)).otherwise(F.col("_new"))
    return joined.withColumn("_t", target).groupBy(owner).agg(F.array_sort(F.collect_set("_t")).alias(ref))


def rename_checks(renames: DataFrame, catalog: DataFrame, catalog_key: str) -> DataFrame:
    """old, new, problem: old names the catalog lacks, and renames of one name to itself."""
    per_new = renames.groupBy("new").agg(F.count("*").alias("_n"))
    cat = catalog.select(F.col(catalog_key).alias("_k")).distinct()
    joined = renames.join(per_new, "new").join(cat, F.col("old") == F.col("_k"), "left")
    problem = F.when(F.col("_k").isNull(), "missing").when((F.col("_n") == 1) & (F.col("old") == F.col("new")), "no-op")
    return joined.withColumn("problem", problem).where("problem is not null").select("old", "new", "problem")


def rewrite_catalog(catalog: DataFrame, key: str, id_col: str, renames: DataFrame, missing: str) -> DataFrame:
    """Drop renamed keys and add the new ones, with the least id of the names they replace."""
    table = renames.select(F.col("old").alias("_o"), F.col("new").alias("_new"))
    kept = catalog.select(key, id_col).join(table, F.col(key) == F.col("_o"), "left_anti")
    new = table.join(catalog.select(F.col(key).alias("_k"), id_col), F.col("_o") == F.col("_k"), "left").where("_new is not null")
    made = new.groupBy(F.col("_new").alias(key)).agg(F.coalesce(F.min(id_col), F.lit(missing)).alias(id_col))
    return kept.unionByName(made)


def pair_counts(rows: DataFrame, doc: str, label: str, samples: int = 3) -> DataFrame:
    """Unordered label pairs of a document: a, b, n, and the first sample documents.

    Counts and samples are combined per slice of the documents first, so a pair
    that most documents have is no task of its own.
    """
    own = rows.select(doc, label).distinct()
    other = own.select(F.col(doc).alias("_d"), F.col(label).alias("b"))
    pairs = own.withColumnRenamed(label, "a").join(other, (F.col(doc) == F.col("_d")) & (F.col("a") < F.col("b")))
    sliced = pairs.select("a", "b", F.col(doc).alias("doc"), F.pmod(F.xxhash64(doc), F.lit(SLICES)).alias("_s"))
    place = F.row_number().over(Window.partitionBy("a", "b", "_s").orderBy("doc"))
    parts = sliced.withColumn("_p", place).groupBy("a", "b", "_s").agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("_p") <= samples, F.col("doc"))).alias("few"))
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("few"))), 1, samples).alias("samples"))


def rare_labels_dropped(rows: DataFrame, doc: str, label: str, least: int) -> DataFrame:
    """Only rows whose label is on at least ``least`` documents."""
    often = rows.groupBy(F.col(label).alias("_l")).agg(F.countDistinct(doc).alias("_n")).where(F.col("_n") >= least)
    return rows.join(often, F.col(label) == F.col("_l"), "left_semi")


def duplicate_groups(rows: DataFrame, key: str, member: str, most: int | None = None) -> DataFrame:
    """Keys on more than one row: how many, the least and the greatest member, and with ``most`` that many of the least members."""
    sliced = rows.withColumn("_s", F.pmod(F.xxhash64(member), F.lit(SLICES)))
    few = [] if most is None else [F.slice(F.array_sort(F.collect_list(member)), 1, most).alias("members")]
    if not few:
        return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(member).alias("first"), F.max(member).alias("last")).where("n > 1")
    place = F.row_number().over(Window.partitionBy(key, "_s").orderBy(member))
    parts = sliced.withColumn("_p", place).groupBy(key, "_s").agg(F.count("*").alias("n"), F.min(member).alias("first"), F.max(member).alias("last"), F.collect_list(F.when(F.col("_p") <= most, F.col(member))).alias("few"))
    out = parts.groupBy(key).agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.slice(F.array_sort(F.flatten(F.collect_list("few"))), 1, most).alias("members"))
    return out.where("n > 1")


def later_duplicates(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows whose key an earlier row has, with their place among its rows."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("place", place).where("place > 1")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; other keys are appended."""
    return old.join(new.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti").unionByName(new)


def insert_ignore(store: DataFrame, rows: DataFrame) -> DataFrame:
    """The store with the pairs it lacks."""
    return store.unionByName(rows.select(store.columns)).distinct()


def insert_feedback(store: DataFrame, rows: DataFrame) -> DataFrame:
    """attempted, inserted and duplicates of an insert, per first key column."""
    key, value = store.columns
    own = store.distinct().select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    joined = rows.select(key, value).distinct().join(own, (F.col(key) == F.col("_k")) & (F.col(value) == F.col("_v")), "left")
    return joined.groupBy(key).agg(
        F.count("*").alias("attempted"), F.count_if(F.col("_k").isNull()).alias("inserted"), F.count_if(F.col("_k").isNotNull()).alias("duplicates")
    )


def pair_stats(pairs: DataFrame, key: str) -> DataFrame:
    """One row: distinct pairs, distinct keys, and pairs per key rounded to 2 places (0 without pairs)."""
    n, keys = F.count("*"), F.countDistinct(key)
    return pairs.distinct().agg(n.alias("n_pairs"), keys.alias("n_keys"), F.round(F.when(n > 0, n / keys).otherwise(0.0), 2).alias("mean"))


def key_stats(pairs: DataFrame, keys: DataFrame, key: str, value: str) -> DataFrame:
    """For each asked key how many values it has, whether it is present, and its sorted values."""
    held = pairs.select(F.col(key).alias("_k"), value).distinct().groupBy("_k").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(value)).alias("kinds"))
    out = keys.select(key).distinct().join(held, F.col(key) == F.col("_k"), "left")
    return out.select(key, F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNotNull().alias("present"), F.coalesce("kinds", F.array().cast("array<string>")).alias("kinds"))


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """The distinct rows that both have."""
    return left.intersect(right.select(left.columns))


def sorted_positions(rows: DataFrame, name: str) -> DataFrame:
    """pos (from 0) and the distinct names in order, numbered across range partitions."""
    names = rows.select(name).distinct().where(F.col(name).isNotNull())
    return numbered(names, [F.col(name)], "pos")


def numbered(rows: DataFrame, by: Sequence[Column], pos: str) -> DataFrame:
    """Rows with their place (long, from 0) in a total order; no task holds more than a range of it."""
    part, own = "_tessella_part", "_tessella_own"
    ranged = rows.repartitionByRange(*by).withColumn(part, F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy(part).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per partition
    starts = counts.select(F.col(part).alias("_q"), before.alias("_start"))
    placed = ranged.withColumn(own, F.row_number().over(Window.partitionBy(part).orderBy(*by)))
    return placed.join(F.broadcast(starts), F.col(part) == F.col("_q")).withColumn(pos, F.col("_start") + F.col(own) - 1).drop(part, own, "_q", "_start")


def running(rows: DataFrame, by: Sequence[Column], n: str, pos: str) -> DataFrame:
    """Rows with the sum (long) of ``n`` over the rows before them in a total order; no task holds more than a range of it."""
    part, own = "_tessella_part", "_tessella_own"
    ranged = rows.repartitionByRange(*by).withColumn(part, F.spark_partition_id()).checkpoint()
    before = F.coalesce(F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per partition
    starts = ranged.groupBy(part).agg(F.sum(n).alias("_n")).select(F.col(part).alias("_q"), before.alias("_start"))
    summed = F.coalesce(F.sum(n).over(Window.partitionBy(part).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn(own, summed).join(F.broadcast(starts), F.col(part) == F.col("_q")).withColumn(pos, F.col("_start") + F.col(own)).drop(part, own, "_q", "_start")


def extremes(counts: DataFrame, label: str, n: str, k: int) -> DataFrame:
    """side, label, n of the k least and the k most frequent labels."""
    least = counts.orderBy(n, label).limit(k).select(F.lit("least").alias("side"), label, n)
    return least.unionByName(counts.orderBy(F.col(n).desc(), label).limit(k).select(F.lit("most").alias("side"), label, n))


def inverted(rows: DataFrame, name: str, items: str) -> DataFrame:
    """item and the sorted distinct names that list it."""
    each = rows.select(name, F.explode(items).alias("item")).distinct()
    return each.groupBy("item").agg(F.array_sort(F.collect_set(name)).alias("names"))


def merged_rows(rows: DataFrame, new: str, order: str, items: str) -> DataFrame:
    """Rows merged into new ones: the first order value, and the items of all in their order, each once."""
    each = rows.select(new, order, F.posexplode(items).alias("_i", "item"))
    first = each.groupBy(new, "item").agg(F.min(F.struct(order, "_i")).alias("at"))
    listed = first.groupBy(new).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias("items"))
    ids = rows.groupBy(F.col(new).alias("_n")).agg(F.min(order).alias("first"))
    return ids.join(listed, F.col("_n").eqNullSafe(F.col(new)), "left").select(F.col("_n").alias(new), "first", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def checked_lookup(rows: DataFrame, table: DataFrame, key: str, other: str) -> DataFrame:
    """An inner lookup that raises an error for a key without a match."""
    found, miss = "_tessella_found", F.concat(F.lit("no match for "), F.col(key).cast("string"))
    joined = rows.join(table.withColumn(found, F.lit(True)), F.col(key) == F.col(other), "left")
    return joined.where(F.when(F.col(found), F.lit(True)).otherwise(F.raise_error(miss).cast("boolean"))).drop(found)


def paired(rows: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """Rows with both texts, and rows with one of them blank (errors); rows with both blank go."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    return rows.where(~blank(a) & ~blank(b)), rows.where(blank(a) != blank(b))


def with_marker(rows: DataFrame, markers: str) -> DataFrame:
    """Rows whose array of frequency markers is not empty."""
    return rows.where(F.size(F.coalesce(markers, F.array().cast("array<string>"))) > 0)


def except_labels(positive: DataFrame, negative: DataFrame, key: str, label: str) -> DataFrame:
    """key and sorted labels without the negated ones; keys with negatives only get an empty array."""
    left = positive.groupBy(key).agg(F.collect_set(label).alias("_p"))
    right = negative.groupBy(F.col(key).alias("_k")).agg(F.collect_set(label).alias("_n"))
    joined = left.join(right, F.col(key) == F.col("_k"), "full_outer")
    empty = F.array().cast("array<string>")
    labels = F.array_except(F.coalesce("_p", empty), F.coalesce("_n", empty))
    return joined.select(F.coalesce(key, "_k").alias(key), F.array_sort(labels).alias("labels"))


def union_labels(*sets: DataFrame, key: str, label: str) -> DataFrame:
    """key and sorted distinct labels over all inputs."""
    every = reduce(lambda a, b: a.unionByName(b), [s.select(key, label) for s in sets])
    return every.groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("labels"))


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key and side: keys of one side that the other lacks."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("missing")).unionByName(b.exceptAll(a).withColumn("side", F.lit("invalid")))


def partitions_for(rows: DataFrame) -> int:
    """Partitions in which a task has ``ROWS_EACH`` rows at most on the mean; the session's number at least. Counts the rows."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_EACH))


def second_highest(rows: DataFrame, group: str, label: str, n: str) -> DataFrame:
    """Labels with the second-highest distinct count in their group, if it is over 1."""
    rank = F.dense_rank().over(Window.partitionBy(group).orderBy(F.col(n).desc()))
    return rows.withColumn("_r", rank).where((F.col("_r") == 2) & (F.col(n) > 1)).drop("_r").select(group, label, n)


def newest(rows: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """The n newest rows."""
    return rows.orderBy(*by).limit(n)


def numbered_to_rows(rows: DataFrame, key: str, names: dict[str, list[str]]) -> DataFrame:
    """Wide numbered columns to rows (key, pos, one column per name), up to the first gap of the first name."""
    lead = next(iter(names))
    width = len(names[lead])
    items = F.array(*[F.struct(F.lit(i).alias("pos"), *[F.col(c[i]).alias(n) for n, c in names.items()]) for i in range(width)])
    out = rows.select(key, F.inline(items))
    gap = F.min(F.when(F.col(lead).isNull(), F.col("pos"))).over(Window.partitionBy(key))
    return out.withColumn("_gap", gap).where(F.col("_gap").isNull() | (F.col("pos") < F.col("_gap"))).drop("_gap")


def carry_forward(value: Column, group: str, order: str) -> Column:
    """The last value that is not null, up to this row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def previous_histogram(tokens: DataFrame, group: str, order: str, token: str, target: Column, top: int = 5) -> DataFrame:
    """The most frequent tokens right before a target token."""
    before = F.lag(token).over(Window.partitionBy(group).orderBy(order))
    counts = tokens.withColumn("previous", before).where(target & F.col("previous").isNotNull()).groupBy("previous").agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "previous").limit(top)


def mode_per_group(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The most frequent value per group; the least one of equals."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    best = F.row_number().over(Window.partitionBy(group).orderBy(F.col("n").desc(), value))
    return counts.withColumn("_r", best).where("_r = 1").drop("_r")


def pattern_labels(rows: DataFrame, text: Column, patterns: dict[str, str]) -> Column:
    """The sorted labels whose pattern is found in the text: one projection of literal patterns."""
    found = [F.when(text.rlike(p), F.lit(label)) for label, p in sorted(patterns.items())]
    return F.filter(F.array(*found), lambda x: x.isNotNull())
