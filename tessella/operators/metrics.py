"""Multi-label metrics and label statistics over long tables (doc, label)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _sets(truth: DataFrame, predicted: DataFrame, doc: str, label: str, partitions: int | None) -> DataFrame:
    """doc, label, t, p: each pair once, and whether it is true and predicted. Dealt by document, in one shuffle.

    A pair with a null equals none of the other side.
    """
    def side(rows: DataFrame, t: int, p: int) -> DataFrame:
        apart = F.when(F.col(doc).isNull() | F.col(label).isNull(), F.lit(t))
        return rows.select(F.col(doc).alias("doc"), F.col(label).alias("label"), apart.alias("_apart"), F.lit(t).alias("t"), F.lit(p).alias("p"))

    both = side(truth, 1, 0).union(side(predicted, 0, 1))
    dealt = both.repartition("doc") if partitions is None else both.repartition(partitions, "doc")
    return dealt.groupBy("doc", "label", "_apart").agg(F.max("t").alias("t"), F.max("p").alias("p")).drop("_apart")


def per_label(truth: DataFrame, predicted: DataFrame, doc: str, label: str, partitions: int | None = None) -> DataFrame:
    """precision, recall, f1, support and predicted count of labels with support."""
    c = _sets(truth, predicted, doc, label, partitions).groupBy("label").agg(F.sum(F.col("t") * F.col("p")).alias("tp"), F.sum("t").alias("support"), F.sum("p").alias("n_predicted"))
    precision = F.when(F.col("n_predicted") > 0, F.col("tp") / F.col("n_predicted")).otherwise(0.0)
    recall = F.col("tp") / F.col("support")
    out = c.where("support > 0").withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when(F.col("tp") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return out.select("label", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round(f1, 6).alias("f1"), "support", "n_predicted")


def set_relations(truth: DataFrame, predicted: DataFrame, doc: str, label: str, partitions: int | None = None) -> DataFrame:
    """How many documents are perfect, partial, missed, and over- or under-predicted."""
    d = _sets(truth, predicted, doc, label, partitions).groupBy("doc").agg(F.sum(F.col("t") * F.col("p")).alias("both"), F.sum("t").alias("t"), F.sum("p").alias("p"))
    perfect = (F.col("both") == F.col("t")) & (F.col("both") == F.col("p"))
    return d.agg(
        F.count_if(perfect).alias("n_perfect"), F.count_if(~perfect & (F.col("both") > 0)).alias("n_partial"),
        F.count_if(F.col("both") == 0).alias("n_miss"), F.count_if(F.col("p") > F.col("t")).alias("n_over"), F.count_if(F.col("p") < F.col("t")).alias("n_under"),
    )


def summary(truth: DataFrame, predicted: DataFrame, doc: str, label: str, partitions: int | None = None) -> DataFrame:
    """Hamming loss, sample Jaccard, exact ratio, micro and macro scores, and cardinalities."""
    cells = _sets(truth, predicted, doc, label, partitions)
    d = cells.groupBy("doc").agg(F.sum(F.col("t") * F.col("p")).alias("both"), F.sum("t").alias("t"), F.sum("p").alias("p"), F.count("*").alias("either"))
    per_doc = d.agg(
        F.count("*").alias("n_docs"), F.sum("both").alias("tp"), F.sum("t").alias("nt"), F.sum("p").alias("np"),
        F.avg(F.col("both") / F.col("either")).alias("jaccard"), F.avg(F.when(F.col("both") == F.col("either"), 1.0).otherwise(0.0)).alias("exact"),
        F.sum(F.col("either") - F.col("both")).alias("wrong"),
    )
    macro = per_label(truth, predicted, doc, label, partitions).agg(F.avg("f1").alias("macro_f1"), F.count("*").alias("n_labels"))
    r = per_doc.crossJoin(macro)  # one row each
    micro = F.when(F.col("tp") > 0, 2 * F.col("tp") / (F.col("nt") + F.col("np"))).otherwise(0.0)
    six = lambda c, n: F.round(c, 6).alias(n)
    return r.select(
        six(F.col("wrong") / (F.col("n_docs") * F.col("n_labels")), "hamming"), six(F.col("jaccard"), "jaccard"), six(F.col("exact"), "exact_ratio"),
        six(F.col("tp") / F.col("np"), "micro_precision"), six(F.col("tp") / F.col("nt"), "micro_recall"), six(micro, "micro_f1"), six(F.col("macro_f1"), "macro_f1"),
        six(F.col("nt") / F.col("n_docs"), "true_cardinality"), six(F.col("np") / F.col("n_docs"), "predicted_cardinality"),
    )


def overlap_jaccard(rows: DataFrame, group: str, item: str, least: float = 0.05, support: int = 10) -> DataFrame:
    """Jaccard of the item sets of two groups, for groups with enough items, over a least value."""
    own = rows.select(group, item).distinct()
    size = own.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") >= support)
    held = own.join(size, group)
    other = held.select(F.col(group).alias("b"), F.col(item).alias("_i"), F.col("n").alias("nb"))
    pairs = held.withColumnRenamed(group, "a").join(other, (F.col(item) == F.col("_i")) & (F.col("a") < F.col("b")))
    shared = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("n").alias("n"), F.first("nb").alias("nb"))
    value = F.col("shared") / (F.col("n") + F.col("nb") - F.col("shared"))
    return shared.withColumn("jaccard", F.round(value, 6)).where(value > least).select("a", "b", "shared", "jaccard")


def label_samples(rows: DataFrame, doc: str, label: str, most: int = 100, least: int = 10) -> DataFrame:
    """label, doc, place, n: at most ``most`` rows of each label with ``least`` rows or more, and its number of rows.

    A sample is the rows of least hash (of label and row), so partitions' samples
    merge: each keeps its own first ``most`` before anything is moved.
    """
    own = rows.select(label, doc).distinct()
    n = own.groupBy(F.col(label).alias("_l")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    order = F.md5(F.concat_ws("|", F.col(label).cast("string"), F.col(doc).cast("string")))
    place = F.row_number().over(Window.partitionBy(label).orderBy(order, doc))
    first = own.withColumn("place", place).where(F.col("place") <= most)
    return first.join(n, F.col(label) == F.col("_l")).select(label, doc, "place", "n")


def merge_candidates(rows: DataFrame, predicted: DataFrame, doc: str, label: str, rate: float = 0.8, samples: int = 10, most: int = 100) -> DataFrame:
    """Label pairs that are likely one: of the sampled rows of ``a``, how many are predicted ``b`` as well.

    The number shared is held against either label's sample, and the mean of the two
    rates must reach ``rate``; ``shown`` has the first three shared rows of the sample.
    """
    held = label_samples(rows, doc, label, most, samples).checkpoint()
    sizes = held.groupBy(label).agg(F.count("*").alias("_size"), F.first("n").alias("_n"))
    other = predicted.select(F.col(doc).alias("_d"), F.col(label).alias("b")).distinct()
    met = held.withColumnRenamed(label, "a").join(other, (F.col(doc) == F.col("_d")) & (F.col("a") < F.col("b")))
    shown = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("place", F.col(doc).alias("d")))), 1, 3), lambda x: x["d"])  # a sample bounds the list
    pairs = met.groupBy("a", "b").agg(F.count("*").alias("shared"), shown.alias("shown"))
    side = lambda c: sizes.select(F.col(label).alias(c), F.col("_size").alias(f"_s{c}"), F.col("_n").alias(f"n_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    ab, ba = F.col("shared") / F.col("_sa"), F.col("shared") / F.col("_sb")
    mean = (ab + ba) / 2
    return both.where(mean >= rate).select("a", "b", "shared", "n_a", "n_b", F.round(ab, 6).alias("rate_ab"), F.round(ba, 6).alias("rate_ba"), F.round(mean, 6).alias("rate"), "shown")


def top_weights(rows: DataFrame, group: str, item: str, weight: str, n: int = 100) -> DataFrame:
    """The items with the largest absolute non-zero weights of each group."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.abs(weight).desc(), item))
    return rows.where(F.col(weight) != 0).withColumn("place", place).where(F.col("place") <= n)


def hardest(scores: DataFrame, n: int, support: int = 3) -> DataFrame:
    """The labels with the least F1 among those with enough support. Rows: label, f1, support."""
    return scores.where(F.col("support") >= support).orderBy("f1", "label").limit(n)
