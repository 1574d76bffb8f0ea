"""Models over texts and vectors: TF-IDF, label classifiers, clusters, neighbours, components."""

from __future__ import annotations

import importlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, HashingTF, MaxAbsScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def word_grams(docs: DataFrame, doc: str, text: str, n: int = 3) -> DataFrame:
    """doc, term of word 1- to n-grams. Texts are dealt by document first, so that their grams are counted where they are made."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1))
    held = docs.select(doc, text).repartition(doc).select(doc, words.alias("w"))
    def of_size(k: int):
        return F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda i: F.array_join(F.slice("w", i + 1, k), " "))

    grams = [of_size(k) for k in range(1, n + 1)]
    usable = [F.when(F.size("w") >= k, g).otherwise(F.array().cast("array<string>")) for k, g in enumerate(grams, 1)]
    return held.select(doc, F.explode(F.concat(*usable)).alias("term"))


def tf_idf(terms: DataFrame, doc: str, n_docs: int, min_df: int = 3, max_df: float = 0.85, features: int = 7500) -> DataFrame:
    """doc, term, weight: sublinear counts, smoothed idf, unit length per document; the most frequent terms within bounds."""
    counts = terms.groupBy(doc, "term").agg(F.count("*").alias("c"))
    df = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("c").alias("total")).where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    df = df.orderBy(F.col("total").desc(), "term").limit(features)
    raw = counts.join(F.broadcast(df.select(F.col("term").alias("_t"), "df")), F.col("term") == F.col("_t"))  # ``features`` rows at most
    weight = (1 + F.log("c")) * (F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1)
    weighted = raw.select(doc, "term", weight.alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return weighted.select(doc, "term", (F.col("w") / norm).alias("weight"))


def one_label(docs: DataFrame, text: str, label: str, regularisation: float = 0.01):
    """An L1 logistic model of one label over hashed, scaled words; classes weigh the same. Returns a function that scores."""
    tf = HashingTF(inputCol="_w", outputCol="_tf", numFeatures=1 << 14)
    words = lambda d: tf.transform(d.withColumn("_w", F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+")))
    scaler = MaxAbsScaler(inputCol="_tf", outputCol="_x").fit(words(docs))
    share = docs.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    weight = F.when(F.col(label) == 1, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9))
    model = LogisticRegression(featuresCol="_x", labelCol=label, weightCol="_weight", elasticNetParam=1.0, regParam=regularisation, maxIter=50).fit(
        scaler.transform(words(docs.withColumn("_weight", weight)))
    )
    keep = ["rawPrediction", "probability", "prediction", "_w", "_tf", "_x"]
    return lambda d: model.transform(scaler.transform(words(d))).withColumn("score", F.get(vector_to_array("probability"), F.lit(1))).drop(*keep)


def predict_labels(scores: DataFrame, doc: str, threshold: float, fallback: str) -> DataFrame:
    """doc and sorted labels whose score reaches the threshold; the fallback where none does. Rows: doc, label, score."""
    found = F.array_sort(F.collect_list(F.when(F.col("score") >= threshold, F.col("label"))))
    return scores.groupBy(doc).agg(found.alias("labels")).withColumn("labels", F.when(F.size("labels") > 0, F.col("labels")).otherwise(F.array(F.lit(fallback))))


def hash_split(rows: DataFrame, key: str, share: float, seed: int = 0) -> DataFrame:
    """Add ``held_out`` for a repeatable share of keys."""
    return rows.withColumn("held_out", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))


def kmeans(vectors: DataFrame, key: str, column: str, k: int = 20, seed: int = 42) -> DataFrame:
    """key and cluster."""
    rows = vectors.select(key, array_to_vector(F.col(column).cast("array<double>")).alias("features"))
    return KMeans(k=k, seed=seed).fit(rows).transform(rows).select(key, F.col("prediction").alias("cluster"))


def intrinsic_dimension(vectors: DataFrame, column: str, shares: tuple[float, ...] = (0.9, 0.95, 0.99)) -> dict[float, int]:
    """How many principal components explain each share of the variance."""
    rows = vectors.select(array_to_vector(F.col(column).cast("array<double>")).alias("features"))
    width = vectors.select(F.size(column)).first()[0]
    explained = PCA(k=width, inputCol="features", outputCol="p").fit(rows).explainedVariance.toArray().cumsum()
    return {s: int((explained < s - 1e-12).sum()) + 1 for s in shares}


def norms(vectors: DataFrame, column: str) -> DataFrame:
    """Mean and standard deviation of vector lengths."""
    n = F.sqrt(F.aggregate(F.transform(F.col(column), lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x))
    return vectors.agg(F.count("*").alias("n"), F.round(F.avg(n), 4).alias("mean_norm"), F.round(F.stddev_pop(n), 4).alias("std_norm"))


#: Parts in which each side of a search is sent to the blocks of the other; pairs of a slice of a search, and pairs scored at once.
SIDES, SLICE, SCORED = 8, 1 << 21, 1 << 16


def _exact(q: np.ndarray, h: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (i, j), to five places."""
    qq, hh = (q * q).sum(1), (h * h).sum(1)
    out = np.empty(len(i))
    for at in range(0, len(i), SCORED):
        x, y = i[at : at + SCORED], j[at : at + SCORED]
        with np.errstate(invalid="ignore"):
            out[at : at + SCORED] = np.round((q[x] * h[y]).sum(1) / np.sqrt(qq[x] * hh[y]), 5)
    return out


def nearer(qi: np.ndarray, q: np.ndarray, hi: np.ndarray, h: np.ndarray, k: int, found: tuple) -> tuple:
    """Row of ``qi``, id and cosine of the k nearest, in order, of those ``found`` so far and the rows of ``h``.

    Single precision with a margin leaves the pairs that can be among them; these are scored in double precision.
    """
    row, id_, cosine = found
    unit = [np.divide(x, n, out=np.zeros_like(x), where=n > 0).astype("f4") for x in (q, h) for n in [np.sqrt((x * x).sum(1, keepdims=True))]]
    zero = [~x.any(1) for x in (q, h)]  # without a direction: scored with all
    any_zero = any(z.any() for z in zero)
    margin = 1.2e-5 + 2 * (q.shape[1] + 8) * 2.0**-24
    ends = np.cumsum(np.bincount(row, minlength=len(qi)))
    full = np.diff(ends, prepend=0) >= k
    floor = np.full(len(qi), -np.inf)
    floor[full] = cosine[ends[full] - 1]
    floor[zero[0] | np.isnan(floor)] = -np.inf
    order = np.argsort(hi, kind="stable")
    first, last = (np.searchsorted(hi[order], qi, side) for side in ("left", "right"))
    n = max(1, SLICE // len(hi))
    for at in range(0, len(qi), n):
        near = unit[0][at : at + n] @ unit[1].T
        for i in np.flatnonzero(first[at : at + n] < last[at : at + n]):
            near[i, order[first[at + i] : last[at + i]]] = -np.inf
        least = floor[at : at + n].copy()
        new = np.isneginf(least)
        if new.any() and len(hi) > k:
            least[new] = np.partition(near[new], len(hi) - k, axis=1)[:, len(hi) - k]
        able = near >= np.maximum(least - margin, np.finfo("f4").min).astype("f4")[:, None]
        if any_zero:
            able |= (zero[1] | zero[0][at : at + n, None]) & (near > -np.inf)
        i, j = np.divmod(np.flatnonzero(able), len(hi))
        i += at
        row, id_, cosine = np.concatenate([row, i]), np.concatenate([id_, hi[j]]), np.concatenate([cosine, _exact(q, h, i, j)])
    # Spark's order: a cosine that is no number comes first.
    by = np.lexsort((id_, -np.where(np.isnan(cosine), np.inf, cosine), row))
    row, id_, cosine = row[by], id_[by], cosine[by]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], id_[kept], cosine[kept]


def neighbours(vectors: DataFrame, queries: DataFrame, key: str, column: str, k: int = 5, each: int = 8192, queries_each: int = 4096) -> DataFrame:
    """The k most similar other rows (cosine) of each query row.

    Rows are packed into blocks of about ``each`` vectors. The blocks of either side form ``SIDES``
    groups; each pair of groups is one key of an equi-join, in which each block of queries meets
    each block of vectors and keeps its k best. So each row is sent ``SIDES`` times at most.
    """

    def packed(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
        n = max(1, math.ceil(rows.count() / size))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # Rows come sorted by block.
            at, ids, held = None, [], []
            pack = lambda: pd.DataFrame([(at, np.concatenate(ids).tobytes(), np.concatenate(held).tobytes())], columns=[name, "i", "v"])
            for batch in batches:
                for block, some in batch.groupby("block", sort=True):
                    if block != at and ids:
                        yield pack()
                        ids, held = [], []
                    at = block
                    ids.append(some["i"].to_numpy("i8"))
                    held.append(np.stack(some["v"].to_numpy()).astype("f8"))
            if ids:
                yield pack()

        dealt = rows.select(F.col(key).cast("long").alias("i"), F.col(column).cast("array<double>").alias("v"), F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("block"))
        blocks = dealt.repartition(n, "block").sortWithinPartitions("block").mapInPandas(run, f"{name} int, i binary, v binary")
        return blocks.select(name, F.col("i").alias(f"{name}i"), F.col("v").alias(f"{name}v")), min(n, SIDES)

    held, n_held = packed(vectors, each, "h")
    asked, n_asked = packed(queries, queries_each, "q")
    spread = lambda own, n_own, other, n_other: own.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))).withColumn("_s", F.col(own.columns[0]) % n_own)
    left = spread(asked, n_asked, held, n_held).select(F.col("_s").alias("a"), F.col("_o").alias("b"), "q", "qi", "qv")
    right = spread(held, n_held, asked, n_asked).select(F.col("_o").alias("a"), F.col("_s").alias("b"), "hi", "hv")
    # Blocks look small to the optimizer; none of them may pass through the driver.
    met = left.join(right.hint("merge"), ["a", "b"]).select("q", "qi", "qv", "hi", "hv")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, qi, found = None, None, None
        told = lambda: pd.DataFrame({"query": qi[found[0]], key: found[1], "cosine": found[2]})
        for batch in batches:
            for block, q_ids, qv, h_ids, hv in zip(*(batch[c] for c in ("q", "qi", "qv", "hi", "hv")), strict=True):
                if block != at:
                    if at is not None:
                        yield told()
                    at, qi, found = block, np.frombuffer(q_ids, "i8"), (np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0))
                hi = np.frombuffer(h_ids, "i8")
                found = nearer(qi, np.frombuffer(qv, "f8").reshape(len(qi), -1), hi, np.frombuffer(hv, "f8").reshape(len(hi), -1), k, found)
        if at is not None:
            yield told()

    found = met.mapInPandas(run, f"query long, {key} long, cosine double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("cosine").desc(), key))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def mean_pairwise_cosine(vectors: DataFrame, column: str) -> DataFrame:
    """One row: the mean cosine over all unordered pairs, from the sum of the unit vectors, without making pairs."""
    v = F.col(column).cast("array<double>")
    length = F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda a, x: a + x))
    unit = vectors.select(F.posexplode(F.transform(v, lambda x: x / length)).alias("i", "x"))
    sums = unit.groupBy("i").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    return sums.agg(F.round((F.sum(F.col("s") * F.col("s")) - F.max("n")) / (F.max("n") * (F.max("n") - 1)), 6).alias("mean_cosine"))


def save_bundle(folder: str, models: dict, settings: dict, spark) -> None:
    """Fitted Spark ML models and settings (JSON) under a folder."""
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/models/{name}")
    kinds = {n: f"{type(m).__module__}.{type(m).__name__}" for n, m in models.items()}
    row = [(json.dumps({"settings": settings, "kinds": kinds}),)]
    spark.createDataFrame(row, "json string").coalesce(1).write.mode("overwrite").text(f"{folder}/bundle")


def load_bundle(folder: str, spark) -> tuple[dict, dict]:
    """The models and settings of a saved bundle; only classes of Spark ML are loaded."""
    held = json.loads(spark.read.text(f"{folder}/bundle").first()[0])
    models = {}
    for name, kind in held["kinds"].items():
        module, _, cls = kind.rpartition(".")
        if not module.startswith("pyspark.ml."):
            raise ValueError(f"not a model class: {kind}")
        models[name] = getattr(importlib.import_module(module), cls).load(f"{folder}/models/{name}")
    return models, held["settings"]


def self_training(docs: DataFrame, text: str, label: str, rounds: int = 1, confident: float = 0.99) -> DataFrame:
    """Fit, label unlabelled rows that the model is sure of, and repeat. ``label`` is null where unknown."""
    current = docs
    for _ in range(rounds):
        score = one_label(current.where(F.col(label).isNotNull()), text, label)
        sure = F.when(F.col("score") >= confident, 1).when(F.col("score") <= 1 - confident, 0)
        current = score(current).withColumn(label, F.coalesce(F.col(label), sure)).drop("score").checkpoint()
    return current
