"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_BYTES`` bytes; all passages of the
whole text are encoded. A passage becomes a vector of character-class and
class-pair frequencies and of word statistics, then a dense tanh encoding. Gated
attention (tanh branch times sigmoid branch) weighs the passages, and a logistic
unit scores the weighted mean. Only document labels are needed.

The model is fitted on a bounded sample of labelled rows: at most
``TRAIN_DOCS`` documents and ``TRAIN_BYTES`` bytes of text, in order of a hash
of the id; texts over a hundredth of the bytes come after all others, shortest
first, so a long text never shuts out those that fit. It is small (some 30 kB) and goes to the scoring tasks with the
function. Scoring is one pass over the texts without a shuffle.

Defined cases: null text counts as empty and is scored as an empty passage;
several labels of one document count by their mean, null labels not at all;
of rows that repeat a labelled id the least text trains;
a null doc_id is not held out and never trains; labels of which no text fits,
or of which the sample holds one value where they have two, raise an error;
without labels every score is 0.5, with labels of one value the score is near that value; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import clean_text, read_table

PASSAGE_BYTES = 600
TRAIN_DOCS = 3000
TRAIN_BYTES = 10 << 20
HIDDEN, GATE = 24, 12
STEPS, RATE, DECAY, SEED = 220, 0.02, 1e-4, 17
FOLDS, HELD_FOLD = 3, 1
N_CLASS = 16
N_FEATURES = N_CLASS + N_CLASS * N_CLASS + 6
PART_BYTES = 2 << 20


def _class_table() -> np.ndarray:
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\x0b\x0c\r", ".", ",;:", "!?", "#*$%&|<>", "\"'`", "-_", "()[]{}", "@/\\=+~^"]
    table = np.full(256, 13, dtype=np.uint8)
    for number, chars in enumerate(groups):
        table[[ord(c) for c in chars]] = number
    table[128:192] = 14
    table[192:] = 15
    return table


CLASS_OF = _class_table()
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
ODD = np.uint64(0x9E3779B97F4A7C15)


def bag_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of all texts, and the first passage of each text."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    n_pass = np.maximum(1, -(-sizes // PASSAGE_BYTES))
    first = np.concatenate([[0], np.cumsum(n_pass)])
    total = int(first[-1])
    x = np.zeros((total, N_FEATURES), dtype=np.float32)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data):
        doc = np.repeat(np.arange(len(texts)), sizes)
        inside = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        passage = first[doc] + inside // PASSAGE_BYTES
        length = np.bincount(passage, minlength=total).astype(np.float32)
        kind = CLASS_OF[data].astype(np.int64)
        one = np.bincount(passage * N_CLASS + kind, minlength=total * N_CLASS).reshape(total, N_CLASS)
        same = passage[1:] == passage[:-1]
        key = (passage[:-1] * N_CLASS + kind[:-1]) * N_CLASS + kind[1:]
        two = np.bincount(key[same], minlength=total * N_CLASS**2).reshape(total, N_CLASS**2)
        scale = 1 / np.maximum(length, 1)[:, None]
        x[:, :N_CLASS] = np.sqrt(one * scale)
        x[:, N_CLASS : N_CLASS + N_CLASS**2] = np.sqrt(two * scale)
        x[:, -6:] = _word_features(data, doc, passage, total, length)
    x[:, -1] = np.log1p(np.repeat(sizes, n_pass)) / 10
    return x, first


def _word_features(data: np.ndarray, doc: np.ndarray, passage: np.ndarray, total: int, length: np.ndarray) -> np.ndarray:
    out = np.zeros((total, 6), dtype=np.float32)
    inner = ~IS_SPACE[data]
    edge = np.concatenate([[True], doc[1:] != doc[:-1]])
    start = np.flatnonzero(inner & (edge | np.concatenate([[True], ~inner[:-1]])))
    if not len(start):
        return out
    # A word's hash sums its bytes, each times a power of an odd number.
    mixed = np.where(inner, data.astype(np.uint64) + np.uint64(1), np.uint64(0))
    before = np.concatenate([[0], np.cumsum(inner)])
    nth = _nth(before, start, len(data))
    powers = np.cumprod(np.full(int(nth.max()) + 1, ODD, dtype=np.uint64))
    word = np.add.reduceat(mixed * powers[nth], start)
    word ^= word >> np.uint64(29)
    size = np.add.reduceat(inner.astype(np.int64), start)
    own = passage[start]
    n = np.bincount(own, minlength=total).astype(np.float32)
    order = np.lexsort((word, own))
    again = (word[order][1:] == word[order][:-1]) & (own[order][1:] == own[order][:-1])
    repeat = np.bincount(own[order][1:][again], minlength=total)
    in_doc = doc[start]
    order = np.lexsort((word, in_doc))
    again_doc = np.zeros(len(word), dtype=bool)
    again_doc[order[1:]] = (word[order][1:] == word[order][:-1]) & (in_doc[order][1:] == in_doc[order][:-1])
    some = np.maximum(n, 1)
    out[:, 0] = repeat / some
    out[:, 1] = np.bincount(own, again_doc, minlength=total) / some
    out[:, 2] = np.bincount(own, size, minlength=total) / some / 10
    out[:, 3] = np.sqrt(np.maximum(0, np.bincount(own, size.astype(float) ** 2, minlength=total) / some - (np.bincount(own, size, minlength=total) / some) ** 2)) / 10
    out[:, 4] = n / np.maximum(length, 1) * 4
    return out


def _nth(before: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """For each byte its number within its word."""
    word = np.searchsorted(start, np.arange(n), side="right") - 1
    return np.maximum(0, before[:-1] - before[start[np.maximum(word, 0)]])


@dataclass
class Model:
    """Weights of the encoder, the attention and the output; ``constant`` replaces them if set."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh((x - w["mean"]) / w["std"] @ w["W"] + w["b"])
        t = np.tanh(h @ w["V"])
        g = 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * g) @ w["a"]
        starts, n = first[:-1], np.diff(first)
        peak = np.repeat(np.maximum.reduceat(e, starts), n)
        p = np.exp(e - peak)
        p /= np.repeat(np.add.reduceat(p, starts), n)
        z = np.add.reduceat(p[:, None] * h, starts)
        logit = z @ w["o"] + w["c"][0]
        return {"h": h, "t": t, "g": g, "p": p, "z": z, "logit": logit}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return 1 / (1 + np.exp(-np.clip(self.forward(x, first)["logit"].astype(np.float64), -30, 30)))


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray) -> Model:
    """Adam on the mean log loss, all bags in each step."""
    n_docs = len(y)
    if not n_docs:
        return Model({}, 0.5)
    if y.min() == y.max():
        return Model({}, float((y.sum() + 0.5) / (n_docs + 1)))
    rng = np.random.default_rng(SEED)
    d = x.shape[1]
    init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    w = {"W": init(d, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE), "a": init(GATE), "o": init(HIDDEN), "c": np.zeros(1, np.float32)}
    model = Model(w | {"mean": x.mean(0), "std": x.std(0) + 0.02})
    xs = (x - model.weights["mean"]) / model.weights["std"]
    first_moment = {k: np.zeros_like(v) for k, v in w.items()}
    second_moment = {k: np.zeros_like(v) for k, v in w.items()}
    starts, n = first[:-1], np.diff(first)
    for step in range(1, STEPS + 1):
        f = model.forward(x, first)
        d_logit = ((1 / (1 + np.exp(-f["logit"])) - y) / n_docs).astype(np.float32)
        grad = {"o": f["z"].T @ d_logit, "c": d_logit.sum(keepdims=True)}
        dz = np.repeat(d_logit[:, None] * w["o"], n, axis=0)
        dp = (dz * f["h"]).sum(1)
        de = f["p"] * (dp - np.repeat(np.add.reduceat(f["p"] * dp, starts), n))
        tg = f["t"] * f["g"]
        grad["a"] = tg.T @ de
        dtg = de[:, None] * w["a"]
        dt = dtg * f["g"] * (1 - f["t"] ** 2)
        dg = dtg * f["t"] * f["g"] * (1 - f["g"])
        grad["V"], grad["U"] = f["h"].T @ dt, f["h"].T @ dg
        dh = dz * f["p"][:, None] + dt @ w["V"].T + dg @ w["U"].T
        da = dh * (1 - f["h"] ** 2)
        grad["W"], grad["b"] = xs.T @ da, da.sum(0)
        for k, g in grad.items():
            g = g + DECAY * w[k]
            first_moment[k] = 0.9 * first_moment[k] + 0.1 * g
            second_moment[k] = 0.999 * second_moment[k] + 0.001 * g * g
            w[k] -= (RATE * (first_moment[k] / (1 - 0.9**step)) / (np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            model.weights[k] = w[k]
    return model


def _parts(texts: list[bytes]) -> Iterator[list[int]]:
    """Runs of texts of about PART_BYTES, so that arrays stay small."""
    run, size = [], 0
    for i, t in enumerate(texts):
        run.append(i)
        size += len(t)
        if size >= PART_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _candidates(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """_id, _q and _size of the labelled, not held-out documents that the table has; of repeated rows the largest size."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.avg("quality").alias("_q"))
    sizes = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.octet_length(clean_text(F.col("text"))).cast("long").alias("_n"))
    sizes = sizes.where(F.col("_doc").isNotNull() & (fold(F.col("_doc")) != HELD_FOLD)).groupBy("_doc").agg(F.max("_n").alias("_size"))
    return known.join(sizes, F.col("_id") == F.col("_doc")).select("_id", "_q", "_size")


def training_bags(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES) -> DataFrame:
    """doc_id, y and passage vectors of the bounded sample of labelled, not held-out documents."""
    order = F.greatest(F.col("_size"), F.lit(max_bytes // 100)), F.xxhash64("_id"), F.col("_id")
    sample = _candidates(docs, labels).orderBy(*order).limit(max_docs)
    # The sample is bounded, so one task may order it. A text that does not fit has only texts as long after it, or is short.
    so_far = F.sum("_size").over(Window.orderBy(*order))
    sample = sample.withColumn("_sum", so_far).where(F.col("_sum") <= max_bytes).select("_id", "_q")
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), clean_text(F.col("text")).cast("binary").alias("data"))
    rows = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_id"))  # at most max_docs rows of two numbers
    rows = rows.groupBy("_id", "_q").agg(F.min("data").alias("data"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, first = bag_features([bytes(t) for t in batch["data"]])
            bags = [x[a:b].astype("<f4").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pd.DataFrame({"doc_id": batch["_id"], "y": (batch["_q"] >= 0.5).astype("int32"), "bag": bags})

    return rows.mapInPandas(run, "doc_id long, y int, bag binary")


def train(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    rows = sorted((r.doc_id, r.y, bytes(r.bag)) for r in training_bags(docs, labels, **bounds).collect())
    if len({y for _, y, _ in rows}) < 2:
        all_y = {r.y for r in _candidates(docs, labels).select((F.col("_q") >= 0.5).cast("int").alias("y")).distinct().collect()}
        if all_y != {y for _, y, _ in rows}:
            raise ValueError(f"the training sample has labels {sorted({y for _, y, _ in rows})} of {sorted(all_y)}: raise max_docs or max_bytes")
    bags = [np.frombuffer(b, "<f4").reshape(-1, N_FEATURES) for _, _, b in rows]
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64)
    x = np.concatenate(bags) if bags else np.zeros((0, N_FEATURES), np.float32)
    return fit(x, first, np.array([y for _, y, _ in rows], dtype=np.float32))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The table with a column of scores."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        data = [t.encode() for t in texts]
        out = np.zeros(len(data))
        for run in _parts(data):
            out[run] = model.score(*bag_features([data[i] for i in run]))
        return pd.Series(out)

    return docs.withColumn(score_col, scored(clean_text(F.col(text_col))))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    held = F.coalesce(fold(F.col("doc_id")) == HELD_FOLD, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
