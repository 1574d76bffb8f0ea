"""TF-IDF weights of word 1- to 3-grams, with only those grams counted that can still be among the chosen terms.

A gram stands in no more places and documents than each of its words. So words are
counted first; the number of places of the last word that would be chosen is the least
that any longer gram needs, and pairs are counted of words that have it, triples of
pairs that have what pairs and words ask for. Grams are numbers in the tasks' arrays.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile("[a-z0-9]+")
#: Words whose counts a task holds before it hands them on.
HELD_WORDS = 1 << 20


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[str]], np.ndarray]]:
    """Documents of a batch, the words of their texts, and which document each text is of. Rows come sorted; none is cut."""
    docs, texts, of = [], [], []
    for batch in batches:
        done = len(of)
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not docs or doc != docs[-1]:
                docs.append(doc)
            texts.append(WORD.findall(text or ""))
            of.append(len(docs) - 1)
        last = of.index(len(docs) - 1) if of else 0
        if last and len(of) > done:
            yield docs[:-1], texts[:last], np.array(of[:last], np.int64)
            docs, texts, of = docs[-1:], texts[last:], [0] * (len(of) - last)
    if of:
        yield docs, texts, np.array(of, np.int64)


def _codes(texts: list[list[str]], of: np.ndarray, ids: dict[str, int], pairs: np.ndarray | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of known words (and, of triples, known pairs) as numbers, and their documents."""
    size = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((ids.get(w, -1) for t in texts for w in t), np.int64, int(size.sum()))
    text, doc = np.repeat(np.arange(len(texts)), size), np.repeat(of, size)
    if n == 1:
        return words[words >= 0], doc[words >= 0]
    first, second = words[:-1], words[1:]
    code = np.where((first >= 0) & (second >= 0) & (text[:-1] == text[1:]), first * len(ids) + second, -1)
    doc = doc[:-1]
    if n == 3:
        place = np.searchsorted(pairs, code) if len(pairs) else np.zeros(len(code), np.int64)
        known = (code >= 0) & (place < len(pairs)) & (pairs[np.minimum(place, len(pairs) - 1)] == code) if len(pairs) else np.zeros(len(code), bool)
        code = np.where(known[:-1] & known[1:], place[:-1] * len(ids) + words[2:], -1)
        doc = doc[:-1]
    return code[code >= 0], doc[code >= 0]


def _per_document(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, number and count of each document's different numbers, in the order of documents."""
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])])[: len(code)])
    return doc[new], code[new], np.diff(np.append(new, len(code)))


def _words(held: DataFrame) -> DataFrame:
    """term, df, total of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, df = Counter(), Counter()

        def told() -> pa.RecordBatch:
            terms = list(total)
            return pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()), "df": pa.array([df[t] for t in terms], pa.int64()), "total": pa.array([total[t] for t in terms], pa.int64())})

        for _, texts, of in _documents(batches):
            own, at = set(), None
            for words, doc in zip(texts, of.tolist(), strict=True):
                if doc != at:
                    df.update(own)
                    own, at = set(), doc
                own.update(words)
                total.update(words)
            df.update(own)
            if len(total) >= HELD_WORDS:
                yield told()
                total.clear()
                df.clear()
        if total:
            yield told()

    return held.mapInArrow(run, "term string, df long, total long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def _longer(held: DataFrame, shared, n: int) -> DataFrame:
    """code, df, total of pairs of known words or triples of known pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, pairs = shared.value
        for _, texts, of in _documents(batches):
            _, code, c = _per_document(*_codes(texts, of, ids, pairs, n))
            used, which, df = np.unique(code, return_inverse=True, return_counts=True)
            total = np.bincount(which, c, len(used)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"code": pa.array(used, pa.int64()), "df": pa.array(df, pa.int64()), "total": pa.array(total, pa.int64())})

    return held.mapInArrow(run, "code long, df long, total long").groupBy("code").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def weights(docs: DataFrame, doc: str, text: str, n_docs: int, min_df: int = 3, max_df: float = 0.85, features: int = 7500) -> DataFrame:
    """doc, term, weight, as ``models.tf_idf`` of ``models.word_grams`` has them."""
    context = docs.sparkSession.sparkContext
    held = docs.select(doc, F.lower(text).alias("t")).repartition(doc).sortWithinPartitions(doc).checkpoint()
    found: list[tuple[str, int, int]] = []  # terms that may be chosen

    def least() -> int:
        totals = sorted((total for _, _, total in found), reverse=True)
        return totals[features - 1] if len(totals) >= features else min_df

    def counted(rows: DataFrame, known: int) -> list:
        """What reaches the least total; of words, the least is first found from the most frequent ones."""
        able = rows.where(F.col("df") >= min_df).checkpoint()
        right = able.where(F.col("df") <= max_df * n_docs)
        top = [r["total"] for r in right.select("total").orderBy(F.col("total").desc()).limit(features).collect()]
        need = max(known, top[-1] if len(top) == features else min_df)
        return able.where(F.col("total") >= need).collect()

    def keep(rows: list, names: list[str]) -> None:
        found.extend((t, r["df"], r["total"]) for t, r in zip(names, rows, strict=True) if r["df"] <= max_df * n_docs)

    rows = sorted(counted(_words(held), min_df), key=lambda r: r["term"])
    words = [r["term"] for r in rows]
    ids = {w: i for i, w in enumerate(words)}
    keep(rows, words)
    rows = sorted(counted(_longer(held, context.broadcast((ids, None)), 2), least()), key=lambda r: r["code"])
    pairs = np.array([r["code"] for r in rows], np.int64)
    spoken = [f"{words[c // len(words)]} {words[c % len(words)]}" for c in pairs.tolist()]
    keep(rows, spoken)
    rows = counted(_longer(held, context.broadcast((ids, pairs)), 3), least())
    triples = [r["code"] for r in rows]
    keep(rows, [f"{spoken[c // len(words)]} {words[c % len(words)]}" for c in triples])
    numbers = ids | {t: c for t, c in zip(spoken, pairs.tolist(), strict=True)} | {f"{spoken[c // len(words)]} {words[c % len(words)]}": c for c in triples}
    chosen = sorted(found, key=lambda x: (-x[2], x[0]))[:features]
    by_size = []
    for n in (1, 2, 3):
        own = sorted((numbers[t], t, df) for t, df, _ in chosen if t.count(" ") == n - 1)
        by_size.append((np.array([c for c, _, _ in own], np.int64), [t for _, t, _ in own], np.array([np.log((1 + n_docs) / (1 + df)) + 1 for _, _, df in own])))
    shared = context.broadcast((ids, pairs, by_size))
    kind = docs.schema[doc].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_, pairs_, sizes = shared.value
        for names, texts, of in _documents(batches):
            parts = []
            begin = 0
            for n, (codes, _, idf) in enumerate(sizes, 1):
                if len(codes):
                    code, at = _codes(texts, of, ids_, pairs_, n)
                    place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    used = codes[place] == code
                    d, k, c = _per_document(place[used], at[used])
                    parts.append((d, k + begin, (1 + np.log(c)) * idf[k]))
                begin += len(codes)
            if not parts:
                continue
            d, k, w = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(d, kind="stable")
            d, k, w = d[order], k[order], w[order]
            w = w / np.sqrt(np.bincount(d, w * w, len(names)))[d]
            terms = [t for _, own, _ in sizes for t in own]
            yield pa.RecordBatch.from_pydict({
                doc: pa.array([names[i] for i in d.tolist()], arrow_type), "term": pa.array([terms[i] for i in k.tolist()], pa.string()), "weight": pa.array(w, pa.float64()),
            })

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_type = to_arrow_type(kind)
    return held.mapInArrow(run, f"`{doc}` {kind.simpleString()}, term string, weight double")
