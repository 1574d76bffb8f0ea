"""N-gram Jaccard join by chosen paths.

Texts are sets of word 5-gram hashes. A text's set is represented by ``T``
MinHash values; a value with its place is a token, and two texts share a token
with the probability of their Jaccard similarity. A run starts with all texts
in one node. A node draws tokens' places (1/threshold on average), every text
goes to the child of its value at each drawn place, and a child with two to
``LEAF`` texts is a leaf, in which all pairs of sketches are compared (in tiles,
a byte per pair). Larger children are split again, to ``DEPTH`` levels; texts
that still share a path then share so many independent tokens that they are
taken as candidates together. The number of runs follows from the target recall
of a run's choice of places at the threshold; all runs share the ``T`` values,
and a pair whose values agree in under ``SKETCH_LEAST`` of the places is found
only through other texts of its group.

Candidates only form groups (connected components of sketch matches). Inside a
group all pairs of exact 5-gram sets are verified, so a pair that no run brought
together is still found if a chain of candidates joins its texts. Groups are
verified in blocks: a group larger than ``BLOCK`` texts (or ``BLOCK_SHINGLES``
shingles) is dealt to blocks by a hash, and each pair of blocks is one unit of
work, so a group of any size is spread over tasks. Only counts per text and a
spanning forest leave a unit, never the pairs.

Equal texts are collapsed first and count by their number. The result has one
row per document: its class (smallest doc_id of the connected texts), the number
of other documents within the threshold, the number of other texts, and of
copies.

Defined cases: null text counts as empty; words are runs of other than ASCII
white space; a text with fewer than five words has one shingle of all its
words; texts without words are similar to equal texts only; repeated rows are
copies of each other; null ids take part, and a class of them only has a null
class id; texts under one id are texts like others, so their classes share that
class id; :func:`keep_one` keeps one row of each class whatever its ids; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, cut, read_table
from .graph import components

WORDS = 5
THRESHOLD = 0.8
T = 64
DEPTH = 6
LEAF = 4096
TILE = 256
RECALL = 0.9999
SKETCH_LEAST = 0.58
BLOCK = 400
BLOCK_SHINGLES = 1 << 20
KEPT_WORDS = 300_000
CHUNK = 1 << 16
DENSE = 1 << 22

_rng = np.random.default_rng(20240229)
PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
MUL = _rng.integers(1, 1 << 63, T, dtype=np.uint64) | np.uint64(1)
XOR = _rng.integers(1, 1 << 63, T, dtype=np.uint64)


class _Words(dict):
    """Hashes of recent words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value
        return value


@lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_arrays(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of the texts end to end, and the number of each text's."""
    known = _words()
    split = [t.split() for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    total = int(counts.sum())
    flat = np.fromiter((h for words in split for h in map(known.__getitem__, words)), dtype=np.uint64, count=total)
    n = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    if not total:
        return np.zeros(0, np.uint64), n
    flat = np.concatenate([flat, np.zeros(WORDS, np.uint64)])
    acc = np.zeros(total, dtype=np.uint64)
    left = np.repeat(counts, counts) - (np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts))
    for k in range(WORDS):
        acc += np.where(left > k, _mix(flat[k : k + total]) * PLACE[k], np.uint64(k + 1))
    start = np.cumsum(counts) - counts
    keep = np.repeat(start, n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
    return _mix(acc[keep]), n


def minhashes(shingles: np.ndarray, n: np.ndarray) -> np.ndarray:
    """T values (int32) for each text; 0 for texts without shingles."""
    out = np.zeros((len(n), T), dtype=np.int32)
    have = np.flatnonzero(n)
    if not len(have):
        return out
    ends = np.cumsum(n[have])
    best = np.full((len(have), T), np.iinfo(np.uint32).max, dtype=np.uint32)
    for a in range(0, len(shingles), CHUNK):
        part = shingles[a : a + CHUNK]
        lo, hi = np.searchsorted(ends, [a, a + len(part) - 1], side="right")
        starts = np.maximum(0, np.concatenate([[0], ends[lo:hi] - a]))
        for j in range(T):
            value = ((part ^ XOR[j]) * MUL[j] >> np.uint64(32)).astype(np.uint32)
            np.minimum(best[lo : hi + 1, j], np.minimum.reduceat(value, starts), out=best[lo : hi + 1, j])
    out[have] = best.view(np.int32)
    return out


def text_key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key, n (shingles), sig, sk (a byte of each value), row (unique)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shingles, n = shingle_arrays([t.encode() for t in batch["text"]])
            sig = minhashes(shingles, n)
            sketch = (sig & 0xFF).astype(np.uint8)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "key": batch["key"], "n": n, "sig": list(sig), "sk": [s.tobytes() for s in sketch]})

    text = clean_text(F.col(text_col))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text).alias("key"), text.alias("text"))
    made = source.mapInPandas(run, "doc_id long, key string, n long, sig array<int>, sk binary")
    return cut(made.withColumn("row", F.monotonically_increasing_id()), "signatures")


def run_recall(threshold: float, depth: int) -> float:
    """Least probability that one run keeps a pair at the threshold together to ``depth``."""
    extra = 1 / threshold - 1
    p = 1.0
    for _ in range(depth):
        q = threshold * p
        p = (1 - extra) * q + extra * (1 - (1 - q) ** 2)
    return p


def runs_for(threshold: float, depth: int, recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - run_recall(threshold, depth)))


def _children(nodes: DataFrame, threshold: float) -> DataFrame:
    """path, u of the children of rows with path, u, sig."""
    drawn = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(T)).cast("int")
    other = F.pmod(drawn + 1 + F.pmod(F.xxhash64("path", F.lit(2)), F.lit(T - 1)), F.lit(T)).cast("int")
    share = int((1 / threshold - 1) * 1_000_000)
    more = F.pmod(F.xxhash64("path", F.lit(3)), F.lit(1_000_000)) < share
    places = F.when(more, F.array(drawn, other)).otherwise(F.array(drawn))
    each = nodes.withColumn("place", F.explode(places))
    return each.select(F.xxhash64("path", "place", F.get(F.col("sig"), F.col("place"))).alias("path"), "u")


def leaf_edges(rows: DataFrame, least: float) -> DataFrame:
    """Star edges (a, b) between the texts of a leaf whose sketches match, over path, u, sk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            whole = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
            cut_at = int(np.searchsorted(whole["path"].to_numpy(), whole["path"].iat[-1]))
            held = [whole.iloc[cut_at:]]
            if cut_at:
                yield matches(whole.iloc[:cut_at])
        if held:
            yield matches(pd.concat(held, ignore_index=True))

    def matches(part: pd.DataFrame) -> pd.DataFrame:
        path, u = part["path"].to_numpy(), part["u"].to_numpy()
        sk = np.frombuffer(b"".join(part["sk"]), dtype=np.uint8).reshape(len(part), T)
        bounds = np.append(np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]])), len(path))
        need = math.ceil(T * (least + (1 - least) / 256))
        out: list[np.ndarray] = []
        sizes = np.diff(bounds)
        pair = bounds[:-1][sizes == 2]
        same = (sk[pair] == sk[pair + 1]).sum(1) >= need
        out.append(np.stack([u[pair[same]], u[pair[same] + 1]], 1))
        for a, b in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2], strict=True):
            root = linked(alike(sk[a:b], need))
            moved = root != np.arange(b - a)
            out.append(np.stack([u[a:b][moved], u[a:b][root[moved]]], 1))
        both = np.concatenate(out)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    dealt = rows.repartition(F.col("path")).sortWithinPartitions("path")
    return dealt.select("path", "u", "sk").mapInPandas(run, "a long, b long").distinct()


def alike(sk: np.ndarray, need: int) -> np.ndarray:
    """Which pairs of sketches (rows of bytes) agree in ``need`` places or more."""
    n = len(sk)
    columns = np.ascontiguousarray(sk.T)
    out = np.empty((n, n), dtype=bool)
    for at in range(0, n, TILE):
        same = np.zeros((min(TILE, n - at), n), dtype=np.uint8)
        for place in columns:
            same += place[at : at + TILE, None] == place[None, :]
        out[at : at + TILE] = same >= need
    return out


def linked(adjacent: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the first row of its component."""
    n = len(adjacent)
    root = np.arange(n, dtype=np.int32)
    while True:
        new = root.copy()
        for at in range(0, n, TILE):
            np.minimum(new[at : at + TILE], np.where(adjacent[at : at + TILE], root[None, :], np.int32(n)).min(1), out=new[at : at + TILE])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def candidate_groups(texts: DataFrame, threshold: float, recall: float, leaf: int, depth: int) -> DataFrame:
    """u, comp of the texts with a candidate, over u, sig, sk."""
    runs = runs_for(threshold, depth, recall)
    nodes = texts.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))).select(F.xxhash64(F.lit("run"), "run").alias("path"), "u", "sig")
    leaves, edges = None, None
    for level in range(1, depth + 1):
        children = _children(nodes, threshold)
        # Counted apart from the join, which Spark can then split where a path holds very many texts.
        counts = cut(children.groupBy("path").agg(F.count("*").alias("n_in")).where("n_in > 1"), f"counts{level}")
        shared = cut(children.join(counts.withColumnRenamed("path", "_p"), F.col("path") == F.col("_p")).select("path", "u", "n_in"), f"paths{level}")
        small = shared.where(F.col("n_in") <= leaf).select("path", "u")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = shared.where(F.col("n_in") > leaf).select("path", "u")
        if large.isEmpty():
            break
        if level == depth:
            star = large.groupBy("path").agg(F.min("u").alias("b"))
            edges = large.join(star.withColumnRenamed("path", "_p"), F.col("path") == F.col("_p")).select(F.col("u").alias("a"), "b").distinct()
        else:
            nodes = large.join(texts.select(F.col("u").alias("_u"), "sig"), F.col("u") == F.col("_u")).select("path", "u", "sig")
    sketched = leaves.join(texts.select(F.col("u").alias("_u"), "sk"), F.col("u") == F.col("_u")).select("path", "u", "sk")
    found = leaf_edges(sketched, SKETCH_LEAST)
    found = found if edges is None else found.unionByName(edges)
    return components(found).select(F.col("node").alias("u"), "comp")


def verify(rows: DataFrame, threshold: float) -> DataFrame:
    """Exact links within units of work.

    Rows: comp, i, j (the unit), own (the text's block, i or j), u, copies, text.
    Returns per unit and linked text: u, root, n_texts, n_docs.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, held = None, []
        for batch in batches:
            for key, part in batch.groupby(["comp", "i", "j"], sort=False):
                if key != unit:
                    if held:
                        yield links(unit, pd.concat(held, ignore_index=True) if len(held) > 1 else held[0])
                    unit, held = key, []
                held.append(part)
        if held:
            yield links(unit, pd.concat(held, ignore_index=True) if len(held) > 1 else held[0])

    def links(unit: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("u")
        u, copies, own = part["u"].to_numpy(), part["copies"].to_numpy(), part["own"].to_numpy()
        shingles, n = shingle_arrays([bytes(t) for t in part["text"]])
        owner = np.repeat(np.arange(len(u)), n)
        order = np.lexsort((owner, shingles))
        s, o = shingles[order], owner[order]
        fresh = np.concatenate([[True], (s[1:] != s[:-1]) | (o[1:] != o[:-1])])
        s, o = s[fresh], o[fresh]
        size = np.bincount(o, minlength=len(u))
        new = np.concatenate([[True], s[1:] != s[:-1]])
        token = np.cumsum(new) - 1
        often = np.bincount(token)[token] > 1
        token, o = token[often], o[often]
        token = np.cumsum(np.concatenate([[True], token[1:] != token[:-1]])) - 1 if len(token) else token
        a = np.flatnonzero(own == unit[1])
        b = a if unit[1] == unit[2] else np.flatnonzero(own == unit[2])
        shared = np.zeros((len(a), len(b)), dtype=np.float32)
        width = max(64, DENSE // len(u))
        n_tokens = int(token[-1]) + 1 if len(token) else 0
        for at in range(0, n_tokens, width):
            lo, hi = np.searchsorted(token, [at, at + width])
            m = np.zeros((len(u), min(width, n_tokens - at)), dtype=np.float32)
            m[o[lo:hi], token[lo:hi] - at] = 1
            shared += m[a] @ m[b].T
        union = size[a][:, None] + size[b][None, :] - shared
        near = (shared >= threshold * union - 1e-6) & (union > 0)
        if unit[1] == unit[2]:
            np.fill_diagonal(near, False)
            root = linked(near)
            n_texts, n_docs = near.sum(1), near @ copies
            have, top, who = n_texts > 0, u[a][root], u[a]
        else:
            size_a, size_b = len(a), len(b)
            square = np.zeros((size_a + size_b, size_a + size_b), dtype=bool)
            square[:size_a, size_a:], square[size_a:, :size_a] = near, near.T
            who = np.concatenate([u[a], u[b]])
            top = who[linked(square)]
            n_texts = np.concatenate([near.sum(1), near.sum(0)])
            n_docs = np.concatenate([near @ copies[b], copies[a] @ near])
            have = n_texts > 0
        return pd.DataFrame({"u": who[have], "root": top[have], "n_texts": n_texts[have].astype("i8"), "n_docs": n_docs[have].astype("i8")})

    dealt = rows.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    return dealt.select("comp", "i", "j", "own", "u", "copies", "text").mapInPandas(run, "u long, root long, n_texts long, n_docs long")


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, leaf: int = LEAF, depth: int = DEPTH,
    block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, class_id, n_links, n_texts, n_copies, key, class_row: one row per row of ``docs``.

    ``class_row`` numbers the class; two classes have one ``class_id`` if they share an id, or if neither has any.
    """
    if not 0.5 <= threshold <= 1:
        raise ValueError("the threshold must be from 0.5 to 1")
    signed = signatures(docs, id_col, text_col)
    groups = signed.groupBy("key").agg(F.min("row").alias("u"), F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    groups = cut(groups, "texts")
    texts = cut(signed.where("n > 0").join(groups.select("u"), F.col("row") == F.col("u"), "left_semi").select(F.col("row").alias("u"), "n", "sig", "sk"), "unique")
    found = candidate_groups(texts, threshold, recall, leaf, depth)
    sized = found.join(texts.select(F.col("u").alias("_u"), "n"), F.col("u") == F.col("_u")).select("u", "comp", "n")
    blocks = sized.groupBy("comp").agg(
        F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("k")
    )
    members = found.join(blocks.withColumnRenamed("comp", "_c"), F.col("comp") == F.col("_c")).select("u", "comp", "k")
    members = members.join(groups.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).select("u", "comp", "k", "rep", "copies", "key")
    text = clean_text(F.col(text_col))
    source = docs.select(F.col(id_col).cast("long").alias("_id"), text.cast("binary").alias("text"), text_key(text).alias("_key"))
    # One row per text: equal texts under one id meet only if rows repeat, and verify() drops those.
    held = members.join(source, F.col("rep").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    own = F.pmod(F.xxhash64("u"), F.col("k")).cast("int")
    held = held.withColumn("own", own).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    units = held.select("comp", F.least("own", "_j").alias("i"), F.greatest("own", "_j").alias("j"), "own", "u", "copies", "text", "k")
    links = cut(verify(units, threshold), "links")
    counts = links.groupBy("u").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    joined = components(links.where("u <> root").select(F.col("u").alias("a"), F.col("root").alias("b")))
    labelled = joined.join(groups.select(F.col("u").alias("_u"), "rep"), F.col("node") == F.col("_u"))
    classes = labelled.groupBy("comp").agg(F.min("rep").alias("class_rep")).withColumnRenamed("comp", "_c")
    of_text = joined.join(classes, F.col("comp") == F.col("_c")).select("node", "comp", "class_rep")
    per_text = (
        groups.join(counts.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u"), "left")
        .join(of_text, F.col("u") == F.col("node"), "left")
        .select(F.col("key").alias("_key"), F.coalesce("comp", "u").alias("class_row"), F.coalesce("class_rep", "rep").alias("class_id"), "copies",
                F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"), F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"))
    )
    out = signed.select("doc_id", "key").join(per_text, F.col("key") == F.col("_key"))
    return out.select(
        "doc_id", "class_id", (F.col("copies") - 1 + F.col("n_docs")).cast("long").alias("n_links"), "n_texts",
        F.col("copies").cast("long").alias("n_copies"), "key", "class_row",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each class: that of the smallest id (null after all others), then of the smallest MD5 of the text."""
    classes = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    own, kept_id, kept_key = "_tessella_key", "_tessella_id", "_tessella_kept"
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    kept = classes.groupBy("class_row").agg(first).select(F.col("first.doc_id").alias(kept_id), F.col("first.key").alias(kept_key))
    kept = cut(kept, "kept")
    keyed = docs.withColumn(own, text_key(clean_text(F.col(text_col))))
    joined = keyed.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_key)), "left_semi")
    # Of rows that repeat id and text one stays; sought among the kept rows' keys only where there are such.
    rows = docs.select(F.col(id_col).cast("long").alias("i"), text_key(clean_text(F.col(text_col))).alias("k"))
    if rows.groupBy("i", "k").count().where("count > 1").isEmpty():
        return joined.drop(own)
    number = "_tessella_number"
    joined = cut(joined.withColumn(number, F.monotonically_increasing_id()), "representatives")
    once = joined.groupBy(F.col(id_col).cast("long").alias(kept_id), F.col(own).alias(kept_key)).agg(F.min(number).alias("_tessella_least"))
    return joined.join(once.select("_tessella_least"), F.col(number) == F.col("_tessella_least"), "left_semi").drop(own, number)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("key", "class_row")


ORACLE_OP2 = """
with recursive t as (select coalesce(text, '') as text, min(doc_id) as rep, count(*) as copies from documents group by 1),
w as (select text, list_filter(regexp_split_to_array(text, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') as w from t),
s as (select text, unnest(list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as g from w),
n as (select text, count(*) as n from s group by text),
p as (select x.text as a, y.text as b, count(*) as shared from s x join s y on x.g = y.g and x.text <> y.text group by all),
l as (select a, b from p join n na on a = na.text join n nb on b = nb.text where 5 * shared >= 4 * (na.n + nb.n - shared)),
r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
c as (select a as text, min(t.rep) as least from r join t on r.b = t.text group by a),
q as (select a as text, count(*) as n_texts, sum(copies)::bigint as n_docs from l join t on l.b = t.text group by a),
u as (select t.text, least(t.rep, coalesce(c.least, t.rep)) as class_id, copies - 1 + coalesce(n_docs, 0) as n_links, coalesce(n_texts, 0) as n_texts, copies as n_copies
  from t left join c on t.text = c.text left join q on t.text = q.text)
select doc_id, class_id, n_links, n_texts, n_copies from documents d join u on coalesce(d.text, '') = u.text
"""
