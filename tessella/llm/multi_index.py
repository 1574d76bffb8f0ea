"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised by its own codebook, so that ``k1 * k2`` pairs
of centroids divide all vectors into cells. A query ranks the centroids of both
halves and walks their pairs by summed distance (less the inner products of its
halves with the two centroids) with a heap, until the cells passed hold as many
entries as the index asks for; the entries of those cells are scored exactly.

The number of entries comes from a calibration: for ``CALIBRATE`` queries the
exact neighbours are found by one scan of the table, and the walk has to pass the
cells of a ``TARGET`` share of them. Codebooks are fitted on ``SAMPLE`` vectors at
most; every vector is indexed.

Entries are packed into blocks by the first centroid, and queries of one batch
that pass a cell of that centroid travel as one row; both meet through an
equi-join on (length, first centroid, block). A crowded cell is many blocks, and
queries are repeated for the blocks they read, never for vectors.

Defined cases: rows without an id take no part, nor vectors that are null, zero or
hold null or non-finite components; vectors of different length are never
compared; ties go to the smaller id; rows that repeat an id are candidates each,
a query leaves out all rows of its own id, and of rows that repeat a query's id
the least vector asks; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, partitions_for, read_table

TOP = 20
QUERY_EVERY = 20
SAMPLE = 16384
CALIBRATE = 256
TARGET = 0.95
MOST_CODES = 512
ENTRIES_EACH = 4096
QUERIES_EACH = 512


@dataclass
class Index:
    """What the walk needs for vectors of one length: codebooks, entries a cell, entries to pass."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    enough: int


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (array of double) and dim of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = rows.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return held.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim"))


def codes_for(rows: int) -> int:
    """Centroids a half: the cells' number grows with the root of the rows."""
    return min(MOST_CODES, max(8, round(2 * rows**0.25)))


def _square_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(axis=1) - 2.0 * (x @ centres.T)


def k_means(x: np.ndarray, codes: int, seed: int, rounds: int = 15) -> np.ndarray:
    """Centroids of the rows of ``x``, at most ``codes``, by Lloyd's rounds from distinct rows."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:codes]].copy()
    for _ in range(rounds):
        own = _square_distances(x, centres).argmin(axis=1)
        size = np.bincount(own, minlength=len(centres))
        for d in range(x.shape[1]):
            total = np.bincount(own, weights=x[:, d], minlength=len(centres))
            centres[size > 0, d] = total[size > 0] / size[size > 0]
    return centres


def fit_codebooks(vectors: DataFrame, sizes: dict[int, int], sample: int = SAMPLE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length the two codebooks, each fitted in one task on a bounded sample."""
    share = F.create_map(*[F.lit(z) for dim, n in sizes.items() for z in (dim, min(1.0, 1.1 * sample / n))])
    drawn = vectors.where(F.rand(17) < share[F.col("dim")])

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        x = np.stack(group["v"].to_numpy())[:sample]
        codes = codes_for(sizes[dim])
        books = [k_means(half, codes, dim) for half in (x[:, : dim // 2], x[:, dim // 2 :])]
        return pd.DataFrame([(dim, *(b.astype("<f8").tobytes() for b in books))], columns=["dim", "first", "second"])

    found = drawn.select("dim", "v").groupBy("dim").applyInPandas(fit, "dim int, first binary, second binary").collect()
    books = {}
    for row in found:
        half = row["dim"] // 2
        # One-dimensional vectors have an empty first half and one code for it.
        first = np.frombuffer(row["first"], "<f8").reshape(-1, half) if half else np.zeros((1, 0))
        books[row["dim"]] = (first, np.frombuffer(row["second"], "<f8").reshape(-1, row["dim"] - half))
    for dim in sizes:
        # A length of so few rows that none was drawn is one cell.
        books.setdefault(dim, (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2))))
    return books


def by_dim(batch: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    for dim, part in batch.groupby("dim", sort=True):
        yield int(dim), part, np.stack(part["v"].to_numpy())


def encode(vectors: DataFrame, books: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """id, dim, v and the numbers of the two centroids, i and j."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part, x in by_dim(batch):
                first, second = books[dim]
                i = _square_distances(x[:, : dim // 2], first).argmin(axis=1)
                j = _square_distances(x[:, dim // 2 :], second).argmin(axis=1)
                yield pd.DataFrame({"id": part["id"].to_numpy(), "dim": dim, "i": i, "j": j, "v": part["v"].to_numpy()})

    return vectors.select("id", "dim", "v").mapInPandas(run, "id long, dim int, i int, j int, v array<double>")


def walk(q: np.ndarray, index: Index, enough: int) -> list[tuple[int, int]]:
    """Non-empty cells by summed distance until they hold ``enough`` entries.

    Of pairs (a, b) of ranks, (a, b + 1) is pushed when (a, b) is taken, and
    (a + 1, 0) with the first of a row, so each pair is pushed once and no later
    than its turn.
    """
    half = index.first.shape[1]
    one, two = index.first @ q[:half], index.second @ q[half:]
    a_order, b_order = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    da, db = (-one[a_order]).tolist(), (-two[b_order]).tolist()
    a_order, b_order = a_order.tolist(), b_order.tolist()
    counts = index.counts
    heap, out, held = [(da[0] + db[0], 0, 0)], [], 0
    while heap and held < enough:
        _, a, b = heapq.heappop(heap)
        if b + 1 < len(db):
            heapq.heappush(heap, (da[a] + db[b + 1], a, b + 1))
        if b == 0 and a + 1 < len(da):
            heapq.heappush(heap, (da[a + 1] + db[0], a + 1, 0))
        cell = a_order[a], b_order[b]
        size = counts[cell]
        if size:
            out.append(cell)
            held += size
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id, best first."""
    able = np.flatnonzero(scores > -np.inf)
    if len(able) > k:
        worst = np.partition(scores[able], len(able) - k)[len(able) - k]
        able = able[scores[able] >= worst]
    return able[np.lexsort((ids[able], -scores[able]))][:k]


def score_block(q: np.ndarray, q_ids: np.ndarray, passed: np.ndarray, x: np.ndarray, ids: np.ndarray, j: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query id, id, score) of the k best entries of one block for each query, of the cells it passed."""
    some = passed.any(axis=0)[j]
    x, ids, j = x[some], ids[some], j[some]
    if not len(ids):
        return []
    rough = q @ x.T
    rough[~passed[:, j]] = -np.inf
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    # A product of matrices may round equal vectors apart; candidates within that error are scored one by one.
    slack = 1e-12 * np.abs(q).sum(axis=1) * max(1e-300, float(np.abs(x).max()))
    out: list[tuple[int, int, float]] = []
    for r in range(len(q)):
        row = rough[r]
        near = np.flatnonzero(row > -np.inf)
        if len(near) > k:
            near = near[row[near] >= np.partition(row[near], len(near) - k)[len(near) - k] - slack[r]]
        exact = (x[near] * q[r]).sum(axis=1)
        out += [(int(q_ids[r]), int(ids[near[t]]), float(exact[t])) for t in _best(exact, ids[near], k)]
    return out


def neighbour_cells(entries: DataFrame, asking: list, k: int) -> DataFrame:
    """The cells of the k exact neighbours of a bounded number of queries, by one scan."""
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in asking}:
        own = [r for r in asking if r["dim"] == dim]
        queries[dim] = (np.array([r["id"] for r in own]), np.array([r["v"] for r in own], float))
    shared = entries.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[list]] = {dim: [[] for _ in ids] for dim, (ids, _) in shared.value.items()}
        for batch in batches:
            for dim, part, x in by_dim(batch):
                if dim not in held:
                    continue
                q_ids, q = shared.value[dim]
                ids, i, j = (part[c].to_numpy() for c in ("id", "i", "j"))
                scores = q @ x.T
                scores[q_ids[:, None] == ids[None, :]] = -np.inf
                for r, row in enumerate(scores):
                    now = [(float(row[t]), -int(ids[t]), int(i[t]), int(j[t])) for t in _best(row, ids, k)]
                    held[dim][r] = heapq.nlargest(k, held[dim][r] + now)
        out = [(dim, int(shared.value[dim][0][r]), s, -m, i, j) for dim, rows in held.items() for r, kept in enumerate(rows) for s, m, i, j in kept]
        yield pd.DataFrame(out, columns=["dim", "query_id", "score", "id", "i", "j"])

    found = entries.select("id", "dim", "i", "j", "v").mapInPandas(run, "dim int, query_id long, score double, id long, i int, j int")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")


def build(entries: DataFrame, books: dict[int, tuple[np.ndarray, np.ndarray]], asking: DataFrame, k: int, target: float = TARGET) -> dict[int, Index]:
    """The index of each length; the entries to pass are those that ``target`` of the sampled neighbours ask for."""
    counts = {dim: np.zeros((len(a), len(b)), np.int64) for dim, (a, b) in books.items()}
    for row in entries.groupBy("dim", "i", "j").count().collect():
        counts[row["dim"]][row["i"], row["j"]] = row["count"]
    # A query passes over the rows of its own id, so these come on top.
    same = entries.groupBy("id").count().agg(F.max("count")).first()[0] or 0
    index = {dim: Index(*books[dim], counts[dim], k + same) for dim in books}
    drawn = asking.orderBy(F.xxhash64("id", F.lit("calibrate")), "id").limit(CALIBRATE).collect()
    vectors = {r["id"]: np.array(r["v"], float) for r in drawn}
    need: dict[int, list[int]] = {dim: [] for dim in books}
    cells: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for row in neighbour_cells(entries, drawn, k).collect():
        cells.setdefault((row["dim"], row["query_id"]), []).append((row["i"], row["j"]))
    for (dim, query), wanted in cells.items():
        order = walk(vectors[query], index[dim], int(counts[dim].sum()) + 1)
        before = np.cumsum([counts[dim][c] for c in order])
        place = {c: int(n) for c, n in zip(order, before, strict=True)}
        need[dim] += [place[c] for c in wanted]
    for dim, found in need.items():
        if found:
            index[dim].enough = max(index[dim].enough, int(np.quantile(found, target, method="higher")))
        else:
            # No query of this length was drawn: all its cells are passed.
            index[dim].enough = int(counts[dim].sum()) + 1
    return index


def _entry_blocks(entries: DataFrame, index: dict[int, Index], each: int) -> tuple[DataFrame, DataFrame]:
    """Entries packed by (dim, i, block), and the number of blocks of every (dim, i)."""
    sizes = [(dim, i, int(-(-n // each))) for dim, x in index.items() for i, n in enumerate(x.counts.sum(axis=1)) if n]
    spark = entries.sparkSession
    blocks = spark.createDataFrame(sizes, "dim int, i int, blocks int")
    dealt = entries.withColumn("_n", F.monotonically_increasing_id()).join(F.broadcast(blocks), ["dim", "i"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("_n"), F.col("blocks")).cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, js, vs = None, [], [], []

        def flush() -> pd.DataFrame:
            packed = np.array(ids, "<i8").tobytes(), np.array(js, "<i4").tobytes(), np.array(vs, "<f8").tobytes()
            return pd.DataFrame([(*key, *packed)], columns=["dim", "i", "block", "ids", "js", "vs"])

        # Rows come sorted, so a block is a run of rows.
        for batch in batches:
            for dim, i, block, id_, j, v in zip(batch["dim"], batch["i"], batch["block"], batch["id"], batch["j"], batch["v"], strict=True):
                if key != (dim, i, block):
                    if key is not None:
                        yield flush()
                    key, ids, js, vs = (dim, i, block), [], [], []
                ids.append(id_)
                js.append(j)
                vs.append(v)
        if key is not None:
            yield flush()

    n = max(1, sum(s[2] for s in sizes))
    dealt = dealt.select("dim", "i", "block", "id", "j", "v").repartition(n, "dim", "i", "block").sortWithinPartitions("dim", "i", "block", "id")
    return dealt.mapInPandas(run, "dim int, i int, block int, ids binary, js binary, vs binary"), blocks


def _query_rows(asking: DataFrame, index: dict[int, Index], n: int, each: int) -> DataFrame:
    """Per batch of queries and first centroid one row: the queries that pass a cell of it, and which cells."""
    shared = asking.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part, q in by_dim(batch):
                own, ids = shared.value[dim], part["id"].to_numpy()
                passed = np.zeros((len(own.first), len(q), len(own.second)), bool)
                for r in range(len(q)):
                    cells = walk(q[r], own, own.enough)
                    passed[[c[0] for c in cells], r, [c[1] for c in cells]] = True
                rows = []
                for i in range(len(own.first)):
                    who = np.flatnonzero(passed[i].any(axis=1))
                    if len(who):
                        rows.append((dim, i, ids[who].astype("<i8").tobytes(), q[who].astype("<f8").tobytes(), np.packbits(passed[i][who], axis=1).tobytes()))
                yield pd.DataFrame(rows, columns=["dim", "i", "q_ids", "qs", "passed"])

    dealt = asking.repartition(partitions_for(n, each), "id")
    return dealt.select("id", "dim", "v").mapInPandas(run, "dim int, i int, q_ids binary, qs binary, passed binary")


def search(rows: DataFrame, is_query: Column, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding", target: float = TARGET, entries_each: int = ENTRIES_EACH, queries_each: int = QUERIES_EACH) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows found for every query row.

    ``is_query`` is a Column over ``id``.
    """
    vectors = cut(usable_vectors(rows, id_col, vector_col), "vectors")
    sizes = {r["dim"]: r["count"] for r in vectors.groupBy("dim").count().collect()}
    books = fit_codebooks(vectors, sizes) if sizes else {}
    entries = cut(encode(vectors, books), "entries")
    asking = cut(vectors.where(is_query).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q")).select("id", "q.*"), "queries")
    index = build(entries, books, asking, k, target)
    seconds = {dim: len(x.second) for dim, x in index.items()}
    blocks, sizes_of = _entry_blocks(entries, index, entries_each)
    queries = _query_rows(asking, index, asking.count(), queries_each).join(F.broadcast(sizes_of), ["dim", "i"])
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    met = queries.join(blocks, ["dim", "i", "block"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                q_ids, ids = np.frombuffer(row.q_ids, "<i8"), np.frombuffer(row.ids, "<i8")
                passed = np.frombuffer(row.passed, np.uint8).reshape(len(q_ids), -1)
                passed = np.unpackbits(passed, axis=1, count=seconds[row.dim]).astype(bool)
                q, x = (np.frombuffer(b, "<f8").reshape(-1, row.dim) for b in (row.qs, row.vs))
                yield pd.DataFrame(score_block(q, q_ids, passed, x, ids, np.frombuffer(row.js, "<i4"), k), columns=["query_id", "vec_id", "score"])

    found = met.mapInPandas(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_EVERY == 0)
