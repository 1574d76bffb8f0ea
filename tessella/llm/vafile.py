"""Exact top-k search by vector-approximation files.

The approximation file keeps, for every distinct vector and dimension, the number
of an equal-width cell between the dimension's least and largest value (``bits``
bits), and no exact values. For a query the cells give a lower and an upper bound
of the inner product.

1. The scan reads the cells alone. Each block of queries meets each block of cells
   once, through an equi-join on the block number, and leaves the vectors whose
   upper bound reaches the block's k-th lower bound; the k-th lower bound over all
   blocks then cuts these further.
2. Exact vectors are joined to what is left, in the order of the upper bounds:
   first ``FIRST`` times k of each query, then those whose upper bound reaches the
   k-th score found so far. After that no bound that is left reaches it.

Copies of a vector are one entry of both files with the k + 1 smallest of their
ids; a query leaves out its own, so no more can be among its k best.

All is integer arithmetic: components become ``floor(scale * x)``.

Defined cases: vectors that are null or hold null or non-finite components take
no part, nor do rows without an id; vectors of different length are never
compared; empty vectors score 0; ties go to the smaller id; rows that repeat
an id are candidates each, a query leaves out all rows of its own id, and of
rows that repeat a query's id the least vector (the shorter first) asks;
rows with components beyond the range of exact doubles (2^22, less for over 128
dimensions) have no cells: they, and all rows for a query out of reach, are scored
in Python's integers, block by block; components or scores beyond 64 bits raise an
error; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, partitions_for, read_table

SCALE = 256
CLIP = 1 << 22
BITS = 6
TOP = 5
FIRST = 4
BROADCAST_DIMS = 1_000_000
QUERY_EVERY = 50
CANDIDATES_EACH = 8192
QUERIES_EACH = 1024
#: Larger files have blocks up to four times as long, so that fewer of them leave their own best.
CELL_BLOCKS = 48
#: Pairs of a query and an entry that a task holds bounds of at once.
SCAN_PAIRS = 1 << 22


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """id and v (array of int) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = lambda x: F.when(F.abs(x * scale) < F.lit(2.0**63), F.floor(x * scale)).otherwise(F.raise_error(F.lit("a scaled component exceeds 64 bits")))
    scaled = F.transform(v, lambda x: whole(x).cast("long"))
    return rows.where(F.col(id_col).isNotNull() & v.isNotNull() & finite).select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))


def fit_cells(vectors: DataFrame, bits: int = BITS) -> DataFrame:
    """Per vector length: the least value and the cell width of each dimension, over all rows in reach."""
    per = (
        vectors.where(in_reach(F.col("v"))).select(F.size("v").alias("dim"), F.posexplode("v").alias("pos", "x"))
        .groupBy("dim", "pos").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    )
    width = F.greatest(F.ceil((F.col("hi") - F.col("lo") + 1) / (1 << bits)).cast("int"), F.lit(1))
    cells = F.array_sort(F.collect_list(F.struct("pos", F.col("lo").cast("int").alias("lo"), width.alias("width"))))
    return per.groupBy("dim").agg(cells.alias("c")).select("dim", F.col("c.lo").alias("lo"), F.col("c.width").alias("width"))


def in_reach(v: Column) -> Column:
    """Whether inner products of such vectors, and their bounds, are exact as doubles."""
    reach = F.least(F.lit(float(CLIP)), F.floor(F.sqrt(F.lit(2.0**51) / F.greatest(F.size(v), F.lit(1)))))
    return F.forall(v, lambda x: (x <= reach) & (x >= -reach))


def entries_of(vectors: DataFrame, k: int) -> DataFrame:
    """key, dim, v, near, members: each distinct vector once, with the k + 1 smallest ids that have it and their numbers of rows.

    The rank's limit is applied before rows are dealt by vector too, so a vector that many rows share is no hot group.
    """
    each = vectors.groupBy("v", "id").agg(F.count("*").alias("n"))
    first = each.withColumn("_r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("_r") <= k + 1)
    members = first.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("id", F.least("n", F.lit(k)).cast("int").alias("n")))).alias("members"))
    return members.select(F.monotonically_increasing_id().alias("key"), F.size("v").alias("dim"), "v", in_reach(F.col("v")).alias("near"), "members")


def _blocks(rows: DataFrame, n_blocks: int, exact: bool) -> DataFrame:
    """Rows (dim, key, one, two, v, lo, width) packed by (dim, block).

    A block holds keys, the two smallest ids of each entry (-1 and no flag where there is one only), and either
    the exact values or the cell numbers as bytes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by (dim, block), so a block is a run of rows.
        at, held, cell = None, [], None

        def flush() -> pd.DataFrame:
            dim = at[0]
            v = np.array([h[4] for h in held], dtype="<i8").reshape(len(held), dim)
            lo, width = cell
            values = v.astype("<i8") if exact else ((v - lo) // width).astype(np.uint8)
            ids = [np.array([h[i] for h in held], t).tobytes() for i, t in enumerate(("<i8", "<i8", "<i8", "?"))]
            return pd.DataFrame([(*at, *ids, values.tobytes(), lo.tobytes(), width.tobytes())], columns=["dim", "block", "keys", "one", "two", "more", "vectors", "lo", "width"])

        for batch in batches:
            for dim, block, key, one, two, more, v, lo, width in zip(*(batch[c] for c in ("dim", "block", "key", "one", "two", "more", "v", "lo", "width")), strict=True):
                if at != (dim, block):
                    if at is not None:
                        yield flush()
                    at, held = (dim, block), []
                    cell = np.array(lo if lo is not None else [0] * dim, "<i4"), np.array(width if width is not None else [1] * dim, "<i4")
                held.append((key, one, two, more, v))
        if at is not None:
            yield flush()

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int"))
    dealt = dealt.repartition(n_blocks, "block").sortWithinPartitions("dim", "block", "key")
    return dealt.select("dim", "block", "key", "one", "two", "more", "v", "lo", "width").mapInPandas(
        run, "dim int, block int, keys binary, one binary, two binary, more binary, vectors binary, lo binary, width binary"
    )


def lower_bounds(q: np.ndarray, cells: np.ndarray, lo: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds of the inner products of all pairs of a query and an entry, and how far above them each query's upper bounds lie."""
    base = (lo + cells.astype(np.int64) * width).astype(np.float64)
    span = (width - 1).astype(np.float64)
    qf = q.astype(np.float64)
    return qf @ base.T + (np.minimum(qf, 0) @ span)[:, None], np.abs(qf) @ span


def bounds(q: np.ndarray, cells: np.ndarray, lo: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of all pairs of a query and an entry."""
    low, gap = lower_bounds(q, cells, lo, width)
    return low, low + gap[:, None]


def scan_cells(q: np.ndarray, q_ids: np.ndarray, keys: np.ndarray, one: np.ndarray, more: np.ndarray, cells: np.ndarray, lo: np.ndarray, width: np.ndarray, k: int) -> pd.DataFrame:
    """query_id, key, low, up of the entries of a block that its own k-th lower bound leaves."""
    n = max(1, SCAN_PAIRS // max(len(keys), 1))
    out = [_scan_some(q[at : at + n], q_ids[at : at + n], keys, one, more, cells, lo, width, k) for at in range(0, len(q_ids), n)]
    return pd.concat(out)


def _scan_some(q: np.ndarray, q_ids: np.ndarray, keys: np.ndarray, one: np.ndarray, more: np.ndarray, cells: np.ndarray, lo: np.ndarray, width: np.ndarray, k: int) -> pd.DataFrame:
    low, gap = lower_bounds(q, cells, lo, width)
    # A query leaves out entries that are its own row only.
    single = np.flatnonzero(~more)
    single = single[np.argsort(one[single], kind="stable")]
    first, last = (np.searchsorted(one[single], q_ids, side) for side in ("left", "right"))
    for i in np.flatnonzero(first < last):
        low[i, single[first[i] : last[i]]] = -np.inf
    least = np.partition(low, len(keys) - k, axis=1)[:, len(keys) - k] if len(keys) > k else np.full(len(q_ids), -np.inf)
    i, j = np.nonzero((low >= (least - gap)[:, None]) & (low > -np.inf))
    return pd.DataFrame({"query_id": q_ids[i], "key": keys[j], "low": low[i, j], "up": low[i, j] + gap[i]})


def scan_exact(q: np.ndarray, q_ids: np.ndarray, keys: np.ndarray, one: np.ndarray, two: np.ndarray, more: np.ndarray, exact: np.ndarray, k: int) -> pd.DataFrame:
    """query_id, key, score of the k best entries of a block, in Python's integers."""
    wide = exact.astype(object)
    out = []
    for i, id_ in enumerate(q_ids):
        able = np.flatnonzero(more | (one != id_))
        scores = wide[able] @ q[i].astype(object) if q.shape[1] and len(able) else np.zeros(len(able), object)
        # Of entries with one score that with the smallest other id comes first.
        other = np.where(one[able] != id_, one[able], two[able])
        best = sorted((-int(s), int(o), int(key)) for s, o, key in zip(scores, other, keys[able], strict=True))[:k]
        out += [(int(id_), key, -s) for s, _, key in best]
    return pd.DataFrame(out, columns=["query_id", "key", "score"])


def _met(queries: DataFrame, blocks: DataFrame, n_blocks: int, scan: Callable[..., pd.DataFrame], schema: str) -> DataFrame:
    """``scan`` over every pair of a block of queries and a block of entries of the same length."""
    asking = queries.select("dim", F.col("keys").alias("q_ids"), F.col("vectors").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                q_ids = np.frombuffer(row.q_ids, "<i8")
                yield scan(np.frombuffer(row.q, "<i8").reshape(len(q_ids), row.dim), q_ids, row)

    # The optimizer takes packed blocks for small rows; a copy of all of them per block must not pass through the driver.
    return asking.join(blocks.hint("merge"), ["dim", "block"]).mapInPandas(run, schema)


def _scored(pairs: DataFrame, entries: DataFrame, asking: DataFrame) -> DataFrame:
    """The rows of (query_id, key): query_id, vec_id, score, by the exact vectors. Their sums stay below 2^51."""
    # Vectors are far smaller on disk than in memory, so file sizes would have them broadcast.
    held, queries = entries.select("key", "v", "members").hint("merge"), asking.select(F.col("id").alias("query_id"), F.col("v").alias("_q")).hint("merge")
    joined = pairs.select("query_id", "key").join(held, "key").join(queries, "query_id")
    product = F.aggregate(F.zip_with("v", "_q", lambda a, b: a * b), F.lit(0).cast("long"), lambda total, x: total + x)
    return _rows_of(joined.select("query_id", "members", product.alias("score")))


def _rows_of(scored: DataFrame) -> DataFrame:
    each = scored.select("query_id", "score", F.explode("members").alias("m")).where(F.col("m.id") != F.col("query_id"))
    return each.select("query_id", F.explode(F.array_repeat(F.col("m.id"), F.col("m.n"))).alias("vec_id"), "score")


def _kth(rows: DataFrame, value: str, ties: Column, k: int, name: str) -> DataFrame:
    """query_id and its k-th largest value, null where it has fewer than k."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col(value).desc(), ties))
    return rows.withColumn("_r", place).where(F.col("_r") <= k).groupBy("query_id").agg(F.min(F.when(F.col("_r") == k, F.col(value))).alias(name))


def top_k(rows: DataFrame, is_query, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, bits: int = BITS, candidates_each: int = CANDIDATES_EACH, queries_each: int = QUERIES_EACH, counts: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best other rows of every query row.

    ``is_query`` is a Column over ``id``. ``counts``, if given, gets how many pairs of a query and an entry were
    read exactly (``read``) of how many (``all``); that costs two counts.
    """
    vectors = cut(usable_vectors(rows, id_col, vector_col, scale), "vectors")
    entries = cut(entries_of(vectors, k), "entries")
    asking = cut(vectors.where(is_query).groupBy("id").agg(F.min(F.struct(F.size("v").alias("dim"), "v")).alias("q")).select("id", "q.*", in_reach(F.col("q.v")).alias("near")), "queries")
    lengths = entries.groupBy("near", "dim").agg(F.count("*").alias("n")).groupBy("near").agg(F.sum("n").alias("n"), F.sum("dim").alias("width")).collect()
    sizes = {r.near: r.n for r in lengths}
    asked = {r.near: r.n for r in asking.groupBy("near").agg(F.count("*").alias("n")).collect()}
    cells_each = min(4 * candidates_each, max(candidates_each, sizes.get(True, 0) // CELL_BLOCKS))
    n_cells, n_exact = partitions_for(sizes.get(True, 0), cells_each), partitions_for(sum(sizes.values()), candidates_each)

    cells = fit_cells(entries, bits)
    if sum(r.width for r in lengths) <= BROADCAST_DIMS:  # two numbers a dimension of each length
        cells = F.broadcast(cells)
    ids = [F.col("members")[0]["id"].alias("one"), F.coalesce(F.get("members", F.lit(1))["id"], F.lit(-1)).alias("two"), (F.size("members") > 1).alias("more")]
    held = entries.select("dim", "key", *ids, "v", "near")
    plain = [F.lit(None).cast("array<int>").alias(c) for c in ("lo", "width")]

    def query_blocks(near: bool | None) -> DataFrame:
        some = asking if near is None else asking.where(F.col("near") == near)
        n = partitions_for(sum(asked.values()) if near is None else asked.get(near, 0), queries_each)
        return _blocks(some.select("dim", F.col("id").alias("key"), F.col("id").alias("one"), F.col("id").alias("two"), F.lit(False).alias("more"), "v", *plain), n, True)

    def from_cells(q: np.ndarray, q_ids: np.ndarray, row) -> pd.DataFrame:
        keys, one, more = np.frombuffer(row.keys, "<i8"), np.frombuffer(row.one, "<i8"), np.frombuffer(row.more, "?")
        return scan_cells(q, q_ids, keys, one, more, np.frombuffer(row.vectors, np.uint8).reshape(len(keys), row.dim), np.frombuffer(row.lo, "<i4"), np.frombuffer(row.width, "<i4"), k)

    def from_exact(q: np.ndarray, q_ids: np.ndarray, row) -> pd.DataFrame:
        keys, one, two, more = np.frombuffer(row.keys, "<i8"), np.frombuffer(row.one, "<i8"), np.frombuffer(row.two, "<i8"), np.frombuffer(row.more, "?")
        return scan_exact(q, q_ids, keys, one, two, more, np.frombuffer(row.vectors, "<i8").reshape(len(keys), row.dim), k)

    # The cells alone, down to the k-th lower bound of all.
    file = _blocks(held.where("near").join(cells, "dim"), n_cells, False)
    seen = cut(_met(query_blocks(True), file, n_cells, from_cells, "query_id long, key long, low double, up double"), "bounds")
    left = seen.join(_kth(seen, "low", F.col("key"), k, "floor"), "query_id").where(F.col("floor").isNull() | (F.col("up") >= F.col("floor"))).select("query_id", "key", "up")

    # Exact vectors in the order of the bounds: first some, then what can still reach the k-th score.
    order = Window.partitionBy("query_id").orderBy(F.col("up").desc(), "key")
    first = cut(left.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= FIRST * k).drop("_r"), "first")
    scored = cut(_scored(first, entries, asking), "scores")
    ends = first.groupBy("query_id").agg(F.max(F.struct((-F.col("up")).alias("up"), "key")).alias("_end"))
    later = left.join(ends, "query_id").join(_kth(scored, "score", F.col("vec_id"), k, "kth"), "query_id", "left")
    later = later.where((F.struct((-F.col("up")).alias("up"), "key") > F.col("_end")) & (F.col("kth").isNull() | (F.col("up") >= F.col("kth")))).select("query_id", "key", "up")
    found = scored.unionByName(_scored(later, entries, asking))
    if counts is not None:
        counts["read"] = first.count() + later.count()
        counts["all"] = sum(asked.values()) * sum(sizes.values())

    # What has no cells, and all for a query out of reach.
    far = []
    if sizes.get(False):
        far.append((query_blocks(None), held.where("not near")))
    if asked.get(False):
        far.append((query_blocks(False), held.where("near")))
    for queries, some in far:
        packed = _blocks(some.select("dim", "key", "one", "two", "more", "v", *plain), n_exact, True)
        best = _met(queries, packed, n_exact, from_exact, "query_id long, key long, score long")
        found = found.unionByName(_rows_of(best.join(entries.select("key", "members"), "key")))

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_EVERY == 0)


ORACLE_OP7 = """
with v as (
  select cast(vec_id as bigint) as id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.id as query_id, c.id as vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.id % 50 = 0 and c.id <> q.id
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""
