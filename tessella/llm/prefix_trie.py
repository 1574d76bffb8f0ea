"""The trie of conversation prefixes, by Patricia construction.

A conversation is the list of its turns; a node of the trie is a distinct list of
first turns. Construction:

1. Turns become digests and are numbered after a range sort, so that a
   conversation of any length is spread over tasks.
2. Conversations become sorted strings of digests, in segments of ``SEGMENT``
   turns at most. Alike ones become one string with its number, its least id and
   the hash of the ids that end there.
3. The strings are sorted by range. Each task walks its run once: the common
   prefix with the string before tells where a branch is. A stack holds the
   points of the current path only: branches, ends and leaves, joined by
   compressed edges. A point that is left adds its aggregates to the point above,
   and the nodes on its edge are unfolded from suffix sums along the edge.
4. Only nodes on a path that two tasks share are met again: tasks' parts of
   them are added by key. Children whose parent is such a node, or a point of
   very many children, take the parent's id from a join on the parent's key,
   spread by a salt.

``saved`` of a node is a - b, where a counts a turn's bytes once for each member
and b once for each node; both add over tasks.

A segment after the first is a trie of its own under the key of all earlier
segments. What lies below a segment's last node is found by a first walk over the
later segments and given to that node; one row per pair of segments of a path.

Defined cases: rows without a conversation id are dropped; null turns come first;
turns of one number follow in the order of their digests; null role or text is
the empty string; a conversation may be left without turns and is then a member
of the root alone; an empty table has no nodes; the hash of the ids of one node is
computed in order, by one task that holds a batch of them at a time; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, partitions_for, read_table

SEGMENT = 1024
BLOCK = 1 << 16
IDS_EACH = 4096
PENDING = 1024
STRINGS_EACH = 4000
SALTS = 16
DIGEST = 32
ROOT = ""
EMPTY_HASH = hashlib.sha256(b"").hexdigest()
HEADS = 8
FAMILY = 5


# --- rebuilt conversations ---


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and bytes of every turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256), 1, DIGEST)
    slim = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    # The row's number lets the range sort divide even rows that repeat.
    slim = slim.withColumn("_n", F.monotonically_increasing_id())
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "_n"]
    ranged = slim.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, at = None, 0
        for batch in batches:
            place = np.empty(len(batch), np.int64)
            for k, conv in enumerate(batch["conv_id"].tolist()):
                at = at + 1 if conv == last else 1
                last = conv
                place[k] = at
            yield batch.assign(place=place)

    placed = cut(ranged.select("conv_id", "pid", "digest", "bytes").mapInPandas(run, "conv_id long, pid int, digest string, bytes long, place long"), "turns")
    # A conversation goes on over partitions for at most one conversation a partition.
    parts = placed.groupBy("conv_id", "pid").agg(F.max("place").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("before", F.sum("n").over(earlier)).where("before is not null").select("conv_id", "pid", "before")
    out = placed.join(F.broadcast(before), ["conv_id", "pid"], "left")
    return out.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, bytes) of every rebuilt turn, and (conv_id, total) of every conversation."""
    n = cut(numbered(turns), "numbered")
    own = n.groupBy("conv_id").agg(F.max("pos").alias("own"))
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS + 1)).cast("long")
    own = own.withColumn("h", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    bases = own.where("conv_id = base").select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    shared = F.least("h", F.coalesce("base_turns", F.lit(0)))
    info = own.join(bases, "base", "left").withColumn("lent", F.when(F.col("conv_id") == F.col("base"), 0).otherwise(shared))
    info = info.withColumn("skip", F.when(F.col("conv_id") == F.col("base"), 0).otherwise(F.col("h")))
    info = cut(info.withColumn("total", F.col("lent") + F.greatest(F.col("own") - F.col("skip"), F.lit(0))), "conversations")
    # A long conversation meets its row of numbers in blocks of turns.
    spread = info.withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("own") / BLOCK).cast("int")))).select("conv_id", "block", "lent", "skip")
    kept = n.withColumn("block", (F.col("pos") / BLOCK).cast("int")).join(spread, ["conv_id", "block"]).where("pos > skip")
    kept = kept.select("conv_id", (F.col("pos") - F.col("skip") + F.col("lent")).alias("depth"), "digest", "bytes")
    lending = n.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") <= HEADS)).withColumnRenamed("conv_id", "base")
    taken = info.where("conv_id <> base and lent > 0").select("conv_id", "base", "lent").join(lending, "base").where("pos <= lent")
    return kept.union(taken.select("conv_id", F.col("pos").alias("depth"), "digest", "bytes")), info.select("conv_id", "total")


def node_key(under: Column, prefix: Column) -> Column:
    return F.sha2(F.concat_ws(":", under, F.sha2(prefix, 256)), 256)


def _node_key(under: str, prefix: str) -> str:
    inner = hashlib.sha256(prefix.encode()).hexdigest()
    return hashlib.sha256(f"{under}:{inner}".encode()).hexdigest()


def segments(turns: DataFrame, totals: DataFrame, size: int) -> DataFrame:
    """conv_id, k, under (key of all earlier segments), seq (digests), weights, goes_on."""
    part = turns.withColumn("k", ((F.col("depth") - 1) / size).cast("int"))
    held = part.groupBy("conv_id", "k").agg(F.array_sort(F.collect_list(F.struct("depth", "digest", "bytes"))).alias("t"))
    held = held.select("conv_id", "k", F.array_join("t.digest", "").alias("seq"), F.col("t.bytes").alias("weights"))
    bare = totals.where("total = 0").select("conv_id", F.lit(0).alias("k"), F.lit("").alias("seq"), F.array().cast("array<long>").alias("weights"))
    held = cut(held.union(bare), "segments")
    last = totals.select("conv_id", F.greatest(F.floor((F.col("total") - 1) / size), F.lit(0)).cast("int").alias("last"))
    if last.where("last > 0").isEmpty():
        return held.select("conv_id", "k", F.lit(ROOT).alias("under"), "seq", "weights", F.lit(False).alias("goes_on"))
    long = held.join(last.where("last > 0"), "conv_id").select("conv_id", F.struct("k", F.sha2("seq", 256).alias("d")).alias("s"))
    chain = long.groupBy("conv_id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    below = lambda acc, s: F.concat(acc, F.array(F.sha2(F.concat_ws(":", F.element_at(acc, -1), s["d"]), 256)))
    keys = chain.select("conv_id", F.posexplode(F.aggregate("s", F.array(F.lit(ROOT)), below)).alias("k", "under"))
    full = held.join(last, "conv_id").join(keys, ["conv_id", "k"], "left")
    return cut(full.select("conv_id", "k", F.coalesce("under", F.lit(ROOT)).alias("under"), "seq", "weights", (F.col("k") < F.col("last")).alias("goes_on")), "keyed")


# --- alike conversations ---


def distinct_strings(parts: DataFrame) -> DataFrame:
    """One row per distinct (under, seq): n members, least id, goes_on, and the hash of the ids that end there."""
    slim = parts.select(node_key(F.col("under"), F.col("seq")).alias("key"), (~F.col("goes_on")).alias("ends"), "conv_id")
    ordered = slim.repartitionByRange("key", "ends", "conv_id").sortWithinPartitions("key", "ends", "conv_id")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A group in key order becomes pieces of its ids, joined already, so that many ids are few rows.
        for batch in batches:
            rows = []
            for (key, ends), ids in batch.groupby(["key", "ends"], sort=True)["conv_id"]:
                ids = ids.tolist()
                for at in range(0, len(ids), IDS_EACH):
                    some = ids[at : at + IDS_EACH]
                    rows.append((key, bool(ends), some[0], len(some), ",".join(map(str, some)) if ends else ""))
            yield pd.DataFrame(rows, columns=["key", "ends", "first", "n", "ids"])

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, rows = None, []  # key, n, least id, goes on, hash
        for batch in batches:
            for key, ends, first, n, ids in batch[["key", "ends", "first", "n", "ids"]].itertuples(index=False):
                if state is None or state[0] != key:
                    if state:
                        rows.append(_closed(state))
                    state = [key, 0, first, False, None]
                state[1] += n
                state[2] = min(state[2], first)
                if ends:
                    if state[4] is None:
                        state[4] = hashlib.sha256(ids.encode())
                    else:
                        state[4].update(f",{ids}".encode())
                else:
                    state[3] = True
            if rows:
                yield pd.DataFrame(rows, columns=["key", "n", "conv_id", "goes_on", "ends_sha256"])
                rows = []
        if state:
            yield pd.DataFrame([_closed(state)], columns=["key", "n", "conv_id", "goes_on", "ends_sha256"])

    cutup = ordered.mapInPandas(pieces, "key string, ends boolean, first long, n long, ids string")
    closed = cutup.repartition("key").sortWithinPartitions("key", "ends", "first").mapInPandas(close, "key string, n long, conv_id long, goes_on boolean, ends_sha256 string")
    own = parts.select(node_key(F.col("under"), F.col("seq")).alias("key"), "conv_id", "k", "under", "seq", "weights")
    return closed.join(own, ["key", "conv_id"])


def _closed(state: list) -> tuple:
    return (*state[:4], state[4].hexdigest() if state[4] else None)


# --- the compressed tree ---


def common(a: str, b: str) -> int:
    """Turns at the start that two strings share."""
    if a == b or b.startswith(a):
        return len(a) // DIGEST
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        mid = (low + high + 1) // 2
        if a[: mid * DIGEST] == b[: mid * DIGEST]:
            low = mid
        else:
            high = mid - 1
    return low


class Point:
    """A branch, an end or the root of the current path, with what lies below it."""

    __slots__ = ("a", "b", "children", "depth", "ends", "flushed", "goes_on", "is_end", "least", "leaves", "n", "pending")

    def __init__(self, depth: int) -> None:
        self.depth, self.n, self.least, self.leaves, self.a, self.b, self.children = depth, 0, None, 0, 0, 0, 0
        self.ends, self.is_end, self.goes_on, self.flushed = None, False, False, False
        self.pending: list[list] = []


NODE = ["key", "parent_key", "shared", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "a", "b", "ends"]
NODE_SCHEMA = "key string, parent_key string, shared boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, a long, b long, ends string"


class Tree:
    """Walks one task's run of sorted strings under one key and gives rows of nodes."""

    def __init__(self, under: str, above: int, shared: int, pending: int = PENDING) -> None:
        self.pending = pending  # children of one point that wait for its least id
        self.under, self.above = under, above  # key of earlier segments, and their number of turns
        self.shared = shared  # depth up to which the path lies in an earlier task as well (-1: nowhere)
        self.stack = [Point(0)]
        self.seq, self.sums = "", [0]
        self.out: list[list] = []

    def key(self, depth: int) -> str:
        if depth == 0:
            return self.under
        return _node_key(self.under, self.seq[: depth * DIGEST])

    def add(self, row, prefix: int | None) -> None:
        """The next string, which shares ``prefix`` turns with the one before (None: the first of its run)."""
        if prefix is not None:
            self.leave(prefix, -1)
        self.seq, self.sums = row.seq, [0, *accumulate(row.weights.tolist())]
        depth = len(self.sums) - 1
        if self.stack[-1].depth < depth:
            self.stack.append(Point(depth))
        point = self.stack[-1]
        point.n += row.n
        point.least = row.conv_id if point.least is None else min(point.least, row.conv_id)
        point.is_end, point.ends, point.goes_on = True, row.ends_sha256, row.goes_on
        point.leaves += row.below_leaves
        point.a += int(row.below_a)
        point.b += int(row.below_b)

    def leave(self, prefix: int, after: int) -> None:
        """Close the points deeper than ``prefix``; nodes down to ``after`` lie in a later task as well."""
        while self.stack[-1].depth > prefix:
            point = self.stack.pop()
            if self.stack[-1].depth < prefix:
                self.stack.append(Point(prefix))
            self.close(point, self.stack[-1], after)
        self.shared = min(self.shared, prefix)

    def close(self, w: Point, u: Point, after: int) -> None:
        """Unfold the edge from ``u`` down to ``w`` and add it to ``u``."""
        sums, both = self.sums, max(self.shared, after)
        if w.is_end and not w.children and not w.goes_on and after < w.depth:
            w.leaves += 1
        new = lambda d: sums[w.depth] - sums[min(w.depth, max(d, self.shared))]  # bytes of nodes below depth d that begin in this task
        self.node(w, w.depth, w.children, w.ends, w.a + w.n * (sums[w.depth] - sums[w.depth - 1]), w.b + new(w.depth - 1), both, u)
        for d in range(w.depth - 1, u.depth, -1):
            self.node(w, d, int(d + 1 > self.shared), None, w.a + w.n * (sums[w.depth] - sums[d - 1]), w.b + new(d - 1), both, u)
        u.n += w.n
        if w.least is not None:
            u.least = w.least if u.least is None else min(u.least, w.least)
        u.leaves += w.leaves
        u.a += w.a + w.n * (sums[w.depth] - sums[u.depth])
        u.b += w.b + new(u.depth)
        u.children += u.depth + 1 > self.shared

    def node(self, w: Point, depth: int, children: int, ends: str | None, a: int, b: int, both: int, u: Point) -> None:
        shared = depth <= both or (w.goes_on and depth == w.depth)
        whole = depth == w.depth
        if whole:
            self.settle(w, shared)
        row = [self.key(depth) if shared or (whole and w.flushed) else None, None, shared, w.least, depth + self.above, None, w.n, children, w.leaves, a, b, ends]
        if depth - 1 <= both:
            row[1] = self.key(depth - 1)
            self.out.append(row)
        elif depth - 1 > u.depth:
            row[5] = w.least
            self.out.append(row)
        else:
            u.pending.append(row)
            if len(u.pending) > self.pending:
                self.flush(u)

    def flush(self, u: Point) -> None:
        """Too many children to wait for their parent's least id: they take it by key."""
        key = self.key(u.depth)
        for row in u.pending:
            row[1] = key
        self.out += u.pending
        u.pending, u.flushed = [], True

    def settle(self, point: Point, shared: bool) -> None:
        if shared or point.flushed:
            self.flush(point)
        for row in point.pending:
            row[5] = point.least
        self.out += point.pending
        point.pending = []

    def finish(self, after: int) -> None:
        """Close everything; the path down to ``after`` goes on in a later task (-1: nowhere)."""
        began = self.shared
        self.leave(0, after)
        root = self.stack[0]
        if self.under != ROOT:
            # The root of a later segment is a node of the segment above, which counts all but its children.
            self.settle(root, True)
            self.out.append([self.under, None, True, None, self.above, None, 0, root.children, 0, 0, 0, None])
            return
        shared = began >= 0 or after >= 0
        if root.is_end and not root.children and after < 0:
            root.leaves += 1
        self.settle(root, shared)
        self.out.append([self.key(0) if shared or root.flushed else None, None, shared, root.least, 0, None, root.n, root.children, root.leaves, root.a, root.b, root.ends])


def _trees(batches: Iterator[pd.DataFrame], edges: dict[int, tuple[int, int, str]], size: int, pending: int) -> Iterator[tuple[Tree, bool]]:
    """Trees fed with the rows, given after each row and, with True, when all their rows are in."""
    tree, pid = None, None
    for batch in batches:
        for row in batch.itertuples(index=False):
            begins, _, first = edges[row.pid]
            if tree is not None and (row.pid != pid or row.under != tree.under):
                tree.finish(edges[pid][1] if row.pid != pid else -1)
                yield tree, True
                tree = None
            if tree is None:
                tree = Tree(row.under, row.k * size, begins if row.pid != pid and row.under == first else -1, pending)
                tree.add(row, None)
            else:
                tree.add(row, common(tree.seq, row.seq))
            pid = row.pid
            yield tree, False
    if tree is not None:
        tree.finish(edges[pid][1])
        yield tree, True


def _edges(ranged: DataFrame) -> dict[int, tuple[int, int, str]]:
    """Per task the turns its first string shares with the task before, and its last one with the task after (-1: other key), and its first key."""
    ends = ranged.groupBy("pid").agg(F.min(F.struct("under", "seq")).alias("first"), F.max(F.struct("under", "seq")).alias("last"))
    before = ends.withColumn("before", F.lag("last").over(Window.orderBy("pid")))
    share = F.udf(lambda u, a, v, b: -1 if u is None or u != v else common(a, b), "int")
    told = before.select("pid", share("before.under", "before.seq", "first.under", "first.seq").alias("begins"), "first.under")
    begins = {r["pid"]: (r["begins"], r["under"]) for r in told.collect()}
    order = sorted(begins)
    after = [*(begins[p][0] for p in order), -1][1:]
    return {p: (begins[p][0], then, begins[p][1]) for p, then in zip(order, after, strict=True)}


def _below(dealt: DataFrame, edges: dict[int, tuple[int, int, str]], size: int, pending: int) -> DataFrame:
    """under, leaves, a, b: all that lies below the last node of a segment which goes on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tree, done in _trees(batches, edges, size, pending):
            tree.out.clear()
            if done:
                root = tree.stack[0]
                yield pd.DataFrame([(tree.under, root.leaves, root.a, root.b, root.least)], columns=["under", "leaves", "a", "b", "conv_id"])

    later = dealt.where("k > 0").mapInPandas(run, "under string, leaves long, a long, b long, conv_id long")
    return cut(later.groupBy("under").agg(F.sum("leaves").alias("leaves"), F.sum("a").cast("long").alias("a"), F.sum("b").cast("long").alias("b"), F.min("conv_id").alias("conv_id")), "below")


def _with_below(strings: DataFrame, parts: DataFrame, below: DataFrame) -> DataFrame:
    """What lies below each segment's end: the sums of all later segments on its paths."""
    path = parts.where("k > 0").select("conv_id", "k", "under")
    own = below.join(path, ["conv_id", "under"]).select("conv_id", F.col("k").alias("_k"), "leaves", "a", "b")
    upward = own.join(path, "conv_id").where("k <= _k").groupBy("under")
    total = upward.agg(F.sum("leaves").alias("below_leaves"), F.sum("a").cast("long").alias("below_a"), F.sum("b").cast("long").alias("below_b"))
    return strings.drop("below_leaves", "below_a", "below_b").join(total.withColumnRenamed("under", "key"), "key", "left").fillna(0, ["below_leaves", "below_a", "below_b"])


def prefix_nodes(turns: DataFrame, size: int = SEGMENT, tasks: int | None = None, pending: int = PENDING) -> DataFrame:
    """The nodes of the trie of rebuilt conversations (conv_id, turn, role, text in ``turns``)."""
    nothing = {c: F.lit(0).cast("long") for c in ("below_leaves", "below_a", "below_b")}
    parts = segments(*rebuilt(turns), size)
    strings = cut(distinct_strings(parts).withColumns(nothing), "strings")
    n = tasks or partitions_for(strings.count(), STRINGS_EACH)
    ranged = strings.repartitionByRange(n, "under", "seq").withColumn("pid", F.spark_partition_id())
    ranged = cut(ranged, "sorted")
    edges = _edges(ranged)

    def deal(rows: DataFrame) -> DataFrame:
        columns = ["pid", "under", "k", "seq", "weights", "n", "conv_id", "goes_on", "ends_sha256", "below_leaves", "below_a", "below_b"]
        return rows.select(*columns).repartition(n, "pid").sortWithinPartitions("pid", "under", "seq")

    if not ranged.where("k > 0").isEmpty():
        ranged = cut(_with_below(ranged, parts, _below(deal(ranged), edges, size, pending)), "weighted")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tree, done in _trees(batches, edges, size, pending):
            if tree.out and (done or len(tree.out) > 2000):
                frame = pd.DataFrame(tree.out, columns=NODE)
                for c in ("conv_id", "parent_conv_id"):
                    frame[c] = pd.array(frame[c], "Int64")
                yield frame
                tree.out.clear()

    return _joined(cut(deal(ranged).mapInPandas(run, NODE_SCHEMA), "nodes"))


def _joined(nodes: DataFrame) -> DataFrame:
    """Add up nodes that several tasks hold, and give children their parents' ids."""
    alone = nodes.where("not shared").drop("shared")
    total = lambda c: F.sum(c).cast(nodes.schema[c].dataType).alias(c)
    met = nodes.where("shared").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_conv_id").alias("parent_conv_id"),
        total("n_convs"), total("n_children"), total("n_leaves"), total("a"), total("b"), F.max("ends").alias("ends"),
    )
    met = cut(met, "shared")
    whole = alone.unionByName(met)
    parents = whole.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    asking = whole.where("parent_key is not null").withColumn("_salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    found = asking.join(parents, ["parent_key", "_salt"], "left").withColumn("parent_conv_id", F.col("_parent"))
    out = whole.where("parent_key is null").unionByName(found.select(*whole.columns))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("a") - F.col("b")).cast("long").alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY_HASH)).alias("ends_sha256"),
    )


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(read_table(spark, sf_dir, "conversations"))
