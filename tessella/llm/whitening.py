"""Whitening of embeddings from a compensated covariance.

Components become integers ``floor(scale * c) + shift``. The fit list holds each
distinct integer vector once. Its sums are exact integers; the mean is kept as an
unrounded pair of doubles (high, low). Rows are centred by error-free sums before
anything is multiplied. Outer products of a block of rows are formed without any
error: each centred column is split into slices of ``SLICE_BITS`` bits on a
common unit, so that every product of two slices summed over ``BLOCK_ROWS`` rows
is an integer below 2^53, whatever the order of additions. The slices' products
go into a double-double sum by two-sums, and tasks' sums are merged high and low
part together, in two levels.

The eigenvectors come from LAPACK's symmetric solver by reduction to tridiagonal
form and divide and conquer (``numpy.linalg.eigh``), and are refined in extended
precision against the unrounded covariance. One solve is one task and holds one
matrix, whose size is that of the vectors, not of the table.

Defined cases: rows whose vector is null or holds null or non-finite entries are
dropped; rows with a null id stay; rows that repeat a vector or an id are rows
each, and count once in the fit; vectors of each length are a fit of their own
and empty vectors have no components; components without variance (as with a
single distinct vector) have whitened and explained 0 and no part in
identity_error; a deviation beyond 64 bits is null; integers beyond 2^52 raise an
error; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read_table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
SLICE_BITS = 22
SLICES = 4
BLOCK_ROWS = 512
MERGERS = 64
STRIPE_BYTES = 1 << 20


# --- error-free transformations ---


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a + b as a rounded sum and its exact error."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def dd_add(high: np.ndarray, low: np.ndarray, more_high: np.ndarray, more_low: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two double-doubles."""
    s, e = two_sum(high, more_high)
    t, f = two_sum(low, np.broadcast_to(more_low, np.shape(low)))
    s, e = two_sum(s, e + t)
    return two_sum(s, e + f)


def centre(x: np.ndarray, mean_high: np.ndarray, mean_low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers less an unrounded mean, as a double-double."""
    s, e = two_sum(x, np.broadcast_to(-mean_high, x.shape))
    return two_sum(s, e - mean_low)


def slices(high: np.ndarray, low: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Integers of at most SLICE_BITS bits a slice, and the unit of the first slice per column."""
    most = np.abs(high).max(axis=0)
    exponent = np.where(most > 0, np.frexp(most)[1], 0)
    rest, out = high, []
    for k in range(SLICES):
        if k == 2:
            rest = rest + low
        unit = np.ldexp(1.0, exponent - (k + 1) * SLICE_BITS)
        whole = np.rint(rest / unit)
        rest = rest - whole * unit
        out.append(whole)
    return out, np.ldexp(1.0, exponent - SLICE_BITS)


def add_outer(high: np.ndarray, low: np.ndarray, z_high: np.ndarray, z_low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add the sum of the rows' outer products to a double-double matrix."""
    for at in range(0, len(z_high), BLOCK_ROWS):
        parts, unit = slices(z_high[at : at + BLOCK_ROWS], z_low[at : at + BLOCK_ROWS])
        units = np.outer(unit, unit)
        for a in range(SLICES):
            for b in range(a, SLICES - a):
                product = (parts[a].T @ parts[b]) * units * 2.0 ** (-SLICE_BITS * (a + b))
                high, low = dd_add(high, low, product)
                if a != b:
                    high, low = dd_add(high, low, product.T)
    return high, low


# --- tables ---


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """id, dim and x (array of long) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    in_range = lambda c: F.abs(c * scale) < F.lit(2.0**52 - shift)
    whole = lambda c: F.when(in_range(c), F.floor(c * scale) + shift).otherwise(F.raise_error(F.lit("a scaled component exceeds 2^52")))
    x = F.transform(v, lambda c: whole(c).cast("long"))
    return rows.where(v.isNotNull() & finite).select(F.col(id_col).cast("string").alias("id"), F.size(v).alias("dim"), x.alias("x"))


def _runs(batches: Iterator[pd.DataFrame], start: Callable, add: Callable, finish: Callable) -> Iterator[pd.DataFrame]:
    """Fold each run of rows of one length and give its row when the run ends; rows come sorted by length."""
    dim, held = None, None
    for batch in batches:
        for now, part in batch.groupby("dim", sort=True):
            if now != dim:
                if dim is not None:
                    yield finish(dim, held)
                dim, held = int(now), start(int(now))
            held = add(dim, held, np.stack(part["x"].to_numpy()))
    if dim is not None:
        yield finish(dim, held)


def column_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: number of vectors and exact sums. As many numbers as a vector has reach the driver."""

    def add(dim: int, held: tuple, x: np.ndarray) -> tuple:
        n, total = held
        # 1000 rows of 52 bits stay below 63 bits.
        for at in range(0, len(x), 1000):
            total = [a + int(b) for a, b in zip(total, x[at : at + 1000].sum(axis=0), strict=True)]
        return n + len(x), total

    def finish(dim: int, held: tuple) -> pd.DataFrame:
        return pd.DataFrame([(dim, held[0], [str(t) for t in held[1]])], columns=["dim", "n", "sums"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _runs(batches, lambda dim: (0, [0] * dim), add, finish)

    parts = cut(fit.mapInPandas(run, "dim int, n long, sums array<string>"), "sums")
    counts = {r["dim"]: r["n"] for r in parts.groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    each = parts.select("dim", F.posexplode("sums").alias("pos", "part")).groupBy("dim", "pos").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"))
    sums: dict[int, dict[int, int]] = {}
    for r in each.collect():
        sums.setdefault(r["dim"], {})[r["pos"]] = int(r["s"])
    return {dim: (n, [sums[dim][p] for p in range(dim)] if dim else []) for dim, n in counts.items()}


def unrounded_mean(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    exact = [Fraction(s, n) for s in sums]
    high = [float(m) for m in exact]
    return np.array(high, float), np.array([float(m - Fraction(h)) for m, h in zip(exact, high, strict=True)], float)


def _merged(parts: DataFrame, width: str) -> DataFrame:
    """Rows of (dim, stripe, part, high, low) summed as double-doubles per (dim, stripe), in the order of their parts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, high, low = None, None, None
        columns = ["dim", "stripe", width, "high", "low"]
        for batch in batches:
            for dim, stripe, part, h, lo in batch[["dim", "stripe", width, "high", "low"]].itertuples(index=False):
                h, lo = np.frombuffer(h, "<f8"), np.frombuffer(lo, "<f8")
                if key != (dim, stripe, part):
                    if key is not None:
                        yield pd.DataFrame([(*key, high.tobytes(), low.tobytes())], columns=columns)
                    key, high, low = (dim, stripe, part), h, lo
                else:
                    high, low = dd_add(high, low, h, lo)
        if key is not None:
            yield pd.DataFrame([(*key, high.tobytes(), low.tobytes())], columns=columns)

    order = ["dim", "stripe", width, *([] if width == "part" else ["part"])]
    dealt = parts.repartition("dim", "stripe", width).sortWithinPartitions(*order)
    return dealt.mapInPandas(run, f"dim int, stripe int, {width} int, high binary, low binary")


def scatter(fit: DataFrame, means: dict[int, tuple]) -> DataFrame:
    """dim, stripe, high, low: stripes of rows of the sum of centred outer products."""
    shared = fit.sparkSession.sparkContext.broadcast(means)

    def add(dim: int, held: tuple, x: np.ndarray) -> tuple:
        return add_outer(*held, *centre(x.astype(float), *shared.value[dim]))

    def finish(dim: int, held: tuple) -> pd.DataFrame:
        each = max(1, STRIPE_BYTES // (8 * dim)) if dim else 1
        rows = [(dim, at // each, held[0][at : at + each].tobytes(), held[1][at : at + each].tobytes()) for at in range(0, dim, each)]
        return pd.DataFrame(rows, columns=["dim", "stripe", "high", "low"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _runs(batches, lambda dim: (np.zeros((dim, dim)), np.zeros((dim, dim))), add, finish)

    parts = fit.mapInPandas(run, "dim int, stripe int, high binary, low binary")
    parts = parts.withColumn("part", F.spark_partition_id()).withColumn("slot", F.col("part") % MERGERS)
    first = _merged(cut(parts, "scatter"), "slot").withColumnRenamed("slot", "part").withColumn("whole", F.lit(0))
    return _merged(first, "whole").drop("whole")


def solve(c_high: np.ndarray, c_low: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling), unit eigenvectors (columns) and trace of (c_high + c_low) / n."""
    v = (c_high.astype(np.longdouble) + c_low.astype(np.longdouble)) / np.longdouble(n)
    v = (v + v.T) / 2
    values, vectors = np.linalg.eigh(v.astype(float))
    q = vectors[:, ::-1].astype(np.longdouble)
    size = np.abs(v).max() if len(v) else np.longdouble(0)
    eye = np.eye(len(v), dtype=np.longdouble)
    # Newton steps on the eigenvectors; pairs too close to tell apart are only kept orthogonal.
    for _ in range(2):
        r = eye - q.T @ q
        s = q.T @ v @ q
        e = np.diag(s) / (1 - np.diag(r))
        near = 2 * (np.abs(s - np.diag(e)).sum(axis=1).max() + size * np.abs(r).sum(axis=1).max()) if len(v) else 0
        gap = e[None, :] - e[:, None]
        far = np.abs(gap) > near
        q = q + q @ np.where(far, (s + e[None, :] * r) / np.where(far, gap, 1), r / 2)
    e = np.diag(q.T @ v @ q) / np.diag(q.T @ q)
    order = np.argsort(-e, kind="stable")
    q, e = q[:, order], e[order]
    signs = np.where(q[np.abs(q).argmax(axis=0), np.arange(len(e))] < 0, -1, 1)
    return e.astype(float), (q * signs).astype(float), float(np.trace(v))


def components(stripes: DataFrame, counts: dict[int, int], most: int = COMPONENTS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length: projection (vectors over roots of eigenvalues) and explained shares; one solve is one task."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        group = group.sort_values("stripe")
        high, low = (np.frombuffer(b"".join(group[c]), "<f8").reshape(dim, dim) for c in ("high", "low"))
        e, q, trace = solve(high, low, counts[dim])
        e, q = e[:most], q[:, :most]
        alive = e > max(trace, 0.0) * dim * np.finfo(float).eps
        project = np.where(alive, q / np.sqrt(np.where(alive, e, 1.0)), 0.0)
        share = np.where(alive, e / trace if trace > 0 else 0.0, 0.0)
        return pd.DataFrame([(dim, project.tobytes(), share.tobytes())], columns=["dim", "project", "share"])

    found = stripes.groupBy("dim").applyInPandas(run, "dim int, project binary, share binary").collect()
    return {r["dim"]: (np.frombuffer(r["project"], "<f8").reshape(r["dim"], -1), np.frombuffer(r["share"], "<f8")) for r in found}


def _project(x: np.ndarray, mean: tuple, project: np.ndarray) -> np.ndarray:
    high, low = centre(x.astype(float), *mean)
    return high @ project + low @ project


def identity_errors(fit: DataFrame, means: dict[int, tuple], models: dict[int, tuple]) -> dict[int, float]:
    """Largest entry of the whitened fit list's covariance less the identity; centred moments are merged over tasks."""
    shared = fit.sparkSession.sparkContext.broadcast((means, models))

    def join(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        gap = b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def add(dim: int, held: tuple | None, x: np.ndarray) -> tuple:
        means_, models_ = shared.value
        w = _project(x, means_[dim], models_[dim][0])
        mean = w.mean(axis=0)
        now = len(w), mean, (w - mean).T @ (w - mean)
        return now if held is None else join(held, now)

    def finish(dim: int, held: tuple) -> pd.DataFrame:
        return pd.DataFrame([(dim, held[0], held[1].tobytes(), held[2].tobytes())], columns=["dim", "n", "mean", "moment"])

    schema = "dim int, n long, mean binary, moment binary"

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _runs(batches, lambda dim: None, add, finish)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for r in batch.itertuples():
                mean = np.frombuffer(r.mean, "<f8")
                now = r.n, mean, np.frombuffer(r.moment, "<f8").reshape(len(mean), len(mean))
                held[r.dim] = join(held[r.dim], now) if r.dim in held else now
        for dim, state in sorted(held.items()):
            yield finish(dim, state)

    parts = fit.where("dim > 0").mapInPandas(first, schema).withColumn("slot", F.spark_partition_id() % MERGERS)
    few = parts.repartition("dim", "slot").sortWithinPartitions("dim", "slot", "n", "mean").select("dim", "n", "mean", "moment").mapInPandas(merge, schema)
    out = {}
    for r in few.repartition("dim").sortWithinPartitions("dim", "n", "mean").mapInPandas(merge, schema).collect():
        k = len(r["mean"]) // 8
        off = np.abs(np.frombuffer(r["moment"], "<f8").reshape(k, k) / r["n"] - np.eye(k))
        alive = models[r["dim"]][1] > 0
        off = off[np.ix_(alive, alive)]
        out[r["dim"]] = float(off.max()) if off.size else 0.0
    return out


def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2; None where that exceeds 64 bits."""
    most = int(np.abs(x).max()) * n + max(abs(s) for s in sums)
    if most < 2**62:
        gap = x * np.int64(n) - np.array(sums, np.int64)
        if int(np.abs(gap).max()) ** 2 * x.shape[1] < 2**63:
            return (gap * gap).sum(axis=1).tolist()
    rows = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return [r if r < 2**63 else None for r in rows]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per remaining row and component: id, component, n, deviation, whitened, explained, identity_error."""
    held = cut(integer_vectors(rows, id_col, vector_col, scale, shift).where("dim > 0"), "integers")
    fit = cut(held.select("dim", "x").distinct().sortWithinPartitions("dim"), "fit").sortWithinPartitions("dim")
    totals = column_sums(fit)
    means = {dim: unrounded_mean(n, s) for dim, (n, s) in totals.items()}
    models = components(scatter(fit, means), {dim: n for dim, (n, _) in totals.items()}, most)
    errors = identity_errors(fit, means, models)
    shared = rows.sparkSession.sparkContext.broadcast((totals, means, models, errors))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals_, means_, models_, errors_ = shared.value
        for batch in batches:
            for dim, part in batch.groupby("dim", sort=True):
                n, sums = totals_[dim]
                project, share = models_[dim]
                x = np.stack(part["x"].to_numpy())
                w, k = _project(x, means_[dim], project), len(share)
                columns = {
                    "id": np.repeat(part["id"].to_numpy(object), k), "component": np.tile(np.arange(1, k + 1), len(x)), "n": n,
                    "deviation": pd.array(exact_deviations(x, n, sums), "Int64").repeat(k), "whitened": w.ravel(), "explained": np.tile(share, len(x)), "identity_error": errors_[dim],
                }
                yield pd.DataFrame(columns)

    out = held.mapInPandas(run, "id string, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.select(F.col("id").cast(rows.schema[id_col].dataType).alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
