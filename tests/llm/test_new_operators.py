"""The prefix trie, the multi-index and whitening against brute force, with the odd cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import multi_index, prefix_trie, whitening

SMALL = "/root/testdata/sf0.001"


# --- prefix trie ---


def turn_digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()[:32]


def brute_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, turn_digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = ts if base == c else own.get(base, [])[:h] + ts[h:]
    members = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves = sum(out[b]["n_leaves"] for b in below) or 1
        own_saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        ends = sorted(c for c in members[path] if len(rebuilt[c]) == len(path))
        out[path] = {
            "conv_id": min(members[path]), "depth": len(path), "parent_conv_id": min(members[path[:-1]]) if path else None, "n_convs": len(members[path]), "n_children": len(below), "n_leaves": leaves,
            "saved_tokens": own_saved + sum(out[b]["saved_tokens"] for b in below), "ends_sha256": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        }
    return [tuple(r.values()) for r in out.values()]


def found_trie(frame):
    return by_nulls(tuple(r) for r in frame.collect())


def by_nulls(rows):
    return sorted(rows, key=lambda r: tuple(-(10**20) if x is None else x for x in r))


def talks(n, seed, longest=9):
    rng = random.Random(seed)
    words = ["yes", "no", "", None, "why é🙂", "go on"]
    rows = []
    for c in rng.sample(range(-n, 3 * n), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t if rng.random() < 0.97 else None, rng.choice(["user", "assistant", None]) if t else "user", rng.choice(words) if t % 3 else "hello"))
    same = [(0, "user", "alike"), (1, "assistant", "as well"), (2, "user", "bye")]
    rows += [(c, *t) for c in range(5 * n, 6 * n) for t in same]
    rows += [(None, 0, "user", "lost"), (7, 0, "user", "hello"), (7, 0, "user", "hello")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, pid int, k int"


def talk_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


@pytest.mark.parametrize(("size", "tasks", "pending"), [(1024, None, 1024), (1024, 7, 1), (2, 1, 1024), (3, 5, 2)])
def test_trie_equals_brute_force(spark, size, tasks, pending):
    rows = talks(40, seed=size)
    got = found_trie(prefix_trie.prefix_nodes(talk_frame(spark, rows), size, tasks, pending))
    assert got == by_nulls(brute_trie(rows))


def test_trie_of_long_and_no_conversations(spark):
    assert prefix_trie.prefix_nodes(talk_frame(spark, [])).count() == 0
    # One conversation holds most rows; others go with it for a while.
    rows = [(10, t, "user", f"t{t % 17}") for t in range(300)]
    rows += [(c, t, "user", f"t{t % 17}") for c, n in ((15, 64), (20, 65), (25, 200), (30, 300)) for t in range(n)]
    rows += [(25, 200 + t, "user", "apart") for t in range(40)]
    got = found_trie(prefix_trie.prefix_nodes(talk_frame(spark, rows), 32, 3))
    assert got == by_nulls(brute_trie(rows))


def test_trie_of_the_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert found_trie(prefix_trie.op11_conversation_prefix_trie(spark, SMALL)) == by_nulls(brute_trie(rows))


# --- multi-index ---


def vector_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim))
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 0.5) for i, v in rows], "vec_id long, embedding array<double>, dim int, i int, block int, score double")


def brute_neighbours(rows, every, k):
    able = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    asks = {}
    for i, v in able:
        if i % every == 0:
            key = (len(v), tuple(v))
            asks[i] = min(asks.get(i, (key, v)), (key, v), key=lambda p: p[0])
    out = {}
    for q, (_, v) in asks.items():
        near = sorted((-(v * w).sum(), i) for i, w in able if i != q and len(w) == len(v))[:k]
        out[q] = [(i, -s) for s, i in near]
    return out


def found_neighbours(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_multi_index_with_every_cell_is_exact(spark):
    rows = vector_rows(500, 6, 1)
    same = [(1000 + i, rows[0][1]) for i in range(300)]  # a crowded cell with ties
    odd = [(20, None), (40, [None, 1.0]), (60, [float("nan"), 1.0]), (80, [0.0] * 6), (None, rows[3][1]), (100, [1.0]), (101, [2.0]), (100, rows[5][1]), (120, []), (140, [1.0, 2.0]), (3, rows[3][1])]
    frame = vector_frame(spark, rows + same + odd)
    got = found_neighbours(multi_index.search(frame, F.col("id") % 20 == 0, 7, target=1.0, entries_each=50, queries_each=8))
    want = brute_neighbours(rows + same + odd, 20, 7)
    want = {q: near for q, near in want.items() if near}
    # The walk passes what the sampled queries need; here all queries are sampled.
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near]
        assert np.allclose([s for _, s in got[q]], [s for _, s in near], rtol=1e-14, atol=1e-14)
    assert not found_neighbours(multi_index.search(vector_frame(spark, []), F.col("id") % 20 == 0))


def test_multi_index_recall(spark):
    for sf in (SMALL, "/root/testdata/sf0.1"):
        got = found_neighbours(multi_index.op12_inverted_multi_index(spark, sf))
        table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas()
        x, ids = np.stack(table["embedding"].to_numpy()).astype(float), table["vec_id"].to_numpy()
        hits = total = 0
        for q in np.flatnonzero(ids % 20 == 0):
            scores = x @ x[q]
            scores[q] = -np.inf
            best = set(ids[np.argsort(-scores)[:20]].tolist())
            mine = got[int(ids[q])]
            assert len(mine) == 20
            hits, total = hits + len(best & {i for i, _ in mine}), total + len(best)
        assert hits / total >= 0.9


def test_walk_takes_pairs_by_distance():
    rng = np.random.default_rng(4)
    index = multi_index.Index(rng.normal(size=(9, 2)), rng.normal(size=(7, 3)), rng.integers(0, 3, (9, 7)), 5)
    q = rng.normal(size=5)
    order = multi_index.walk(q, index, 10**9)
    far = [-(index.first[a] @ q[:2] + index.second[b] @ q[2:]) for a, b in order]
    assert far == sorted(far) and len(order) == np.count_nonzero(index.counts)
    held = 0
    for n, cell in enumerate(order, 1):
        held += index.counts[cell]
        if held >= 5:
            break
    assert multi_index.walk(q, index, 5) == order[:n]


# --- whitening ---


def test_outer_products_lose_nothing():
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(1300, 5)) * [1, 10, 1e4, 3, 0] + 1e6).round()
    sums = [int(s) for s in x.sum(axis=0)]
    mean = whitening.unrounded_mean(len(x), sums)
    high, low = whitening.add_outer(np.zeros((5, 5)), np.zeros((5, 5)), *whitening.centre(x, *mean))
    n = len(x)
    for a in range(5):
        for b in range(5):
            exact = sum(Fraction(n * int(r[a]) - sums[a]) * (n * int(r[b]) - sums[b]) for r in x) / (n * n)
            assert abs(Fraction(float(high[a, b])) + Fraction(float(low[a, b])) - exact) <= abs(exact) * Fraction(1, 2**75) + Fraction(1, 2**60)


def whitened_by_hand(x):
    fit = np.array(sorted(set(map(tuple, x.tolist()))), dtype=object)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    z = np.array([[float(Fraction(n * int(a) - s, n)) for a, s in zip(row, sums)] for row in fit])
    e, q = np.linalg.eigh(z.T @ z / n)
    return n, sums, e[::-1], q[:, ::-1]


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(400, 20)) * np.linspace(3, 0.5, 20)
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)]
    rows += [(5, rows[5][1]), (None, rows[6][1])] + [(900 + i, rows[0][1]) for i in range(200)]
    odd = [(1, None), (2, [None] * 20), (3, [float("inf")] * 20), (4, [])]
    out = whitening.whiten(vector_frame(spark, rows + odd)).toPandas()
    assert len(out) == 16 * len(rows)
    x = np.floor(64 * np.array([r for _, r in rows])).astype(int) + 1_000_000
    n, sums, e, q = whitened_by_hand(x)
    assert set(out["n"]) == {n} and out["identity_error"].max() < 1e-9
    first = {i: r for (i, _), r in zip(reversed(rows), reversed(x.tolist()))}
    for vec_id, group in out.groupby("vec_id"):
        r = first[int(vec_id)]
        assert set(group["deviation"]) == {sum((n * a - s) ** 2 for a, s in zip(r, sums))}
        z = np.array([float(Fraction(n * a - s, n)) for a, s in zip(r, sums)])
        want = np.abs(z @ q[:, :16] / np.sqrt(e[:16]))
        for w in group["whitened"].to_numpy().reshape(-1, 16):
            assert np.allclose(np.abs(w), want, rtol=1e-8, atol=1e-8)
        assert np.allclose(group["explained"].to_numpy().reshape(-1, 16), e[:16] / e.sum(), rtol=1e-10)
    assert out["vec_id"].isna().sum() == 16


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(vector_frame(spark, [])).count() == 0
    one = whitening.whiten(vector_frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).toPandas()
    assert len(one) == 4 and set(one["deviation"]) == {0} and not one["whitened"].any() and not one["explained"].any()
    # Lengths are fits of their own; a dimension without variance takes no part.
    mixed = whitening.whiten(vector_frame(spark, [(i, [float(i), 7.0]) for i in range(9)] + [(50 + i, [float(i * i)]) for i in range(5)])).toPandas()
    assert len(mixed) == 2 * 9 + 5 and set(mixed["n"]) == {9, 5}
    assert mixed[(mixed["n"] == 9) & (mixed["component"] == 2)]["whitened"].abs().max() == 0
    with pytest.raises(Exception, match="2\\^52"):
        whitening.whiten(vector_frame(spark, [(1, [1e30])])).count()


def test_deviation_beyond_64_bits():
    x = np.array([[2**40, 0], [0, 1]])
    assert whitening.exact_deviations(x, 2, [2**40, 1]) == [None, None]
    assert whitening.exact_deviations(np.array([[2**50]]), 3, [3 * 2**50]) == [0]


def test_refined_solve():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(200, 12)) * 10.0 ** -np.arange(12)
    e, q, trace = whitening.solve(a.T @ a, np.zeros((12, 12)), 200)
    assert np.allclose(q.T @ q, np.eye(12), atol=1e-14) and np.isclose(trace, e.sum(), rtol=1e-14) and (np.diff(e) <= 0).all()
    v = (a.T @ a).astype(np.longdouble) / 200
    assert np.abs(v @ q - q * e).max() < 1e-15 * e[0]
