"""Embedding near-duplicates against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import pivots

NAN, INF = float("nan"), float("inf")


def brute(rows):
    """Rows (id, vector, label): links, component and kept, by all pairs."""
    def ok(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n = len(rows)
    units = [pivots.unit(np.array([v]))[0] if ok(v, label) else None for _, v, label in rows]
    near = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        name = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), name, rows[i][0] == name))
    return out


def crowd(dims=24, near=300, seed=5):
    """Random vectors, chains and crowds of near ones, scaled copies and exact copies."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims)
    vectors = [centre / np.linalg.norm(centre) + rng.normal(size=dims) * 0.02 for _ in range(near)] + list(rng.normal(size=(300, dims)))
    step = rng.normal(size=dims)
    for _ in range(60):   # a chain: neighbours are linked, ends are not
        step = step + rng.normal(size=dims) * 0.12 * np.linalg.norm(step) / np.sqrt(dims)
        vectors.append(step)
    vectors += [2.5 * vectors[i] for i in range(near, near + 20)] + [vectors[near + 40]] * 50
    order = rng.permutation(len(vectors))
    return [(int(i), [float(np.float32(x)) for x in vectors[k]], int(k) % 2) for i, k in enumerate(order)]


@pytest.mark.parametrize("block", [pivots.BLOCK, 40])
def test_links_equal_all_pairs(spark, block):
    rows = crowd()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, pivots.classes(df, block=block).collect()))
    want = sorted(brute(rows))
    found, linked = sum(g[1] for g in got), sum(w[1] for w in want)
    assert linked > 5000 and found >= 0.999 * linked and all(g[1] <= w[1] for g, w in zip(got, want))
    assert found < linked or got == want


def test_few_pivots_lose_nothing(spark):
    """Fewer pivots than the permutation is long: every pair of a label is a candidate."""
    rows = crowd(near=40)[:120]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, pivots.classes(df, most=3).collect())) == sorted(brute(rows))


def test_awkward_vectors(spark):
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [NAN, 1.0], 1), (6, [INF, 1.0], 1), (7, [1.0, 0.0], None),
            (8, [1.0, 0.0], 1), (9, [1e300, 1e298], 1), (10, [3e-300, 0.0], 1), (10, [1.0, 0.0], 1), (11, [1.0, 0.0], 2), (12, [1.0, 0.0, 0.0], 1),
            (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1), (None, None, 1), (13, [1.0, 0.0, 0.001], 1), (8, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int") \
        .withColumns({c: F.lit("x") for c in ("node", "h1", "a.b", "least", "usable", "kept")}).withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    order = lambda r: sorted(r, key=str)
    assert order(map(tuple, pivots.classes(df).collect())) == order(brute(rows))
    assert pivots.classes(df.where("false")).count() == 0


def test_every_vector_is_indexed(spark):
    rows = crowd(near=10)
    _, nodes = pivots.nodes_of(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert nodes.agg(F.sum("copies")).first()[0] == len(rows)
    got = pivots.sampled_pivots(nodes, 20)[24]
    assert 3 < len(got) <= 20 and (got @ got.T - 2 * np.eye(len(got)) < 2 * 0.98 ** 2 - 1).all()
