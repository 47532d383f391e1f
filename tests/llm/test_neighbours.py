import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import neighbours as N


def table(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, embedding array<float>, model string, at int").withColumn("id", F.lit(1)).withColumn("v", F.lit(1))


def test_recall_and_order(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 32))
    x = (centres[rng.integers(0, 20, 1500)] + 0.5 * rng.standard_normal((1500, 32))).astype(np.float32)
    df = table(spark, [(f"c{i:04d}", v.tolist(), "m", 1) for i, v in enumerate(x)])
    cur = N.current_vectors(df, "chunk_id", "embedding", 32, ("model", "m"), "at")
    monkeypatch.setattr(N, "BLOCK_QUERIES", 7)
    q = cur.where(F.substring("id", -2, 2) == "00")
    got: dict = {}
    for r in N.top_k(cur, q, 5, 32).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.similarity))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 1500, 100):
        s = u @ u[i]
        s[i] = -9
        rows = sorted(got[f"c{i:04d}"])
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5] and [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        hits += len({r[1] for r in rows} & {f"c{j:04d}" for j in np.argsort(-s)[:5]})
    assert hits >= 0.9 * 75


def test_the_bound_holds():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = N.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64), atol=1e-5)
    codes, f = N.encode(x, turn)
    assert codes.shape == (400, 8) and codes.dtype == np.uint8
    q = N.Queries(x[:50], turn)
    miss = np.abs(q.estimate(codes, f) - x[:50] @ x.T) > q.bound(f, N.EPS)
    assert miss.mean() < 0.004


def test_dirt(spark):
    rnd = random.Random(3)
    v = [rnd.gauss(0, 1) for _ in range(16)]
    near = [a + 0.01 for a in v]
    rows = [
        ("a", v, "m", 1), ("b", [10 * y for y in v], "m", 1), ("c", [-y for y in v], "m", 1), ("c", near, "m", 2), ("d", near, "m", 1), ("e", None, "m", 1), ("f", [0.0] * 16, "m", 1), ("g", v[:5], "m", 1),
        ("h", [math.nan] + v[1:], "m", 1), ("i", [math.inf] + v[1:], "m", 1), ("j", v, "other", 1), (None, v, "m", 1), ("k", [None] + v[1:], "m", 1), ("a", v, "m", 1), ("l", [1e30 * y for y in v], "m", 1), ("l", v, "m", 0),
    ]
    df = table(spark, rows)
    cur = N.current_vectors(df, "chunk_id", "embedding", 16, ("model", "m"), "at")
    assert sorted(r.id for r in cur.collect()) == ["a", "b", "c", "d", "l"]
    got = {(r.query_id, r["rank"]): r.id for r in N.top_k(cur, cur.where("id = 'a'"), 3, 16).collect()}
    assert {got["a", 1], got["a", 2]} == {"b", "l"} and got["a", 3] == "c"  # copies of other lengths, then near ones by id
    assert N.top_k(cur, cur, 10, 16).count() == 20
    assert N.top_k(cur.limit(0), cur, 3, 16).count() == 0 and N.top_k(cur, cur.limit(0), 3, 16).count() == 0


@pytest.mark.parametrize("k", [1, 4])
def test_ties_go_by_id(spark, k):
    df = table(spark, [(f"x{i}", [1.0, 0.0, 0.0, 0.0], "m", 1) for i in range(9)])
    cur = N.current_vectors(df, "chunk_id", "embedding", 4)
    got = [r.id for r in N.top_k(cur, cur.where("id = 'x4'"), k, 4).orderBy("rank").collect()]
    assert got == ["x0", "x1", "x2", "x3"][:k]
