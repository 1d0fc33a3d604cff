import math

import numpy as np
import pytest

from tessera.llm import op13_topk as T


def brute(rows, k=T.K, every=T.EVERY, scale=T.SCALE):
    v = [(i, r[0], [math.floor(scale * c) for c in r[1]]) for i, r in enumerate(rows)
         if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    out = []
    for i, q, x in v:
        if q is None or q % every:
            continue
        hits = [(-sum(a * b for a, b in zip(x, y)), p is None, p or 0, j) for j, p, y in v if j != i and len(x) == len(y)]
        out += [(q, n, None if none else p, -s) for n, (s, none, p, _) in enumerate(sorted(hits)[:k], 1)]
    return sorted(out, key=str)


def got(spark, rows, k=T.K):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    df = df.selectExpr("*", "'x' as rid", "1 as norm", "2 as bucket", "3 as dim", "4 as query", "5 as rank", "6 as score")
    return sorted((tuple(r) for r in T.top_products(df, k).collect()), key=str)


def vectors(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * rng.lognormal(0, spread, size=(n, 1))
    x[rng.integers(0, n, n // 8)] = x[0]  # a hot vector
    x[n // 2:n // 2 + 40] = x[1] + rng.normal(size=(40, dim)) * 1e-2
    return [(i, r.tolist()) for i, r in enumerate(x)]


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_equal_to_brute_force_over_many_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(T, "BLOCK_ROWS", 16)
    monkeypatch.setattr(T, "SUB", 16)
    monkeypatch.setattr(T, "QUERY_ROWS", 4)
    rows = vectors(3, 700, 6, spread)
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("scale", [1.0, 1e7, 1e12])
def test_products_stay_exact_at_any_size(scale):
    rng = np.random.default_rng(1)
    q, p = (np.floor(rng.normal(size=(5, 9)) * scale).astype(np.int64) for _ in range(2))
    want = [[max(-(1 << 63), min((1 << 63) - 1, sum(int(a) * int(b) for a, b in zip(x, y)))) for y in p] for x in q]
    assert T.products(q, p).tolist() == want


def test_both_prunings_lose_nothing():
    rng = np.random.default_rng(5)
    p = np.floor(rng.normal(size=(400, 8)) * 256).astype(np.int64)
    q = np.concatenate([p[:30] + rng.integers(-6, 7, (30, 8)), np.floor(rng.normal(size=(30, 8)) * 256).astype(np.int64)])
    norm = lambda x: np.sqrt((x.astype(float) ** 2).sum(axis=1))
    exact = q @ p.T
    for rank in (0, 2, 20):
        theta = np.sort(exact, axis=1)[:, ::-1][:, rank].astype(float)
        block = T.Block(p, norm(p))
        i, j, s = T.search(q, norm(q), theta, block, 500, np.full(len(q), -1))
        found = set(zip(i.tolist(), block.order[j].tolist()))
        assert found == {(a, b) for a, b in zip(*np.nonzero(exact >= theta[:, None]))}


def test_edges(spark, nothing):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (50, [None, 1.0]), (100, [nan, 1.0]), (3, [float("inf"), 0.0]),
            (None, [1.0, 0.0]), (150, [0.0, 0.0]), (200, []), (4, []), (250, [-1.0, -2.0]), (5, [1.0]), (300, [2.0]), (350, [1.0, 2.0, 3.0]),
            (400, [1e300, 1.0]), (6, [-1e300, 2.0])]
    assert [r for r in got(spark, rows) if r[0] not in (400,)][:3]
    assert got(spark, rows[:15]) == brute(rows[:15])
    big = [r for r in got(spark, rows) if r[0] == 400]
    assert [r[3] for r in big][:3] == [(1 << 63) - 1] * 3 and len(big) == 5
    empty = nothing.selectExpr("doc_id as vec_id", "array(1.0) as embedding")
    assert T.top_products(empty).count() == 0 and T.top_products(empty).columns == ["query_id", "rank", "vec_id", "score"]
    assert got(spark, rows[3:7]) == []


def test_query_equals_its_sql(spark):
    import duckdb

    d = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    want = sorted(duckdb.sql(T.SQL).fetchall())
    assert sorted(tuple(r) for r in T.op13_topk(spark, d).collect()) == want and want
