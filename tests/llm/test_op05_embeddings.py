import math

import numpy as np
import pytest

from tessera.llm import op05_embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """{row number: (links, component)}"""
    ok = lambda v, label: (label is not None and v is not None and len(v) > 0
                           and all(c is not None and math.isfinite(c) for c in v) and any(v))
    use = [i for i, (_, v, label) in enumerate(rows) if ok(v, label)]
    links = {i: set() for i in range(len(rows))}
    for a in use:
        for b in use:
            x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
            if a < b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    seen = {}
    for i in links:
        todo, group = [i], {i}
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        seen[i] = (len(links[i]), min(ids, default=None))
    return seen


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE", 16)
    rng = np.random.default_rng(4)
    rows = []
    for g in range(25):
        base = rng.normal(size=24)
        for _ in range(rng.integers(1, 14)):
            rows.append((len(rows), (base + rng.normal(size=24) * rng.choice([0.05, 0.15, 0.2])).astype(np.float32).tolist(), g % 3))
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(9)] + [(2000, rows[3][1], 9), (2001, rows[3][1], None)]
    got = E.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want = {rows[i][0]: v for i, v in brute(rows).items()}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert max(n for n, _ in want.values()) > 8


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1),
            (6, [1.0, nan], 1), (7, [inf, 0.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1),
            (None, [0.0, 1.0], 1), (10, [], 1), (11, [3e38, 3e38], 1), (12, [1e-38, 1e-38], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cid", "'x' as tile", "2 as weight")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in E.near_vectors(df).collect()), key=str)
    assert got == sorted(((rows[i][0], *v) for i, v in brute(rows).items()), key=str)
    assert E.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_rows_of_possible_pairs_are_marked():
    """The first pass sees int8 rows only and marks a superset of the linked ones, not all."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 32))
    x[60:80] = x[:20] + rng.normal(size=(20, 32)) * 0.1
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, scale, error = E.quantise(x)
    for side in (np.zeros(120, np.int32), np.repeat(np.int32([0, 1]), 60)):
        table = pa.table({"a": np.ones(120, np.int64), "b": np.ones(120, np.int64), "side": side, "cid": np.arange(120),
                          "q": [r.tobytes() for r in q], "scale": scale, "error": error})
        marked = set(E._possible(0.98)(table)["cid"].to_pylist())
        near = x @ x.T
        np.fill_diagonal(near, 0)
        assert set(np.flatnonzero((near >= 0.98).any(axis=1)).tolist()) <= marked
        assert marked and len(marked) <= 2 * 20 and set(np.flatnonzero((near >= 0.96).any(axis=1)).tolist()) >= marked


@pytest.mark.parametrize("dim", [3, 64, 1500])
def test_bound_loses_no_pair(dim):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(200, dim))
    y = x + rng.normal(size=x.shape) * rng.uniform(0.15, 0.25, (200, 1))
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    i, j = E.tile_links(x, y, 0.98)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(v.tolist() for v in np.nonzero(x @ y.T >= 0.98))))


def test_far_tiles_are_skipped_and_no_link_is_lost(spark, monkeypatch):
    """Clusters around far centres: most tile pairs go, all links stay."""
    monkeypatch.setattr(E, "TILE", 16)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 8)) * 5
    x = np.concatenate([c + rng.normal(size=(40, 8)) * s for c in centres for s in (0.25,)] + [rng.normal(size=(60, 8))])
    rows = [(i, r.tolist(), 1) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = (u @ u.T >= E.THRESHOLD) & ~np.eye(len(x), dtype=bool)
    got = {r.vec_id: r.n_links for r in E.near_vectors(df.repartition(3)).collect()}
    assert got == {i: int(n) for i, n in enumerate(links.sum(axis=1))} and links.any()
    classes = df.selectExpr("label", "embedding as vec", "1L as weight", "vec_id as low", "vec_id as cid", "8 as dim")
    work, tiled = E.tile_pairs(classes, E.THRESHOLD)
    n = tiled.select("tile").distinct().count()
    assert work.count() < 0.7 * n * (n + 1) / 2 and tiled.count() == len(x)
