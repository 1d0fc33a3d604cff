import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tessera.llm import op03_mixing as M


def water(sizes, weights, share, cap):
    """Targets by repeated resharing."""
    total, target, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(t for i, t in enumerate(target) if i not in open_)
        w = sum(weights[i % len(weights)] for i in open_)
        over = {i for i in open_ if left * weights[i % len(weights)] / w > cap * sizes[i]}
        for i in open_:
            target[i] = left * weights[i % len(weights)] / w
        for i in over:
            target[i] = cap * sizes[i]
        if not over:
            break
        open_ -= over
    return target


def test_targets_equal_repeated_resharing(spark):
    for sizes in ([10, 20, 30, 40, 50], [1, 1000, 3, 500, 2, 7], [0, 5, 9], [100], [0, 0]):
        rows = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, size long")
        got = {r.source: r.target for r in M.targets(rows).collect()}
        for i, t in enumerate(water(sizes, M.WEIGHTS, M.SHARE, M.CAP)):
            assert got[f"s{i}"] == pytest.approx(t)


def test_budget_is_met_and_the_plan_is_native(spark, edge):
    df = M.mix(edge)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    rows = df.collect()
    assert len(rows) == edge.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sum(r.target for r in {(r.source_size, r.target): r for r in rows}.values()) <= 1.5 * sum(r.size for r in rows) + 1e-6
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, M.mix(edge.repartition(5)).collect()), key=str)


def test_against_sql_on_edge_rows(spark, edge, nothing):
    documents = edge.select("doc_id", "text", "lang", "source", "n_chars").toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    documents = documents.astype({"text": object}).where(documents.notna(), None)
    con = duckdb.connect()
    con.register("documents", documents)
    want = Counter((r[0], r[1], r[4]) for r in con.sql(M.SQL).fetchall())
    assert Counter((r.doc_id, r.size, r.taken) for r in M.mix(edge).collect()) == want
    assert M.mix(nothing).count() == 0


def test_stage_writes_what_the_mix_takes(spark, edge):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    out = M.mixed(spark, edge, "")
    assert out.columns == edge.columns
    words = defaultdict(int)
    for r in out.collect():
        assert count(r.text) > 0
        words[r.source] += count(r.text)
    want = defaultdict(int)
    for r in M._prefix_sums(M._sized(edge), M.targets(M._sized(edge))).collect():
        want[r.source] += r.epochs * r.size + max(0, min(r.size, r.budget - r.before))
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in want.items() if v}


def test_repeated_rows_at_the_cut(spark):
    rows = [(1, "a b c d e f g", "en", "s", 13)] * 9 + [(2, "x y z", "en", "t", 5)] * 40 + [(3, "p q", "en", "u", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want, got = defaultdict(int), defaultdict(int)
    for r in M.mix(docs).collect():
        want[r.doc_id] += r.taken
    for r in M.mixed(spark, docs, "").collect():
        got[r.doc_id] += count(r.text)
        assert r.n_chars == len(r.text)
    assert got == want and any(n % 7 for n in got.values())
