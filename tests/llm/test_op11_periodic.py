import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import op11_periodic as P


def brute_runs(w, shortest=P.MIN_LENGTH):
    n, found = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= 2 * q and e - s >= shortest:
                if not any(all(w[x] == w[x + p] for x in range(s, e - p)) for p in range(1, q)):
                    found.add((s, e, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    drop = {i for s, e, q in runs for i in range(s + q, e)}
    top = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2])) if runs else None
    best = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
    said = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    return (doc_id, len(runs), *best, hashlib.sha256(said.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def found(words, shortest=P.MIN_LENGTH):
    return [tuple(map(int, r)) for r in zip(*P.runs_of(np.array(words, np.uint64), shortest))]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([1, 4, 12]))
def test_equal_to_brute_force(words, shortest):
    assert found(words, shortest) == brute_runs(words, shortest)


@pytest.mark.parametrize("words", [[1] * 300, [1, 2] * 150, [1, 2, 1] * 90 + [1, 2], ([1] * 13 + [2]) * 9, list(range(500)),
                                   [int(c) for c in "0100101001001010010100100101001001"] * 3])
def test_regular_words(words):
    assert found(words) == brute_runs(words)


def test_many_documents_at_once_share_nothing():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 3, rng.integers(0, 80)).tolist() for _ in range(60)] + [[1] * 40] * 3
    key = np.array([d * 100 + w for d, doc in enumerate(docs) for w in doc], np.uint64)
    got = [tuple(map(int, r)) for r in zip(*P.runs_of(key))]
    want, at = [], 0
    for doc in docs:
        want += [(s + at, e + at, q) for s, e, q in brute_runs(doc)]
        at += len(doc)
    assert got == want and want


def test_long_periodic_text_is_fast():
    import time

    rng = np.random.default_rng(3)
    for words in ([7] * 200_000, np.tile(rng.integers(0, 50, 777), 300), np.repeat(rng.integers(0, 9, 20_000), rng.integers(1, 20, 20_000))):
        began = time.process_time()
        s, e, q = P.runs_of(np.asarray(words, np.uint64))
        assert len(s) and time.process_time() - began < 30


def test_equal_hashes_are_told_apart(monkeypatch):
    import pyarrow as pa

    text = " ".join(f"{'ab'[i % 2]}{i // 2 % 3}" for i in range(40)) + " " + "x y " * 9
    want = brute_runs(text.split())
    scan = P.tk.scan

    def colliding(arr, table, fold=False):
        for i, w in scan(arr, table, fold):
            w.hash = w.hash & np.uint64(1)
            yield i, w
    monkeypatch.setattr(P.tk, "scan", colliding)
    (row,) = P.document_runs([1], pa.array([text]), False)
    assert [tuple(map(int, r)) for r in zip(*row[1:])] == want


def test_edges(spark, edge, nothing):
    loop = " ".join(["eins zwei drei"] * 9)
    extra = spark.createDataFrame([(20, loop, None, None, 1), (20, loop, None, None, 1), (None, loop, None, None, 1),
                                   (21, "A a " * 8, None, None, 1), (22, "漢　字 é " * 12, None, None, 1)], nothing.schema)
    rows = edge.select(*nothing.columns).unionAll(extra)
    got = P.periodic_runs(rows.selectExpr("*", "'x' as runs", "1 as n_runs"), rewrite=True).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    short = {(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, digest(r.collapsed)) for r in got}
    want = [brute_row(r.doc_id, r.text) for r in rows.collect() if r.text is None or len(r.text) < 100_000]
    assert set(want) <= short and len(got) == rows.count()
    assert sum(r.doc_id == 20 and [tuple(x) for x in r.runs] == [(0, 27, 3)] and r.collapsed == "eins zwei drei" for r in got) == 2
    assert P.periodic_runs(nothing).count() == 0


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    want = [brute_row(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = [tuple(r) for r in P.op11_periodic(spark, d).collect()]
    assert sorted(got) == sorted(want) and any(r[1] for r in got)
