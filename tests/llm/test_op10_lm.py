import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tessera.llm import op10_lm as M


def brute(texts, order, min_count, alpha):
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for t in texts]
    c = Counter(tuple(w[i:i + k]) for w in words for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(map(len, words))

    def score(w, i):
        s = 1.0
        for k in range(min(order, i + 1), 0, -1):
            g = tuple(w[i - k + 1:i + 1])
            if k == 1:
                return s * c[g] / total
            if c[g] >= min_count:
                return s * c[g] / c[g[:-1]]
            s *= alpha
    return [(len(w), sum(math.log10(score(w, i)) for i in range(len(w)))) for w in words]


@pytest.mark.parametrize("order,min_count", [(1, 2), (2, 2), (2, 1), (3, 2), (3, 3)])
def test_against_a_dictionary(spark, monkeypatch, order, min_count):
    monkeypatch.setattr(M, "BLOCK_BYTES", 4000)
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(list("abcdEFgh"), rng.integers(0, 60))) for _ in range(300)] + [None, "", "a", " A\ta "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in M.backoff_scores(df, order=order, min_count=min_count).collect()}
    for i, (n, s) in enumerate(brute(texts, order, min_count, M.ALPHA)):
        assert got[i].n_words == n and got[i].log_prob == pytest.approx(s, abs=1e-9)
        assert (got[i].score is None) if n == 0 else got[i].score == pytest.approx(s / n)


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packing_round_trip(values):
    x = np.sort(np.array(values, np.uint64))
    assert (M.unpack(M.pack(x, True), np.uint64, True) == x).all()
    assert (M.unpack(M.pack(x[::-1]), np.uint64) == x[::-1]).all()


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50), st.integers(4, 40))
def test_every_hash_goes_to_its_range(values, bits):
    u = np.unique(np.array(values, np.uint64))
    some, parts = M._parts(u, 1 << bits)
    assert [int(x) >> (64 - bits) for p in parts for x in u[p]] == [r for r, p in zip(some.tolist(), parts) for _ in u[p]]
    assert len(set(some.tolist())) == len(some) and sum(len(u[p]) for p in parts) == len(u)


def test_more_ranges_than_entries(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_BYTES", 400)
    monkeypatch.setattr(M, "MIN_RANGES", 1 << 22)
    texts = ["a b c d", "b c a a b", None, "c", "a b c d e"] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.log_prob for r in M.backoff_scores(df).collect()}
    assert got == {i: pytest.approx(s, abs=1e-9) for i, (_, s) in enumerate(brute(texts, M.ORDER, M.MIN_COUNT, M.ALPHA))}


def test_edges(edge, nothing):
    rows = M.backoff_scores(edge).collect()
    texts = edge.collect()
    want = [(r.doc_id, n, None if not n else s) for r, (n, s) in zip(texts, brute([r.text for r in texts], 2, 2, M.ALPHA))]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    for got, (doc_id, n, s) in zip(sorted(((r.doc_id, r.n_words, r.log_prob) for r in rows), key=key), sorted(want, key=key)):
        assert got[:2] == (doc_id, n) and got[2] == pytest.approx(s or 0.0, rel=1e-9)
    assert M.backoff_scores(nothing).count() == 0

