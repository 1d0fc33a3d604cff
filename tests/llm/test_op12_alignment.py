import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import op12_alignment as X

A_PATH, B_PATH = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LETTERS = X.byte_letters()


@pytest.fixture(scope="module")
def brute():
    """Groups [(A ids, B ids), ...] of a whole text, by the plain definition."""
    a_side = Tokenizer.from_file(A_PATH)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def groups(text):
        if not text:
            return []
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        xa = [bytes(LETTERS[c] for c in a_side.id_to_token(i)) for i in a]
        xb = [bytes([int(b_side.id_to_piece(i)[1:-1], 16)]) if b_side.is_byte(i)
              else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        if b"".join(xa) != whole or b"".join(xb) != whole:
            return []
        ends_a, ends_b = (np.cumsum([len(x) for x in xs]).tolist() for xs in (xa, xb))
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            m, n = ends_a.index(end) + 1, ends_b.index(end) + 1
            out.append((a[i:m], b[j:n]))
            i, j = m, n
        return out
    return groups


def rows(brute, docs):
    per = [brute(t) for _, t in docs]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in per]
    count = Counter(p for c in links for p in c)
    top = {}
    for (a, _), n in count.items():
        top[a] = max(n, top.get(a, 0))
    out = []
    for (doc_id, _), g, c in zip(docs, per, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(m for p, m in c.items() if count[p] == top[p[0]]), sum(m * count[p] for p, m in c.items()),
                    hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def aligner():
    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        return X.Aligner(f.read(), g.read())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab 'stre9\n\t.,é  漢Ñ\x1c\x7f\x85|<> \xa0à▁́ﬁ᠎\U0001f600 ", max_size=40)), max_size=4))
def test_groups_equal_those_of_whole_texts(brute, aligner, texts):
    counts, said, bounds, pairs, links = aligner.texts(texts)
    for i, t in enumerate(texts):
        g = brute(t)
        assert counts[:, i].tolist() == [sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(len(a) * len(b) for a, b in g)]
        want = Counter((x << 32 | y) for a, b in g for x in a for y in b)
        assert dict(zip(pairs[bounds[i]:bounds[i + 1]].tolist(), links[bounds[i]:bounds[i + 1]].tolist())) == want
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        assert said[i] == (hashlib.sha256(text.encode()).hexdigest() if g else "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=30), st.lists(st.integers(1, 4), max_size=30))
def test_coalescing(a, b):
    a, b = a + [1] * max(0, sum(b) - sum(a)), b + [1] * max(0, sum(a) - sum(b))
    ea, eb = np.cumsum(a, dtype=np.int64), np.cumsum(b, dtype=np.int64)
    ga, gb = X.coalesced(ea - a, ea, eb - b, eb)
    ends = sorted(set(ea.tolist()) & set(eb.tolist()))
    assert ga.tolist() == np.searchsorted(ends, ea).tolist() and gb.tolist() == np.searchsorted(ends, eb).tolist()


def test_cleared_cache_changes_nothing(aligner, monkeypatch):
    texts = ["alpha beta gamma", "beta  delta <|endoftext|> </s>", "x" * 3000, None, "alpha"]
    want = aligner.texts(texts)
    monkeypatch.setattr(X, "CACHE_CHUNKS", 1)
    got = aligner.texts(texts)
    assert all(np.array_equal(x, y) for x, y in zip(want, got))


def test_edges(spark, edge, nothing, brute):
    extra = spark.createDataFrame([(30, "a <|endoftext|> <s> b\n\n c", None, None, 1), (31, "x▁y", None, None, 1),
                                   (32, "aaaaaaaaaaaaaaa" * 40, None, None, 1), (33, "\U0001f600\U0001f600 " * 9, None, None, 1)], nothing.schema)
    docs = edge.select(*nothing.columns).unionAll(extra)
    short = docs.where("text is null or length(text) < 100000")
    got = X.aligned(short.selectExpr("*", "'x' as block", "1 as pairs", "2 as n", "3 as links").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == rows(brute, [(r.doc_id, r.text) for r in short.collect()])
    assert X.aligned(docs).count() == docs.count()
    assert X.aligned(nothing).count() == 0


def test_query_against_brute_force(spark, brute):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in X.op12_alignment(spark, d).collect()), key=str)
    assert got == rows(brute, docs) and any(r[4] for r in got)
