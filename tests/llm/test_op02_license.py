import random
import re
from collections import Counter

import pytest

from tessera.llm import op02_license as L


def base_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    at, labels = [], set()
    for phrase, label in L.BASE:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_places_against_a_word_scan(spark):
    rng = random.Random(2)
    words = "CC by BY all rights reserved General public license, x é 4.0 -".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(300)] + [(300, "cc by cc by cc-by")]
    rows = L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = dict(docs)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_places(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.fixture(scope="module")
def fill():
    return " ".join(f"word{i}" for i in range(40))


def test_notices_with_edits(spark, fill):
    mit = L.NOTICES[0][0]
    edited = mit.split()
    edited[20:21] = ["changed", "here"]
    del edited[33]
    rows = [(0, f"{fill} {mit} {fill}", "mit"), (1, f"{fill} {' '.join(edited).upper()}", "mit"),
            (2, f"{fill} {' '.join(mit.split()[:14])} {fill}", ""), (3, fill, ""),
            (4, "Licensed under CC BY-NC 4.0. All rights reserved.", "cc-by,cc-by-nc,reserved"),
            (5, " ".join(reversed(mit.split())), ""), (6, f"{mit} {fill} {mit}", "mit")]
    got = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, label string")).collect()}
    assert {i: got[i].labels for i, _, _ in rows} == {i: x for i, _, x in rows}
    assert got[0].score == 1.0 and 0.6 <= got[1].score < 1.0 and got[3].score == 0.0


def test_edges(edge, nothing):
    rows = L.scan_licenses(edge).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in edge.collect())
    assert all((r.n_base, r.first_word, r.last_word, r.labels, r.score) == (0, None, None, "", 0.0) for r in rows)
    assert {r.doc_id: r.n_words for r in rows if r.doc_id in (0, 1, 2, 4)} == {0: 0, 1: 0, 2: 0, 4: 120_000}
    assert L.scan_licenses(nothing).count() == 0


def test_equal_hashes_of_other_words_are_no_hit():
    """Every gram gets one and the same hash: only the words can tell them apart."""
    import numpy as np
    import pyarrow as pa

    known = {7: {w for words in L.gram_words().values() for w in words}}
    grams = L.tk.grams
    L.tk.grams = lambda h, k: np.full(max(0, len(h) - k + 1), 7, np.uint64)
    try:
        text = "some words, All Rights reserved; and other words follow"
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
        (out,) = L._scan(np.ones(1 << 16, bool), [3], known)([batch])
    finally:
        L.tk.grams = grams
    assert out.column(2).to_pylist() == [[2]]
