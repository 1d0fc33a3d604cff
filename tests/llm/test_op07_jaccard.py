import random
import re
from collections import Counter

import pytest

from tessera.llm.op07_jaccard import jaccard_join, keep_one_per_group, least_shared


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows):
    """{id: (size, component)} by comparing every pair."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            both = len(x & y)
            if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.fixture(scope="module")
def corpus():
    """Near copies at all distances around the threshold, chains, copies, a shared passage."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows, n = [], 0
    for size in (3, 5, 6, 9, 40, 90, 150, 400):
        base = [word() for _ in range(size)]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, size // 25 + 1))):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.2:
                w = w + [word() for _ in range(rng.randrange(size // 3 + 1))]
            rows.append((n, " ".join(w)))
            n += 1
    for _ in range(30):
        rows.append((n, " ".join(passage + [word() for _ in range(rng.randrange(5, 80))])))
        n += 1
    chain = [word() for _ in range(100)]
    for i in range(25):
        chain = chain[3:] + [word() for _ in range(3)]
        rows.append((n, " ".join(chain)))
        n += 1
    rows += [(n + i, rows[5][1].upper()) for i in range(20)]
    rng.shuffle(rows)
    return rows


def test_against_all_pairs(spark, corpus):
    got = jaccard_join(spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)).collect()
    want = brute(corpus)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert max(Counter(c for _, c in want.values()).values()) > 20


def test_many_blocks(spark):
    """More near copies than a block holds, with outliers that link with a few of them only."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(80)]
    rows = []
    for i in range(400):
        w = list(base)
        for p in rng.sample(range(80), rng.choice([0, 1, 1, 2, 3, 4])):
            w[p] = word()
        rows.append((i, " ".join(w)))
    got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_edges(spark, edge, nothing):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(edge).collect())
    n = len(shingles(" ".join(f"w{i % 977} q{i % 31}" for i in range(60_000))))
    want = [(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, n, 4), (5, n, 4), (6, 16, 6), (6, 16, 6), (7, 17, 6), (8, 1, 8),
            (9, 1, 9), (10, 1, 9), (None, 16, 6), (None, 0, None), (11, 1, 11), (12, 1, 12)]
    assert got == Counter(want)
    assert jaccard_join(nothing).count() == 0


def test_stage_keeps_one_of_each_group(spark, edge):
    kept = keep_one_per_group(spark, edge, "")
    assert kept.columns == edge.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([0, 1, 2, 3, 4, 6, 8, 9, 11, 12, None])


def test_stage_tells_texts_of_one_id_apart(spark, nothing):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(1, a), (2, a), (2, b), (5, a + " end"), (5, c), (7, b), (None, c), (None, d), (None, d), (None, d + " z"), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as __row2", "1 as component_id", "'h' as row")
    kept = keep_one_per_group(spark, docs, "")
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert {k: n for k, n in got.items() if k[1] not in (d, d + " z")} == {(1, a): 1, (2, b): 1, (5, c): 1, (9, None): 2}
    assert sum(n for k, n in got.items() if k[1] in (d, d + " z")) == 1
    assert keep_one_per_group(spark, nothing, "").count() == 0


def test_without_the_sketch_filter(spark, corpus):
    got = jaccard_join(spark.createDataFrame(corpus, "doc_id long, text string"), sketched=False).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(corpus)


def test_sketch_bound():
    assert least_shared(75, 100) == (17, 43)


def test_tables_that_nothing_reads_any_more_are_removed(spark, tmp_path):
    import glob

    before = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    left = lambda name: {d for d in glob.glob(f"{before}/tessera-{name}-*") if glob.glob(f"{d}/*.parquet")}
    old = {name: left(name) for name in ("sketches", "found", "sets")}
    rows = [(i, " ".join(f"w{i % 7}x{j}" for j in range(30)) + f" end{i % 3}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join(docs).collect()}
    assert got == {i: i % 7 for i in range(60)}
    assert not (left("sketches") - old["sketches"]) and not (left("found") - old["found"])
    assert len(left("sets") - old["sets"]) == 1  # the one that the lazy result of the last step came from
