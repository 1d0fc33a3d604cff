import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import op04_quality as Q

D = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 3 <> 0")
    got = {r.doc_id: r for r in Q.quality(docs, train, F.col("source"), F.col("lang")).collect()}
    held = labels.where("doc_id % 3 = 0").collect()
    right = sum(got[r.doc_id].kept == bool(r.quality) for r in held)
    assert len(got) == docs.count() and right >= 0.9 * len(held)
    clean = [r for r in held if r.quality]
    assert sum(got[r.doc_id].kept for r in clean) >= 0.95 * len(clean)


def test_sparse_sites_shrink_to_their_parent(spark):
    good, bad = "A plain sentence with some words in it. " * 5, "JUNK!!! ### | $$$ || 123 " * 9
    rows = ([(i, good, "big", "p") for i in range(200)] + [(200 + i, bad, "bad", "p") for i in range(200)]
            + [(400, good, "bad", "q"), (401, good, "tiny", "p"), (402, None, None, None)])
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    labels = docs.select("doc_id", (F.col("host") == "big").cast("int").alias("quality")).where("doc_id < 400")
    got = {r.doc_id: r for r in Q.quality(docs, labels, F.col("host"), F.col("path")).collect()}
    assert got[0].path_rate > 0.9 > 0.1 > got[200].path_rate
    assert got[400].path_rate < 0.5 < got[0].path_rate  # a path of one page follows its host
    assert abs(got[401].path_rate - 0.5) < 0.2  # a host of one page follows the world
    assert len(got) == len(rows)


def test_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (3, 0), (6, 1), (None, 1), (99, 1), (7, None)], "doc_id long, quality int")
    rows = Q.quality(edge, labels, F.col("source"), F.col("lang")).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert Q.quality(nothing, labels, F.col("source"), F.col("lang")).count() == 0
    none = Q.quality(edge, labels.limit(0), F.col("source"), F.col("lang")).collect()
    assert {r.evidence for r in none} == {0.0}


def test_posteriors_against_plain_python(spark):
    """Host and path rates and scores worked out anew from the evidence."""
    docs, labels = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.withColumn("path", F.col("doc_id") % 7)
    got = Q.quality(docs, labels, F.col("source"), F.col("path")).collect()
    site = {r.doc_id: (r.source, (r.source, r.path)) for r in docs.select("doc_id", "source", "path").collect()}
    seen = [r.quality for r in labels.join(docs, "doc_id").select("quality").collect() if r.quality is not None]
    odds = math.log(sum(seen) / (len(seen) - sum(seen)))
    r_of = {r.doc_id: 1 / (1 + math.exp(-(r.evidence + odds))) for r in got}
    sums, ns = (defaultdict(float), defaultdict(float)), (defaultdict(int), defaultdict(int))
    for d, p in r_of.items():
        for level in (0, 1):
            sums[level][site[d][level]] += p
            ns[level][site[d][level]] += 1
    world = sum(r_of.values()) / len(r_of)

    def strength(level, parent):
        sites = list(ns[level])
        p = [parent(s) for s in sites]
        spread = sum((sums[level][s] / ns[level][s] - q) ** 2 for s, q in zip(sites, p)) / len(sites)
        noise = sum(q * (1 - q) / ns[level][s] for s, q in zip(sites, p)) / len(sites)
        most = sum(q * (1 - q) for q in p) / len(sites)
        return 1e6 if spread <= noise else min(max(most / (spread - noise) - 1, 1.0), 1e6)

    kh = strength(0, lambda s: world)
    kp = strength(1, lambda s: (sums[0][s[0]] + kh * world) / (ns[0][s[0]] + kh))
    for r in got:
        h, p = site[r.doc_id]
        own = r_of[r.doc_id]
        host = (sums[0][h] - own + kh * world) / (ns[0][h] - 1 + kh)
        path = (sums[1][p] - own + kp * host) / (ns[1][p] - 1 + kp)
        assert r.host_rate == pytest.approx(host, abs=1e-6) and r.path_rate == pytest.approx(path, abs=1e-6)
        assert r.score == pytest.approx(1 / (1 + math.exp(-(r.evidence + math.log(path / (1 - path))))), abs=1e-5)


def test_words_carry_evidence_and_own_labels_do_not(spark):
    """Texts alike in every surface measure, told apart by their words; random labels teach nothing."""
    import random

    rng = random.Random(3)
    vocab = [["lamp", "tree", "road", "wind"], ["mold", "scam", "fake", "spit"]]
    rows = [(i, " ".join(rng.choice(vocab[i % 2] + ["this", "that"]) for _ in range(40)) + ".", "h", "p") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    got = {r.doc_id: r.kept for r in Q.quality(docs, labels.where("doc_id < 300"), F.col("host"), F.col("path")).collect()}
    assert sum(got[i] == (i % 2 == 0) for i in range(300, 600)) > 290
    noise = docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 2).cast("int").alias("quality"))
    words = [(i, " ".join(f"{rng.randrange(10**9)}x" for _ in range(30)), "h", "p") for i in range(600)]
    unique = spark.createDataFrame(words, docs.schema)
    said = {r.doc_id: r.evidence for r in Q.quality(unique, noise, F.col("host"), F.col("path")).collect()}
    good = {r.doc_id: r.quality for r in noise.collect()}
    right = sum((said[i] > 0) == bool(good[i]) for i in said)
    assert right < 390  # with their own labels in the counts nearly all would be right
