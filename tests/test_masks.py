import random

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import masks as M

H = [3, 1074, 537, 500, 203]
CASES = [
    ([], []),
    ([3, 1074], [0, 0]),
    (H + [7, 8, 4, 0, 0], [0] * 5 + [1, 1, 1, 0, 0]),
    (H + [7, 8], [0] * 7),
    (H + [4], [0] * 5 + [1]),
    (H + [7, 4, 9] + H + [8, 4], [0] * 5 + [1, 1, 0] + [0] * 5 + [1, 1]),
    (H + H + [7, 4], [0] * 5 + [1] * 7),
    ([3, 1074, 537, 500, 4], [0] * 5),
]


def test_span_mask_cases(spark):
    df = spark.createDataFrame([(i, ids) for i, (ids, _) in enumerate(CASES)], "k long, ids array<int>")
    got = {r.k: r.loss_mask for r in M.span_mask(df, "ids", H, 4).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, (i, got[i], want)


def test_array_form_equals_relational_form(spark):
    rnd = random.Random(7)
    seqs = []
    for k in range(300):
        s = []
        while len(s) < rnd.randint(0, 60):
            r = rnd.random()
            s += H if r < 0.15 else ([4] if r < 0.3 else [rnd.choice([7, 8, 9, 3, 203])])
        seqs.append((k, s[:60]))
    df = spark.createDataFrame(seqs, "k long, ids array<int>")
    arr = {r.k: r.loss_mask for r in M.span_mask(df, "ids", H, 4).collect()}
    long = df.select("k", F.posexplode("ids").alias("pos", "id"))
    rel = M.span_mask_long(long, "k", "pos", "id", H, 4)
    got = {}
    for r in rel.collect():
        got.setdefault(r.k, {})[r.pos] = r.mark
    for k, s in seqs:
        assert arr[k] == [got.get(k, {}).get(p) for p in range(len(s))], k


def test_shift_alignment(spark):
    df = spark.createDataFrame([(1, list(range(10, 18)), [1] * 6 + [0, 0])],
                               "k long, ids array<int>, loss_mask array<int>")
    r = M.shift(df, "ids", "loss_mask", 8).first()
    assert r.x == list(range(10, 17)) and r.y == list(range(11, 18))
    assert r.x[1:] == r.y[:-1] and r.loss_mask == [1] * 5 + [0, 0]


def test_answer_header_bytes():
    h = M.answer_header()
    assert h[0] == 3 and h[-1] == 203 and len(h) == 11


def test_cuts(spark):
    df = spark.createDataFrame([(1, [5, 6, 4, 7])], "k long, ids array<int>")
    r = df.select(A.cut_at("ids", 4, False).alias("a"), A.cut_at("ids", 4, True).alias("b"),
                  A.keep_last("ids", 2).alias("c"), A.drop_prompt("ids", 1).alias("d")).first()
    assert r.a == [5, 6] and r.b == [5, 6, 4] and r.c == [4, 7] and r.d == [6, 4, 7]
