"""Exact top-k inner-product search by norm-bucketed retrieval.

Vectors become integers, ``floor(256 x)`` per component, and are grouped by length
(Euclidean norm, buckets of ratio ``RATIO``; a bucket of many vectors is dealt into
blocks of about ``BLOCK_BYTES``). Blocks are visited from long to short in rounds of
``GROWTH`` times as many as before, so that each round knows a lower bound ``theta``
for every query's k-th score from the rounds before it.

In a round, a query meets only blocks with ``|q| * longest >= theta``; that pruning is
a Spark join of block and query tables. Within a block the *local cosine threshold*
``theta / (|q| * longest)`` chooses the pruning, per query:

- from ``COORDINATE_FROM`` on, *coordinates*: a vector within the angle
  ``arccos(threshold)`` of the query has each unit coordinate within that angle of the
  query's; sorted coordinate lists give the range, the narrowest of ``FOCUS`` focus
  coordinates is taken and the others filter it;
- below, *length*: the block is sorted by length, and its prefix of vectors with
  ``|q| |p| >= theta`` stays.

What is left is verified by integer products: in single or double precision where those
are exact, else in 64-bit or arbitrary integers. Bounds carry a margin for rounding and
ties are kept, so results are exact.

Equal vectors: only the k + 1 smallest ids of a group of equal vectors can enter a list
(one of them may be the query itself), so only those are candidates.

Rows: a null vector or one with null or non-finite components takes no part; vectors of
different length are not compared; an empty vector scores 0 with other empty ones. A
null vec_id is never a query, and as a candidate comes after all ids. Rows with the same
id are queries of their own, each against every other row. Components and scores beyond
64 bits are held at the 64-bit limits. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import small_enough, written

K, EVERY, SCALE = 5, 50, 256
RATIO, GROWTH = 1.05, 8
BLOCK_ROWS, BLOCK_BYTES, QUERY_ROWS = 16384, 16 << 20, 4096
COORDINATE_FROM, FOCUS = 0.9, 8
MARGIN = 1e-9
SUB = 256


def _matrix(column, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of q and p."""
    most = (int(max(-int(q.min()), int(q.max()))) * int(max(-int(p.min()), int(p.max()))) * q.shape[1]
            if q.size and p.size else 0)
    for kind, bits in ((np.float32, 24), (np.float64, 53), (np.int64, 63)):
        if most < 1 << bits:
            return (q.astype(kind) @ p.astype(kind).T).astype(np.int64)
    exact = q.astype(object) @ p.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Block:
    """Candidates of a block from long to short, with sorted coordinate lists."""

    def __init__(self, vec: np.ndarray, norm: np.ndarray):
        self.order = np.argsort(-norm, kind="stable")
        self.vec, self.norm = vec[self.order], norm[self.order]
        self.unit = self.vec / np.where(self.norm > 0, self.norm, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def prefix(self, shortest: float) -> int:
        """Number of vectors at least ``shortest`` long."""
        return int(np.searchsorted(-self.norm, -shortest, side="right"))

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            by = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = (by, self.unit[by, f])
        return self.lists[f]

    def near(self, unit_query: np.ndarray, cosine: float) -> np.ndarray:
        """Vectors whose focus coordinates allow the cosine with the unit query."""
        angle = np.arccos(min(1.0, cosine - MARGIN)) + MARGIN
        focus = np.argsort(-np.abs(unit_query), kind="stable")[:FOCUS]
        at = np.arccos(np.clip(unit_query[focus], -1, 1))
        low = np.cos(np.minimum(np.pi, at + angle)) - MARGIN
        high = np.cos(np.maximum(0.0, at - angle)) + MARGIN
        ranges = []
        for f, a, b in zip(focus.tolist(), low, high):
            by, values = self.coordinate(f)
            i, j = np.searchsorted(values, a, side="left"), np.searchsorted(values, b, side="right")
            ranges.append((j - i, i, j, by))
        _, i, j, by = min(ranges, key=lambda r: r[0])
        some = by[i:j]
        x = self.unit[some][:, focus]
        return some[((x >= low) & (x <= high)).all(axis=1)]


def best(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, null: np.ndarray, rid: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best hits, ties to the smaller id (null ids last)."""
    order = np.lexsort((rid, vec_id, null, -score, query))
    q = query[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[rank < k]


def search(q: np.ndarray, q_norm: np.ndarray, theta: np.ndarray, block: Block, k: int, own: np.ndarray):
    """(query row, block position, score) of all hits that may be among a query's k best:
    ``theta`` is NaN where nothing is known, ``own`` the query's position in the block or -1."""
    known = ~np.isnan(theta)
    bound = np.where(known, theta, -np.inf)
    longest = block.norm[0] if len(block.norm) else 0.0
    reach = q_norm * longest
    local = np.where(known & (bound > 0) & (reach > 0), bound / np.where(reach > 0, reach, 1), 0.0)
    out = []
    for i in np.flatnonzero(local >= COORDINATE_FROM).tolist():
        if local[i] > 1 + MARGIN:
            continue
        at = block.near(q[i] / q_norm[i], float(local[i]))
        score = products(q[i:i + 1], block.vec[at])[0]
        hit = (score >= bound[i]) & (at != own[i])
        out.append((np.full(int(hit.sum()), i), at[hit], score[hit]))
    rest = np.flatnonzero(local < COORDINATE_FROM)
    shortest = np.where(bound[rest] > 0, bound[rest] / np.where(q_norm[rest] > 0, q_norm[rest], np.inf), 0.0) * (1 - MARGIN)
    shortest = np.where((bound[rest] > 0) & (q_norm[rest] == 0), np.inf, shortest)
    rest, shortest = rest[np.argsort(shortest, kind="stable")], np.sort(shortest)
    for lo in range(0, len(rest), SUB):
        rows = rest[lo:lo + SUB]
        m = block.prefix(float(shortest[lo]))
        if not m:
            break
        score = products(q[rows], block.vec[:m])
        ok = np.ones(score.shape, bool)
        mine = np.flatnonzero((own[rows] >= 0) & (own[rows] < m))
        ok[mine, own[rows][mine]] = False
        ok &= score >= bound[rows][:, None]
        if m > k:
            ranked = np.where(ok, score, np.iinfo(np.int64).min)
            ok &= score >= np.partition(ranked, m - k, axis=1)[:, m - k][:, None]
        i, j = np.nonzero(ok)
        out.append((rows[i], j, score[i, j]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out))


def _visit(k: int):
    def run(table: pa.Table) -> pa.Table:
        asked = table["is_query"].to_numpy(zero_copy_only=False)
        vec = _matrix(table["vec"], len(table))
        rid, norm = table["rid"].to_numpy(), table["norm"].to_numpy()
        null = np.asarray(table["vec_id"].is_null())
        vec_id = table["vec_id"].fill_null(0).to_numpy()
        theta = table["theta"].to_numpy(zero_copy_only=False).astype(float)
        c, a = np.flatnonzero(~asked), np.flatnonzero(asked)
        a = a[np.argsort(rid[a], kind="stable")]
        block = Block(vec[c], norm[c])
        c = c[block.order]
        by = np.argsort(rid[c], kind="stable")
        at = np.searchsorted(rid[c][by], rid[a])
        own = np.full(len(a), -1)
        inside = at < len(c)
        own[inside] = np.where(rid[c][by][at[inside]] == rid[a][inside], by[at[inside]], -1)
        i, j, score = search(vec[a], norm[a], theta[a], block, k, own)
        kept = best(i, score, vec_id[c][j], null[c][j], rid[c][j], k)
        i, j = i[kept], c[j[kept]]
        return pa.table({"query": rid[a][i], "vec_id": pa.array(vec_id[j], pa.int64(), mask=null[j]), "rid": rid[j],
                         "score": score[kept]})
    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def prepared(vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(rid, vec_id, vec, dim, norm, bucket): usable rows with integer vectors, in the
    narrowest integer type that holds all components; a written table."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
    finite = ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.where(F.coalesce(finite, F.lit(False))).select(
        "vec_id", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("vec"))
    v = written(v.withColumn("rid", F.monotonically_increasing_id()), "integers")
    top = v.agg(F.min(F.array_min("vec")).alias("lo"), F.max(F.array_max("vec")).alias("hi")).first()
    kind = next((t for t, bits in (("smallint", 15), ("int", 31)) if top.lo is None or -(1 << bits) <= top.lo
                 and top.hi < 1 << bits), "bigint")
    squares = F.aggregate("vec", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    norm = F.col("norm")
    return v.withColumn("norm", F.sqrt(squares)).select(
        "rid", "vec_id", F.col("vec").cast(f"array<{kind}>").alias("vec"), F.size("vec").alias("dim"), "norm",
        F.when(norm > 0, F.floor(F.log(norm) / float(np.log(RATIO)))).otherwise(F.lit(-1)).alias("bucket"))


def top_products(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by ``every``
    the k other rows of the highest integer inner product."""
    v = written(prepared(vectors, scale, id_col, vector_col), "vectors")
    queries = v.where(F.col("vec_id") % every == 0).select("rid", "vec_id", "vec", "dim", "norm")
    count = queries.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    queries = written(queries.join(small_enough(written(count, "dims"), 16), "dim")
                      .withColumn("part", F.pmod(F.xxhash64("rid"), F.ceil(F.col("n") / QUERY_ROWS))).drop("n"), "queries")
    equal = Window.partitionBy("vec").orderBy(F.asc_nulls_last("vec_id"), "rid")
    c = v.join(small_enough(count, 16), "dim", "left_semi")
    c = written(c.withColumn("copy", F.row_number().over(equal)).where(F.col("copy") <= k + 1).drop("copy"), "candidates")
    rows = F.greatest(F.lit(SUB), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_BYTES) / (8 * (F.col("dim") + 1)))))
    sizes = (c.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"))
             .withColumn("blocks", F.ceil(F.col("n") / rows)))
    sizes = written(sizes.select("dim", "bucket", "longest", "blocks"), "buckets")
    c = written(c.join(small_enough(sizes.select("dim", "bucket", "blocks"), 32), ["dim", "bucket"])
                .withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks"))).drop("blocks"), "dealt")
    blocks = sizes.select("dim", "bucket", "longest", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("bucket"), "block"))
    blocks = written(blocks.withColumn("place", place - 1), "blocks")
    last = blocks.agg(F.max("place")).first()[0]
    kind = c.schema["vec"].dataType.simpleString()
    top = c.sparkSession.createDataFrame([], "query long, vec_id long, rid long, score long, rank int")
    lo, hi = 0, 1
    while last is not None and lo <= last:
        known = top.where(F.col("rank") == k).select(F.col("query").alias("rid"), F.col("score").cast("double").alias("theta"))
        asked = queries.join(known, "rid", "left").withColumn(
            "least", F.when(F.col("theta") > 0, F.col("theta") / F.col("norm") * (1 - MARGIN)).otherwise(F.lit(0.0)))
        asked = written(asked, "asked")
        here = blocks.where(F.col("place").between(lo, hi - 1))
        parts = asked.groupBy("dim", "part").agg(F.min("least").alias("least"))
        pairs = written(here.join(parts, "dim").where(F.col("longest") >= F.col("least"))
                        .select("dim", "bucket", "block", "longest", "part"), "pairs")
        left = (pairs.join(asked, ["dim", "part"]).where(F.col("longest") >= F.col("least"))
                .select("dim", "bucket", "block", "part", F.lit(True).alias("is_query"), "rid", "vec_id", "norm", "theta", "vec"))
        right = (pairs.join(c, ["dim", "bucket", "block"])
                 .select("dim", "bucket", "block", "part", F.lit(False).alias("is_query"), "rid", "vec_id", "norm",
                         F.lit(None).cast("double").alias("theta"), "vec"))
        found = (left.unionAll(right).withColumn("vec", F.col("vec").cast(kind))
                 .groupBy("dim", "bucket", "block", "part")
                 .applyInArrow(_visit(k), "query long, vec_id long, rid long, score long"))
        top = written(_ranked(top.drop("rank").unionAll(found), k), "top")
        lo, hi = hi, hi * GROWTH
    named = queries.select(F.col("rid").alias("query"), F.col("vec_id").alias("query_id"))
    return top.join(named, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda c: floor({SCALE} * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE len(embedding) > 0
    AND list_aggregate(list_transform(embedding, lambda c: coalesce(CAST(isfinite(c) AS INTEGER), 0)), 'min') = 1),
s AS (
  SELECT q.vec_id AS query_id, q.r, p.vec_id, CAST(list_inner_product(q.x, p.x) AS BIGINT) AS score, p.r AS pr
  FROM v q JOIN v p ON q.vec_id % {EVERY} = 0 AND q.r <> p.r AND len(q.x) = len(p.x)),
t AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, pr) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM t WHERE rank <= {K}
"""
