"""Embedding near-duplicates by int8 tile products with error bounds.

Vectors are compared within their label by cosine in double precision. Equal
vectors of a label form one class with a weight. ``PIVOTS`` classes of a label (the
smallest by hash) are its pivots; every class goes to its nearest pivot and, ordered by
the angle to it, into tiles of about ``TILE`` classes. A pair of tiles is one task, and is
skipped if, for any pivot, their ranges of angles to it are further apart than the
threshold's angle: by the triangle inequality on the sphere none of their vectors link.

A unit vector x is quantised to ``q = round(127 x / max|x|)`` with scale
``s = max|x| / 127`` and error norm ``e = |x - s q|``, kept per vector. For two
unit vectors ``|x.y - s_x s_y (q_x.q_y)| <= e_x (1 + e_y) + e_y``, plus a margin
for rounding; the integer products are exact (they stay below 2**24 up to 1,040
dimensions, where single precision does them; longer vectors use double). Pairs whose
upper bound reaches the threshold are recomputed in full precision, and only those
decide; the bound loses none.

Two passes: the first sends the tile pairs ``(q, s, e)`` alone, an eighth of the vector
in double, and marks the vectors that are in a possible pair there; the second sends the
full vectors of the marked ones to the same tile pair. A task returns, for each vector
with a link, the (weighted) number of its links in the tile pair and the smallest class
it is connected to there, never the pairs themselves; connected components run over
those star edges.

Rows: a null label, and null or zero vectors or ones with null or non-finite
components, link with nothing; vectors of different length are not compared. A
null vec_id is a vector like the others but never names a component (which is
null if all its ids are); repeated rows are vectors of their own. Other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import components, small_enough, written

TILE = 1024
PIVOTS, BINS = 4, 4096  # bins of a radian that are kept together or split by a hash
THRESHOLD = 0.98
ROUNDING = 1e-6


def quantise(x: np.ndarray):
    """(q, scale, error norm) of unit rows."""
    top = np.abs(x).max(axis=1) if len(x) else np.zeros(0)
    scale = top / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - q * scale[:, None], axis=1)


def upper_bounds(x, y) -> np.ndarray:
    """What the products of two tiles of quantised rows (q, scale, error norm) are at most."""
    (qx, sx, ex), (qy, sy, ey) = x, y
    wide = np.float32 if qx.shape[1] <= 1040 else np.float64
    near = (qx.astype(wide) @ qy.astype(wide).T) * sx[:, None] * sy
    return near + (ex[:, None] * (1 + ey) + ey + ROUNDING)


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of unit rows with x[i].y[j] >= threshold."""
    i, j = np.nonzero(upper_bounds(quantise(x), quantise(y)) >= threshold)
    hit = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        some = slice(at, at + (1 << 16))
        hit[some] = np.einsum("ij,ij->i", x[i[some]], y[j[some]]) >= threshold
    return i[hit], j[hit]


def _stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of n nodes by edges (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = np.minimum(new, new[new])
        if (new == low).all():
            return low
        low = new


def _possible(threshold: float):
    """Of the quantised rows of a tile pair, those in a pair that may reach the threshold."""
    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        q = np.frombuffer(b"".join(table["q"].to_pylist()), np.int8).reshape(len(side), -1)
        scale, error = table["scale"].to_numpy(), table["error"].to_numpy()
        x, y = ((q[side == s], scale[side == s], error[side == s]) for s in (0, 1))
        marked = np.zeros(len(side), bool)
        if len(y[0]):
            near = upper_bounds(x, y) >= threshold
            marked[side == 0], marked[side == 1] = near.any(axis=1), near.any(axis=0)
        else:
            near = upper_bounds(x, x) >= threshold
            near |= near.T  # the bound is not symmetric
            np.fill_diagonal(near, False)
            marked[:] = near.any(axis=1)
        return table.select(["a", "b", "side", "cid"]).filter(pa.array(marked))
    return run


def _tile_pair(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        order = np.lexsort((table["cid"].to_numpy(), side))
        side, cid, weight = side[order], table["cid"].to_numpy()[order], table["weight"].to_numpy()[order]
        vec = table["vec"].combine_chunks()
        flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = flat.reshape(len(cid), -1)[order]
        x = x / np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        first = int((side == 0).sum())
        if first < len(cid):
            i, j = tile_links(x[:first], x[first:], threshold)
            j = j + first
        else:
            i, j = tile_links(x, x, threshold)
            i, j = i[i < j], j[i < j]
        count = np.bincount(i, weight[j], len(cid)) + np.bincount(j, weight[i], len(cid))
        low = cid[_stars(len(cid), i, j)]
        some = count > 0
        return pa.table({"cid": cid[some], "links": count[some].astype(np.int64), "peer": low[some]})
    return run


def _units(batches):
    """Rows with their unit vectors, quantised ones too (no vector is empty or zero)."""
    for batch in batches:
        vec = batch.column(4)
        size = vec.value_lengths().to_numpy().astype(np.int64)
        flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        at = np.cumsum(size) - size
        q, scale, error = np.zeros(len(flat), np.int8), np.zeros(len(size)), np.zeros(len(size))
        if len(size):
            flat = flat / np.repeat(np.maximum.reduceat(np.abs(flat), at), size)
            flat = flat / np.repeat(np.sqrt(np.add.reduceat(flat * flat, at)), size)
        for d in np.unique(size):
            rows = np.flatnonzero(size == d)
            cells = at[rows, None] + np.arange(d)
            some, scale[rows], error[rows] = quantise(flat[cells])
            q[cells] = some
        offsets = pa.array(np.append(at, len(flat)), pa.int32())
        codes = pa.Array.from_buffers(pa.binary(), len(size), [None, offsets.buffers()[1], pa.py_buffer(q.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], codes, pa.array(scale), pa.array(error), pa.ListArray.from_arrays(offsets, pa.array(flat))],
            names=["label", "dim", "cid", "weight", "q", "scale", "error", "u"])


def tile_pairs(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(pairs of tiles (a, b) that may hold a link, quantised classes with their tile), written tables."""
    rows = classes.select("label", "dim", "cid", "weight", "vec")
    schema = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "vec"]
    units = rows.mapInArrow(tk.tidy(_units), ", ".join(schema) + ", q binary, scale double, error double, u array<double>")
    classes = written(units, "units")
    top = Window.partitionBy("label", "dim").orderBy(F.xxhash64("u"), "cid")
    pivots = (classes.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= PIVOTS)
              .select("label", "dim", "nth", F.col("u").alias("p")).groupBy("label", "dim")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "p"))), lambda x: x["p"]).alias("pivots")))
    pivots = written(pivots, "pivots")
    width = classes.agg(F.coalesce(F.max("dim"), F.lit(0)).alias("d")).first().d
    angle = "acos(greatest(-1D, least(1D, aggregate(zip_with(u, p, (x, y) -> x * y), 0D, (s, x) -> s + x))))"
    placed = (classes.join(small_enough(pivots, 8 * PIVOTS * (width + 4)), ["label", "dim"])
              .withColumn("angles", F.expr(f"transform(pivots, p -> {angle})")).drop("u", "pivots")
              .withColumn("near", F.expr("array_position(angles, array_min(angles))").cast("int"))
              .withColumn("bin", F.floor(F.array_min("angles") * BINS).cast("int")))
    placed = written(placed, "placed")
    bins = placed.groupBy("label", "dim", "near", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("label", "dim", "near").orderBy("bin")  # at most 3.2 x BINS rows
    bins = written(bins.withColumn("slot", F.floor((F.sum("n").over(before) - F.col("n")) / TILE))
                   .withColumn("parts", F.ceil(F.col("n") / TILE)).drop("n"), "bins")
    keys = ["label", "dim", "near", "slot", "part"]
    placed = (placed.join(small_enough(bins, 48), ["label", "dim", "near", "bin"])
              .withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("cid"), F.col("parts"))).otherwise(F.lit(0))))
    ranges = [f(F.get("angles", F.lit(i))).alias(f"{name}{i}") for i in range(PIVOTS) for name, f in (("lo", F.min), ("hi", F.max))]
    tiles = written(placed.groupBy(*keys).agg(*ranges).withColumn("tile", F.monotonically_increasing_id()), "tiles")
    rows_of = written(placed.join(small_enough(tiles.select(*keys, "tile"), 48), keys).select("tile", "cid", "q", "scale", "error"), "tiled")
    p, q = tiles.alias("p"), tiles.alias("q")
    most = float(np.arccos(threshold)) + ROUNDING
    close = F.expr("p.label = q.label and p.dim = q.dim and p.tile <= q.tile")
    for i in range(PIVOTS):
        gap = F.greatest(F.col(f"p.lo{i}") - F.col(f"q.hi{i}"), F.col(f"q.lo{i}") - F.col(f"p.hi{i}"))
        close &= F.coalesce(gap <= most, F.lit(True))
    work = p.join(q, close).select(F.col("p.tile").alias("a"), F.col("q.tile").alias("b"))
    return written(work, "work"), rows_of


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec"))
    plain = F.coalesce(~F.exists("vec", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False))
    usable = F.col("label").isNotNull() & plain & F.coalesce(F.exists("vec", lambda c: c != 0), F.lit(False))
    rows = written(v.withColumn("usable", F.coalesce(usable, F.lit(False)))
                   .withColumn("vec", F.when(F.col("usable"), F.col("vec"))), "vectors")
    good = rows.where("usable")
    classes = written(good.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("low"))
                      .withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")), "classes")
    work, rows_of = tile_pairs(classes, threshold)
    sent = ["cid", "q", "scale", "error"]
    first = work.join(rows_of, F.col("a") == F.col("tile")).select("a", "b", F.lit(0).alias("side"), *sent)
    second = (work.where("a <> b").join(rows_of, F.col("b") == F.col("tile"))
              .select("a", "b", F.lit(1).alias("side"), *sent))
    marked = written(first.unionAll(second).groupBy("a", "b")
                     .applyInArrow(_possible(threshold), "a long, b long, side int, cid long"), "possible")
    full = marked.join(classes.select("cid", "weight", "vec"), "cid")
    found = written(full.groupBy("a", "b")
                    .applyInArrow(_tile_pair(threshold), "cid long, links long, peer long"), "links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(found, "cid", "peer").select(F.col("node").alias("cid"), "component")
    named = (classes.select("cid", "label", "vec", "weight", "low").join(comp, "cid", "left").join(counts, "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select(
        "label", "vec", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    linked = good.join(named, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    return (linked.unionAll(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND list_aggregate(list_transform(embedding, lambda c: coalesce(CAST(isfinite(c) AS INTEGER), 0)), 'min') = 1
    AND list_aggregate(list_transform(embedding, lambda c: abs(c)), 'max') > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r AS (SELECT vec_id, vec_id AS x FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.x),
m AS (SELECT vec_id, min(x) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT m.vec_id, coalesce(n.n, 0) AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN n ON n.a = m.vec_id
"""
