"""Exact n-gram Jaccard join by set relations.

A document's set holds its distinct k-word shingles (64-bit hashes; words are
runs of non-white-space, A-Z lower-cased). A text with fewer than k words gives
its whole word sequence as the one element; a text without words gives the
empty set. Documents link when ``den * |x & y| >= num * |x | y|``.

Method, after the set-relation view of exact set joins:

1. *Equal sets* are one class, joined once through one representative.
2. *Sketch filter*: two linked sets have many of their ``SKETCH`` smallest hashes
   in common. A set leaves if fewer of its own than ``least_shared`` occur in any
   other sketch. For sets no larger than the sketch the bound is exact; for larger
   ones a linked set is lost with a chance below ``MISS`` (Chernoff bound on hash
   order), of the size of that of a hash collision.
3. *Index*: over the remaining sets elements are ordered by rising document
   frequency. Elements of frequency 1 cannot match; a set with too many of them
   leaves, the others index the rest of their prefix with positions.
4. *Leaders*: each index list proposes two leaders to its members; these pairs
   are verified and connected. Members of one component need no further answer.
5. *Block skipping*: members fall into blocks of about ``BLOCK`` sets by
   component; the index lists are lists of blocks, and a pair of blocks is
   skipped if both are of one component, or if their size ranges or their
   positions exclude a link.
6. *Derived answers*: inside a block pair, a set's overlaps with all others are
   derived from those of the set before it by adding and subtracting the lists
   of the elements in which the two differ, when that is less work than counting
   anew. Only links between different components are returned.

No pair of a copy group is expanded, but links between different sets are all
found or implied. Rows: null text is the empty set. A null id is allowed; such a
row belongs to its set's class but is never a representative's id unless all ids
of the class are null, in which case the class links with nothing and has a null
component. Rows that repeat an id are separate rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import components, discard, small_enough, written

SKETCH, MISS = 64, 1e-15
BLOCK = 128
WORDS, NUM, DEN = 5, 75, 100


def set_hashes(words: tk.Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (signed) of each document of a segment."""
    g = tk.grams(words.hash, k)
    b = words.bounds
    out = []
    for d in range(len(b) - 1):
        lo, hi = b[d], b[d + 1]
        if hi - lo >= k:
            u = np.unique(g[lo:hi - k + 1].view(np.int64))
        elif hi > lo:
            u = tk.grams(words.hash[lo:hi], hi - lo).view(np.int64)
        else:
            u = np.zeros(0, np.int64)
        out.append(u)
    return out


def _key(u: np.ndarray, seed: int) -> int:
    return int(np.add.reduce(tk.mix64(u.view(np.uint64) ^ tk.GRAM[seed]), dtype=np.uint64).view(np.int64)) if len(u) else 0


def least_shared(num: int, den: int) -> tuple[int, int]:
    """Sketch hashes that a set must share to stay: for sets larger than the
    sketch, and the most asked of smaller ones (their share of num/den otherwise)."""
    t, s = num / den, 0
    while s + 1 < SKETCH * t:
        f = s / SKETCH  # the chance that at most s of SKETCH are shared
        kl = (f * math.log(f / t) if f else 0) + (1 - f) * math.log((1 - f) / (1 - t))
        if math.exp(-SKETCH * kl) > MISS:
            break
        s += 1
    return s, SKETCH - SKETCH * (den - num) // num


def _sketches(k: int):
    def run(batches):
        for batch in batches:
            ids, keys, checks, sizes, parts = batch.column(0), [], [], [], []
            for _, words in tk.scan(batch.column(1), tk.SPACED):
                for u in set_hashes(words, k):
                    keys.append(_key(u, 40))
                    checks.append(_key(u, 41))
                    sizes.append(len(u))
                    parts.append(u[:SKETCH])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(keys, pa.int64()), pa.array(checks, pa.int64()), pa.array(sizes, pa.int64()),
                 tk.list_array(parts, pa.int64())], names=["doc_id", "key", "check", "n", "sketch"])
    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            cid, key, check = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            keys, parts, at = [], [], 0
            for _, words in tk.scan(batch.column(0), tk.SPACED):
                for u in set_hashes(words, k):
                    if _key(u, 40) == key[at] and _key(u, 41) == check[at]:  # an id may have other texts
                        keys.append(cid[at])
                        parts.append(u)
                    at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([len(p) for p in parts], pa.int64()),
                 tk.list_array(parts, pa.int64())], names=["key", "n", "items"])
    return run


def _links_in_blocks(num: int, den: int):
    """Links between components inside a pair of blocks (or inside one block)."""
    def run(pdf):
        import pandas as pd

        pdf = pdf.drop_duplicates("key").sort_values(["side", "label", "key"], kind="stable")
        keys, side, n = pdf["key"].to_numpy(), pdf["side"].to_numpy(), pdf["n"].to_numpy()
        sets = list(pdf["items"])
        if len(sets) < 2:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        m = len(sets)
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum([len(s) for s in sets])
        rows = [code[e - len(s):e] for s, e in zip(sets, ends)]
        owner = np.repeat(np.arange(m), [len(s) for s in sets])
        owner = owner[np.argsort(code, kind="stable")]
        at = np.concatenate([[0], np.cumsum(np.bincount(code))])

        def counts(items):
            """How many of ``items`` each set holds."""
            lo, size = at[items], at[items + 1] - at[items]
            total = int(size.sum())
            if not total:
                return np.zeros(m, np.int64)
            pos = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total)
            return np.bincount(owner[pos], minlength=m)

        _, group = np.unique(pdf["label"].to_numpy(), return_inverse=True)
        root = np.arange(group.max() + 1)

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        two = side.max() > 0
        prev, overlap, links = None, None, []
        for i in range(m):
            if two and side[i] == 1:
                break
            here = rows[i]
            if prev is not None:
                gone = np.setdiff1d(rows[prev], here, assume_unique=True)
                new = np.setdiff1d(here, rows[prev], assume_unique=True)
            if prev is not None and len(gone) + len(new) < len(here):
                overlap = overlap + counts(new) - counts(gone)
            else:
                overlap = counts(here)
            prev = i
            hit = den * overlap >= num * (n[i] + n - overlap)
            hit[:i + 1] = False
            if two:
                hit &= side == 1
            for j in np.flatnonzero(hit):
                x, y = find(group[i]), find(group[j])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((keys[i], keys[j]))
        a = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": a[:, 0], "b": a[:, 1]})
    return run


def _candidate_index(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(token, key, n, rest): prefix elements of frequency two and more, with the
    number of elements that stand behind them in their set's order."""
    items = sets.select("key", F.explode("items").alias("token"))  # sizes are joined back once per set
    shared = items.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ordered = (items.join(shared, "token").groupBy("key")
               .agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("s"))
               .withColumn("c", F.size("s")).join(sets.select("key", "n"), "key"))
    least = F.ceil(F.col("n") * num / F.lit(den)).cast("long")
    return (ordered.where(F.col("c") >= least)
            .withColumn("indexed", (F.col("c") - least + 1).cast("int"))
            .select("key", "n", "c", F.posexplode(F.expr("slice(s, 1, indexed)")).alias("i", "e"))
            .select(F.col("e.token").alias("token"), "key", "n",
                    (F.col("c") - F.col("i") - 1).alias("rest")))


def _sizes_fit(a, b, num: int, den: int):
    return F.least(a, b) * den >= F.greatest(a, b) * num


def _sketch_filter(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Classes whose sketch leaves a link possible. A hash of a sketch travels with the number
    of its class, which packs better than the class's two 64-bit keys."""
    sketch = classes.select("cid", F.explode("sketch").alias("token"))
    shared = sketch.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    near = sketch.join(shared, "token", "left_semi").groupBy("cid").agg(F.count(F.lit(1)).alias("c"))
    large, most = least_shared(num, den)
    need = F.when(F.col("n") >= SKETCH, large).otherwise(F.least(F.ceil(F.col("n") * num / den), F.lit(most)))
    return classes.join(near, "cid").where(F.col("c") >= need).drop("c")


def linked_classes(picked: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(node, component) over the numbers (cid) of the picked classes that link with another one."""
    texts = docs.join(small_enough(picked, 48), docs["doc_id"] == picked["rep"]).select("text", "cid", "key", "check")
    sets = written(texts.mapInArrow(tk.tidy(_sets(k)), "key long, n long, items array<long>"), "sets")
    if sets.count() != sets.select("key").distinct().count():  # repeated rows
        every, sets = sets, written(sets.dropDuplicates(["key"]), "sets")
        discard(every)
    index = written(_candidate_index(sets, num, den), "index")
    every, sets = sets, written(sets.join(index.select("key").distinct(), "key", "left_semi"), "sets")
    discard(every)

    # leaders: the two extremes of a fixed random order of the members of each list
    me = F.struct(F.xxhash64("key").alias("o"), "key", "n")
    lead = index.groupBy("token").agg(F.min(me).alias("lo"), F.max(me).alias("hi"), F.count(F.lit(1)).alias("c"))
    proposed = index.join(lead.where("c > 1"), "token")
    near = written(proposed.groupBy("key").agg(F.min("lo").alias("lo")).select("key", F.col("lo.key").alias("place")),
                   "place")
    pairs = (proposed.select("key", "n", F.explode(F.array("lo", "hi")).alias("l"))
             .where((F.col("key") != F.col("l.key")) & _sizes_fit(F.col("n"), F.col("l.n"), num, den))
             .select(F.least("key", "l.key").alias("a"), F.greatest("key", "l.key").alias("b")).distinct())
    x = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("items").alias("xa"))
    y = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("items").alias("xb"))
    both = F.size(F.array_intersect("xa", "xb"))
    first = written(pairs.join(x, "a").join(y, "b").withColumn("o", both)
                    .where(F.col("o") * den >= (F.col("na") + F.col("nb") - F.col("o")) * num)
                    .select("a", "b"), "links")
    label = written(components(first), "labels")

    # blocks of sets: parts of a large component, or small components of one place
    nodes = (near.join(label.withColumnRenamed("node", "key"), "key", "left")
             .select("key", "place", F.coalesce("component", "key").alias("label")))
    nodes = written(nodes, "nodes")
    size = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    nodes = nodes.join(size, "label")
    rest = (nodes.where(F.col("size") < BLOCK).groupBy("place").agg(F.count(F.lit(1)).alias("around")))
    large = F.struct(F.lit(1), F.col("label"), F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / BLOCK)))
    small = F.struct(F.lit(0), F.col("place"), F.pmod(F.xxhash64("label"), F.ceil(F.col("around") / BLOCK)))
    nodes = written(nodes.join(rest, "place", "left")
                    .select("key", "label", F.when(F.col("size") >= BLOCK, F.xxhash64(large))
                            .otherwise(F.xxhash64(small)).alias("block")), "blocks")
    pure = nodes.groupBy("block").agg(
        F.when(F.min("label") == F.max("label"), F.min("label")).alias("pure"), F.count(F.lit(1)).alias("size"))
    lists = (index.join(nodes, "key").groupBy("token", "block")
             .agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("rest").alias("rest"),
                  F.min("label").alias("l0"), F.max("label").alias("l1")))
    lists = written(lists, "lists")
    p, q = lists.alias("p"), lists.alias("q")
    fits = (F.greatest("p.n0", "q.n0") * num <= F.least("p.n1", "q.n1") * den)
    ahead = F.least("p.rest", "q.rest") + 1
    enough = ahead * (num + den) >= (F.col("p.n0") + F.col("q.n0")) * num
    same = (F.col("p.l0") == F.col("p.l1")) & (F.col("q.l0") == F.col("q.l1")) & (F.col("p.l0") == F.col("q.l0"))
    across = (p.join(q, (F.col("p.token") == F.col("q.token")) & (F.col("p.block") < F.col("q.block"))
                     & fits & enough & ~same)
              .select(F.col("p.block").alias("pa"), F.col("q.block").alias("pb")).distinct())
    alone = pure.where("pure is null and size > 1").select(F.col("block").alias("pa"), F.col("block").alias("pb"))
    work = written(across.unionAll(alone), "work")
    sides = (work.select("pa", "pb", F.lit(0).alias("side"), F.col("pa").alias("block"))
             .unionAll(work.where("pa <> pb").select("pa", "pb", F.lit(1).alias("side"), F.col("pb").alias("block"))))
    second = (sides.join(nodes, "block").join(sets, "key")
              .select("pa", "pb", "side", "key", "label", "n", "items")
              .groupBy("pa", "pb").applyInPandas(_links_in_blocks(num, den), "a long, b long"))
    links = written(first.unionAll(second), "links")
    return components(links)


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                 num: int = NUM, den: int = DEN, sketched: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``. Without
    ``sketched`` step 2 is left out, at the cost of indexing all sets."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(docs.mapInArrow(tk.tidy(_sketches(k)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                   "key long, check long, n long, sketch array<long>"), "sketches")
    every, rows = rows, written(rows.select("doc_id", "key", "check", "n"), "rows")
    found = (every.where("n > 0 and doc_id is not null").groupBy("key", "check", "n")
             .agg(F.min("doc_id").alias("rep"), F.min_by("sketch", "doc_id").alias("sketch")))
    found = written(found.withColumn("cid", F.monotonically_increasing_id()), "found")
    discard(every)
    picked = _sketch_filter(found, num, den) if sketched else found
    picked = written(picked.select("cid", "key", "check", "rep"), "picked")
    classes = written(found.drop("sketch"), "classes")
    discard(found)
    comp = linked_classes(picked, docs, k, num, den)
    named = classes.join(comp.select(F.col("node").alias("cid"), "component"), "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    # a table of its own: broadcast where small, else a join whose hot components can be split
    smallest = written(named.groupBy("component").agg(F.min("rep").alias("component_id")), "smallest")
    named = written(named.join(small_enough(smallest, 48), "component").select("key", "check", "n", "component_id"), "named")
    return (rows.join(named, ["key", "check", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = fr"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {WORDS - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 2}, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE {DEN} * o >= {NUM} * (na.n + nb.n - o)),
r AS (SELECT doc_id, doc_id AS x FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.x)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(x) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest id stays. Rows are told
    apart by id and text, so texts that share an id, and texts without an id (which come
    after all ids), are each judged by their own text; of rows equal in both one stays.
    Rows without words link with nothing and all stay."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    found = written(jaccard_join(docs.select(row.alias("row"), "text"), id_col="row"), "groups")
    lost = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__row")).distinct(), "lost")
    marked = docs.withColumn("__row", row)
    kept = marked.join(small_enough(lost, 32), "__row", "left_anti")
    twice = written(found.where("n_shingles > 0 and doc_id = component_id").groupBy("doc_id").count().where("count > 1")
                    .select(F.col("doc_id").alias("__row")), "repeated")
    if twice.take(1):
        again = small_enough(twice, 32)
        kept = (kept.join(again, "__row", "left_anti")
                .unionAll(kept.join(again, "__row", "left_semi").dropDuplicates(["__row"])))
    return kept.select(*docs.columns)
