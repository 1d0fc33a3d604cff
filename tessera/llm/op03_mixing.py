"""Mixing sources to target weights, with DataFrame functions only.

Every row gets a hash-random key (md5 of id and text). Within a source, rows are
ranged by the first hex digits of the key and sorted in each range; sums per
range are added up first, so that the running word count of every row comes from
a small table of range totals and a window over one range. The mix takes whole
epochs of a source and, in key order, one partial epoch that ends exactly at the
source's budget (the row at the cut gives its first words).

Targets: sources in code point order, null last, have weights repeating
``weights``; together they get ``share`` of all words, none more than ``cap``
times its own words; the excess goes to the others by weight. With x the common
factor, a target is ``least(cap * size, x * weight)``; x is the largest of the
factors that follow from taking the first k sources, by rising cap-to-weight
ratio, as capped.

The table of sources (one row a source) is handled in one task; everything else
is spread. Rows: null text has no words and is taken 0 times; a null source is a
source of its own; rows equal in id, text and source share a key and are
interchangeable; an empty table gives an empty result. Other columns are ignored
by ``mix`` and kept by the pipeline stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
RANGE_DIGITS = 3


def _sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key, part) of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    return (docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                        key.alias("key"))
            .withColumn("part", F.substring("key", 1, RANGE_DIGITS)))


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, epochs, budget): whole epochs, and the words
    of the partial one."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    everything = Window.partitionBy()
    per = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("place", F.row_number().over(order) - 1)
           .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                              (F.col("place") % len(weights) + 1).cast("int")))
           .withColumn("total", F.sum("source_size").over(everything))
           .withColumn("most", F.col("source_size") * cap)
           .withColumn("ratio", F.col("most") / F.col("weight")))
    per = (per.withColumn("capped", F.sum("most").over(by_ratio) - F.col("most"))
           .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("x", F.max((F.col("total") * share - F.col("capped")) / F.col("open")).over(everything)))
    per = per.withColumn("target", F.least(F.col("most").cast("double"), F.col("x") * F.col("weight")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    per = per.withColumn("epochs", epochs.cast("long"))
    return per.select("source", "source_size", "target", "epochs",
                      (F.floor("target").cast("long") - F.col("epochs") * F.col("source_size")).alias("budget"))


def _prefix_sums(rows: DataFrame, per: DataFrame) -> DataFrame:
    """Rows with their source's columns and ``before``: words ahead of the row."""
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("part")
    parts = parts.withColumn("ahead", F.sum("words").over(running) - F.col("words")).drop("words")
    parts = parts.alias("r").join(per.alias("s"), F.expr("r.source <=> s.source")).select(
        "r.source", "part", "ahead", "source_size", "target", "epochs", "budget")
    inside = (Window.partitionBy("source", "part").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    sums = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (sums.alias("d").join(parts.alias("r"), F.expr("d.source <=> r.source and d.part = r.part"))
            .select("doc_id", "d.source", "key", "size", "source_size", "target", "epochs", "budget",
                    (F.col("ahead") + F.col("inside")).alias("before")))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``."""
    rows = written(_sized(docs), "sizes")
    per = written(targets(rows, weights, share, cap), "targets")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("before")))
    return _prefix_sums(rows, per).select(
        "doc_id", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (
  SELECT *, [3, 1, 2][CAST(place % 3 + 1 AS INTEGER)] AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total,
         source_size * 2 AS most FROM s),
r AS (
  SELECT *, CAST(sum(most) OVER (ORDER BY most / weight, place) - most AS BIGINT) AS capped,
         CAST(sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM w),
x AS (SELECT *, max((total * CAST(1.5 AS DOUBLE) - capped) / rest) OVER () AS x FROM r),
t AS (SELECT source, source_size, least(CAST(most AS DOUBLE), x * weight) AS target FROM x),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
"""


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it (texts without words
    are not taken). The documents are read, not shuffled: a source's partial epoch is known by the key at its cut;
    rows below it come once more, the row(s) at the cut with their first words
    (``n_chars`` then is that of the cut text), rows above it not."""
    names = docs.columns
    rows = written(_sized(docs), "sizes")
    per = written(targets(rows), "targets")
    sums = _prefix_sums(rows, per)
    keys = sums.groupBy("source", "key").agg(F.min("before").alias("before"), F.sum("size").alias("words"),
                                             F.first("budget").alias("budget"))  # repeated rows share a key
    at = (keys.where("before < budget and before + words >= budget")
          .groupBy("source").agg(F.min(F.struct("key", "before")).alias("at")))
    cuts = written(per.alias("s").join(at.alias("c"), F.expr("s.source <=> c.source"), "left").select(
        F.col("s.source").alias("__source"), F.col("epochs").alias("__epochs"), F.col("budget").alias("__budget"),
        F.col("at.key").alias("__cut"), F.col("at.before").alias("__before")), "cuts")
    key = F.md5(F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                            F.coalesce(F.col("text"), F.lit(""))))
    all_ = docs.withColumn("__key", key).join(cuts, F.col("source").eqNullSafe(F.col("__source")))
    whole = F.col("__epochs") + F.when(F.col("__key") < F.col("__cut"), 1).otherwise(0)
    full = (all_.where(F.col("text").rlike(WORD)).withColumn("__n", whole.cast("int")).where("__n > 0")
            .select(*names, F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*names))
    tie = Window.partitionBy("__source", "__key").orderBy("doc_id")
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD))
    edge = (all_.where("__key = __cut").withColumn("__nth", F.row_number().over(tie) - 1)
            .withColumn("__size", words)
            .withColumn("__take", F.least(F.col("__size"), F.col("__budget") - F.col("__before")
                                          - F.col("__nth") * F.col("__size")).cast("int")).where("__take > 0"))
    pieces = F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    first = F.when(F.col("text").rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    cut = F.when(F.col("__take") == F.col("__size"), F.col("text")).otherwise(
        F.array_join(F.slice(pieces, F.lit(1), F.col("__take") + first), ""))
    edge = edge.withColumn("text", cut)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        edge = edge.withColumn("n_chars", F.length("text").cast(kind))
    return full.unionAll(edge.select(*names))
