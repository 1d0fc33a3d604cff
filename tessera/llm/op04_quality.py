"""Quality classifier by hierarchical empirical Bayes.

Evidence of a document: a learned text score and surface measures of its whole text
(shares of upper case, symbols and digits, word length and variety, sentence ends,
repeated lines). The text score is the damped mean, over the document's distinct words
and word pairs hashed into ``2**BITS`` buckets, of the buckets' log-likelihood ratios of
good to bad labelled documents. All are cut into bins at the percentiles of the labelled
rows, and the log-likelihood ratio of good to bad per bin is read from counts over the
labelled rows. The sum over the measures, times ``EVIDENCE``, is the evidence. A labelled
document is left out of all counts that it is scored with: its text score comes from the
labelled documents of the other of two folds, and its bins' counts leave it out.

At most about ``TRAIN_ROWS`` labelled documents train (those below a hash threshold), so
that their labels can be broadcast; site sums and scores cover all documents.

Sites: with responsibilities r (probability of good given evidence and the global
rate), hosts and, below them, paths get posterior means by shrinkage:
``(sum r + k * parent) / (n + k)``. The prior strength k of each level is fitted by
the method of moments to the spread of site means beyond what counts alone would
give, so sparse sites move to their parent, large ones to their own mean. A
document's own r is left out of its site's sums. Its score is the probability from
evidence plus the log odds of its path's posterior; ``kept`` is score >= 0.5.

Site sums are grouped aggregates (map-side partial sums; a hot host costs one row
a task) of whole numbers, so they are the same in every run. Only counts per bucket and
bin and the global moments reach the driver.

Rows: null and empty texts have all measures 0; a null host or path is a site of
its own; labels that are null, and label rows without document, do not train;
repeated ids are rows of their own, a label given twice counts by its mean, >= 0.5
as good; without any label the evidence is 0. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import written

MEASURES = ("words", "upper", "symbol", "digit", "word_length", "variety", "stops", "repeats", "length")
BINS = 20
DAMP = 50  # added to the sizes that counts are divided by: shares of short texts move towards 0
EVIDENCE = 1.0
BITS, TRAIN_ROWS = 16, 1_000_000
UNIT = 1e9  # sums of probabilities are sums of this many parts
STRENGTH = (1.0, 1e6)

_CLASS = {name: np.array([test(chr(b)) if b < 128 else name == "letter" for b in range(256)])
          for name, test in {"letter": str.isalpha, "upper": str.isupper, "digit": str.isdigit,
                             "symbol": lambda c: c in "#$%&*+/<=>@[\\]^_`{|}~!", "stop": lambda c: c in ".?!",
                             "line": lambda c: c == "\n"}.items()}
_LINES = tk.byte_table(lambda b: b == 10, lower=False)


def _repeated(words: tk.Words) -> np.ndarray:
    """Share of units (words or lines) of each document that occurred before in it."""
    doc = words.doc()
    n = np.diff(words.bounds)
    if not len(doc):
        return np.zeros(len(n))
    distinct = np.unique(tk.mix64(words.hash ^ tk.mix64(doc.astype(np.uint64))), return_index=True)[1]
    return 1 - np.bincount(doc[distinct], minlength=len(n)) / np.maximum(n, 1)


def _buckets(words: tk.Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of all distinct buckets of a segment's words and word pairs."""
    doc, h = words.doc().astype(np.int64), words.hash
    pairs = tk.grams(h, 2)
    inside = doc[1:] == doc[:-1]
    h = np.concatenate([h, pairs[inside] if len(pairs) else pairs])
    doc = np.concatenate([doc, doc[1:][inside]])
    key = np.unique(doc << BITS | (h >> np.uint64(64 - BITS)).astype(np.int64))
    return key >> BITS, key & ((1 << BITS) - 1)


def _count_words(batches):
    """(bucket, part, n): labelled documents of each part (class + 2 * fold) with a bucket."""
    total = np.zeros(4 << BITS, np.int64)
    for batch in batches:
        part = batch.column(3).to_numpy(zero_copy_only=False)
        for first, words in tk.scan(batch.column(4), tk.SPACED, fold=True):
            doc, bucket = _buckets(words)
            total += np.bincount(bucket * 4 + part[first:][doc].astype(np.int64), minlength=4 << BITS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at >> 2), pa.array((at & 3).astype(np.int32)), pa.array(total[at])],
                                     names=["bucket", "part", "n"])


def _word_scores(words: tk.Words, part: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Damped mean log-likelihood ratio of each document; ``part`` is its own or -1."""
    n = len(words.bounds) - 1
    doc, bucket = _buckets(words)
    # by own fold (none, 0, 1): ratios from the documents of all folds, of fold 1, of fold 0
    own = np.where(part < 0, 0, part // 2 + 1)[doc]
    return np.bincount(doc, model[own, bucket], n) / (np.bincount(doc, minlength=n) + DAMP / 5)


def word_ratios(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """[3, buckets] log-likelihood ratios from counts [4, buckets] and documents [4] of the parts."""
    out = np.zeros((3, counts.shape[1]))
    for row, folds in enumerate(((0, 1), (1,), (0,))):
        bad, good = (sum(counts[k + 2 * f] for f in folds) for k in (0, 1))
        n_bad, n_good = (sum(total[k + 2 * f] for f in folds) for k in (0, 1))
        if n_bad and n_good:
            out[row] = np.log((good + 1) / (n_good + 2)) - np.log((bad + 1) / (n_bad + 2))
    return out


def _measure(model):
    def run(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, len(MEASURES)))
            part = batch.column(3).fill_null(-1).to_numpy()
            data, offs = tk.text_buffers(batch.column(4))
            for i, j in tk.segments(offs):
                seg, at = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]

                def count(name):
                    run = np.concatenate([[0], np.cumsum(_CLASS[name][seg])])
                    return run[at[1:]] - run[at[:-1]]

                words = tk.Words(seg, at, tk.SPACED)
                n, size, letters = np.maximum(np.diff(words.bounds), 1), np.diff(at), count("letter")
                out[i:j] = np.column_stack([
                    _word_scores(tk.Words(seg, at, tk.SPACED, True), part[i:j], model.value),
                    count("upper") / (letters + DAMP), count("symbol") / (size + DAMP), count("digit") / (size + DAMP),
                    letters / n, 1 - _repeated(words), count("stop") / (n + DAMP / 5), _repeated(tk.Words(seg, at, _LINES)),
                    np.log1p(np.diff(words.bounds))])
            good = pa.array((part % 2).astype(np.int32), mask=part < 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), good,
                                              *(pa.array(c) for c in out.T)], names=["doc_id", "host", "path", "good", *MEASURES])
    return run


def _known(labels: DataFrame) -> DataFrame:
    """(of, part) of the labelled documents that train, at most about TRAIN_ROWS: good (0, 1) + 2 * fold."""
    known = written(labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
                    .agg((F.avg("quality") >= 0.5).cast("int").alias("good")), "labels")
    n = known.count()
    if n > TRAIN_ROWS:
        known = known.where(F.xxhash64("doc_id") <= (1 << 64) * TRAIN_ROWS // n - (1 << 63))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    return F.broadcast(known.select(F.col("doc_id").alias("of"), (F.col("good") + 2 * fold).alias("part")))


def _bin(measure: str, edges: list[float]) -> Column:
    return sum((F.col(measure) > F.lit(e)).cast("int") for e in edges) if edges else F.lit(0)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _ratios(counts: dict, total: dict, m: str, width: int, left_out: int | None) -> list[float]:
    """Log-likelihood ratios of a measure's bins, for a row of class ``left_out`` without it."""
    def part(b, k):
        own = int(k == left_out)
        return math.log((max(counts.get((m, b, k), 0) - own, 0) + 1) / (total[k] - own + width))

    return [part(b, 1) - part(b, 0) for b in range(width)]


def evidence(rows: DataFrame, bins: int = BINS) -> tuple[Column, float]:
    """(column of log-likelihood ratios, rate of good labels) learned from the labelled rows."""
    seen = written(rows.where("good is not null").select("good", *MEASURES), "labelled")
    steps = F.array(*(F.lit(i / bins) for i in range(1, bins)))
    cuts = seen.agg(*(F.percentile_approx(m, steps, 10_000).alias(m) for m in MEASURES)).first()
    edges = {m: sorted(set(cuts[m] or [])) for m in MEASURES}
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("m"), _bin(m, edges[m]).alias("b")) for m in MEASURES)))
    counts = {(r.m, r.b, r.good): r.n for r in seen.select("good", pairs.alias("x")).groupBy("x.m", "x.b", "good")
              .agg(F.count(F.lit(1)).alias("n")).collect()}  # measures x bins x 2 at most
    total = {g: sum(n for (m, _, k), n in counts.items() if m == MEASURES[0] and k == g) for g in (0, 1)}
    if not total[0] or not total[1]:
        return F.lit(0.0), 0.5 if not sum(total.values()) else (total[1] + 1) / (sum(total.values()) + 2)
    found = F.lit(0.0)
    for m in MEASURES:
        tables = [F.array(*map(F.lit, _ratios(counts, total, m, len(edges[m]) + 1, own))) for own in (None, 0, 1)]
        table = F.when(F.col("good").isNull(), tables[0]).when(F.col("good") == 0, tables[1]).otherwise(tables[2])
        found = found + F.element_at(table, _bin(m, edges[m]) + 1)
    return found * EVIDENCE, total[1] / sum(total.values())


def _strength(sites: DataFrame, parent: Column, name: str) -> float:
    """Prior strength of a level from the spread of its means around ``parent``."""
    mean = F.col(f"{name}_sum") / F.col(f"{name}_n")
    m = sites.agg(F.avg((mean - parent) ** 2).alias("spread"), F.avg(parent * (1 - parent) / F.col(f"{name}_n")).alias("noise"),
                  F.avg(parent * (1 - parent)).alias("most")).first()
    if m.spread is None or m.spread <= m.noise:
        return STRENGTH[1]
    return float(f"{min(max(m.most / (m.spread - m.noise) - 1, STRENGTH[0]), STRENGTH[1]):.9g}")


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, evidence, host_rate, path_rate, score, kept) for every row."""
    site = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    docs = docs.select(F.col(id_col).alias("doc_id"), site(host).alias("host"), site(path).alias("path"),
                       F.col(text_col).alias("text"))
    known = _known(labels.select("doc_id", "quality"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.join(known, F.col("doc_id") == F.col("of"), "left").select("doc_id", "host", "path", "part", "text")
    known = docs.where("part is not null")
    table = (known.mapInArrow(tk.tidy(_count_words), "bucket long, part int, n long")
             .groupBy("bucket", "part").agg(F.sum("n").alias("n")).toArrow())  # four rows a bucket at most
    counts, total = np.zeros((4, 1 << BITS)), np.zeros(4)
    counts[table["part"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    for r in known.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():
        total[r.part] = r.n
    model = docs.sparkSession.sparkContext.broadcast(word_ratios(counts, total))
    rows = written(docs.mapInArrow(tk.tidy(_measure(model)), f"doc_id {kind}, host string, path string, good int, "
                                   + ", ".join(f"{m} double" for m in MEASURES)), "measures")
    said, rate = evidence(rows)
    odds = math.log(rate / (1 - rate)) if 0 < rate < 1 else 0.0
    rows = written(rows.select("doc_id", "host", "path", said.alias("evidence"))
                   .withColumn("r", _sigmoid(F.col("evidence") + odds)), "evidence")
    parts = F.sum(F.round(F.col("r") * UNIT).cast("long"))
    paths = rows.groupBy("host", "path").agg(parts.alias("path_parts"), F.count(F.lit(1)).alias("path_n"))
    hosts = paths.groupBy("host").agg(F.sum("path_parts").alias("host_parts"), F.sum("path_n").alias("host_n"))
    sites = paths.join(hosts, "host").withColumn("path_sum", F.col("path_parts") / UNIT).withColumn(
        "host_sum", F.col("host_parts") / UNIT)
    sites = written(sites, "sites")
    m = sites.agg((F.sum("path_parts") / UNIT).alias("s"), F.sum("path_n").alias("n")).first()
    world = F.lit(min(max((m.s or 0.0) / max(m.n or 0, 1), 1e-6), 1 - 1e-6))
    kh = _strength(sites.select("host", "host_sum", "host_n").distinct(), world, "host")
    host_rate = (F.col("host_sum") + kh * world) / (F.col("host_n") + kh)
    kp = _strength(sites.withColumn("hr", host_rate), F.col("hr"), "path")
    own_host = (F.col("host_sum") - F.col("r") + kh * world) / (F.col("host_n") - 1 + kh)
    own_path = (F.col("path_sum") - F.col("r") + kp * F.col("host_rate")) / (F.col("path_n") - 1 + kp)
    safe = lambda c: F.greatest(F.least(c, F.lit(1 - 1e-6)), F.lit(1e-6))
    return (rows.join(sites, ["host", "path"])
            .withColumn("host_rate", safe(own_host)).withColumn("path_rate", safe(own_path))
            .withColumn("score", _sigmoid(F.col("evidence") + _logit(F.col("path_rate"))))
            .select("doc_id", "evidence", "host_rate", "path_rate", "score", (F.col("score") >= 0.5).alias("kept")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of documents: the source as host, the language within it as path."""
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"),
                   F.col("source"), F.col("lang"))
