"""Stupid-backoff scores from hash-partitioned n-gram counts.

Words are runs of non-white-space, A-Z lower-cased. With counts c over all rows
and T words in all, the first word of a text scores ``c(w) / T``; a word behind a
context scores ``c(context w) / c(context)`` for the longest context whose n-gram
was seen ``MIN_COUNT`` times or more, times ``ALPHA`` for every order given up;
single words are never pruned. A row's score is the mean log10 over its words.

The counts come from the corpus itself, so the work is an exchange by hash:
documents form blocks of about ``BLOCK_BYTES`` (written as arrays of word
numbers); each block sends its distinct n-gram hashes with their counts, split by
hash range, to that range's count table (grouped by range, one sorted merge) and
receives the total count of each back; then it sums the logarithms per document.
A frequent n-gram is one entry per block, not one per occurrence, so no range
grows with a hot n-gram's places. The number of ranges follows the size of the texts
without a cap, so a range's distinct n-grams stay bounded; a block sends at most one row per
distinct n-gram, whatever their number, so rows grow no faster than the input. What does
grow in a range is one entry per block for an n-gram that every block holds.

This is the join of block-wise exploded n-grams with hash-partitioned count tables, with
the rows of a block and a range packed into one. As single rows (block, n-gram, n),
repartitioned and equi-joined, the same join wrote 119.5 million rows and 1,335 MB in one
exchange for 0.51 GB of text, and was stopped by the check tool beyond 2.34 GB of disk.

``MIN_COUNT`` is 2 because every n-gram of a row is in the corpus once by itself: with 1
nothing would ever back off. ``ORDER`` is a parameter; order 3 nearly doubles the entries
and does not fit the same disk.

Rows: null and empty texts have no words, log probability 0 and a null score; ids
may be null or repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import written

ORDER, ALPHA, MIN_COUNT = 2, 0.4, 2
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 8 << 20
MIN_RANGES = 16


def pack(x: np.ndarray, rising: bool = False) -> bytes:
    """Unsigned integers as compressed byte planes; rising ones as differences."""
    import zstandard

    if rising and len(x):
        x = np.concatenate([x[:1], np.diff(x)])
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T) if len(x) else x
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes, kind, rising: bool = False) -> np.ndarray:
    import zstandard

    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    x = np.ascontiguousarray(flat.reshape(width, -1).T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if rising else x


def _blocks(batches):
    """One row per block: ids, word count of each document, distinct word hashes, word numbers."""
    nth = 0
    for batch in batches:
        _, offs = tk.text_buffers(batch.column(1))
        for i, j in tk.segments(offs, BLOCK_BYTES):
            hashes, sizes = [], []
            for _, words in tk.scan(batch.column(1).slice(i, j - i), tk.SPACED):
                hashes.append(words.hash)
                sizes.append(np.diff(words.bounds))
            h = np.concatenate(hashes)
            u, number = np.unique(h, return_inverse=True)
            block = (TaskContext.get().partitionId() << 24) + nth
            nth += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([len(h)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column(0).slice(i, j - i)),
                 pa.array([pack(np.concatenate(sizes).astype(np.uint32))], pa.binary()),
                 pa.array([pack(u, True)], pa.binary()), pa.array([pack(number.astype(np.uint32))], pa.binary())],
                names=["block", "words", "ids", "sizes", "vocabulary", "numbers"])


class Block:
    """Word hashes of a block and its n-grams."""

    def __init__(self, sizes: bytes, vocabulary: bytes, numbers: bytes):
        self.sizes = unpack(sizes, np.uint32).astype(np.int64)
        self.hash = unpack(vocabulary, np.uint64, True)[unpack(numbers, np.uint32)]
        ends = np.cumsum(self.sizes)
        self.start = np.repeat(ends - self.sizes, self.sizes)

    def grams(self, k: int):
        """(hash of the k words that end at each place, which places have them)."""
        n = len(self.hash)
        h = np.zeros(n, np.uint64)
        if n >= k:
            h[k - 1:] = tk.grams(self.hash, k)
        return h, np.arange(n) - self.start >= k - 1

    def entries(self, order: int):
        """Sorted distinct n-gram hashes of all orders, with counts."""
        found = [h[has] for h, has in (self.grams(k) for k in range(1, order + 1))]
        return np.unique(np.concatenate(found), return_counts=True)


def _parts(u: np.ndarray, ranges: int):
    """(hash ranges that sorted ``u`` touches, its slice in each); ``ranges`` is a power of two."""
    of = (u >> np.uint64(65 - int(ranges).bit_length())).astype(np.int64)
    start = np.flatnonzero(np.diff(of, prepend=-1))
    return of[start], [slice(i, j) for i, j in zip(start, [*start[1:], len(u)])]


def _requests(order: int, ranges: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                u, c = Block(row["sizes"], row["vocabulary"], row["numbers"]).entries(order)
                some, parts = _parts(u, ranges)
                for at in range(0, len(some), 1 << 16):
                    here = parts[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(here), row["block"]), pa.int64()), pa.array(some[at:at + (1 << 16)], pa.int64()),
                         pa.array([pack(u[p], True) for p in here], pa.binary()),
                         pa.array([pack(c[p].astype(np.uint64)) for p in here], pa.binary())],
                        names=["block", "range", "hashes", "counts"])
    return run


def _count(table: pa.Table) -> pa.Table:
    told = _totals(table)
    tk.free_memory()
    return told


def _totals(table: pa.Table) -> pa.Table:
    """Total counts of one hash range, in the order each block asked for them."""
    asked = [unpack(x, np.uint64, True) for x in table["hashes"].to_pylist()]
    n = np.concatenate([unpack(x, np.uint64) for x in table["counts"].to_pylist()]).astype(np.int64)
    u, back = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.zeros(len(u), np.int64)
    np.add.at(total, back, n)
    told = np.split(total[back], np.cumsum([len(x) for x in asked])[:-1])
    return pa.table({"block": table["block"], "range": table["range"],
                     "totals": pa.array([pack(x.astype(np.uint64)) for x in told], pa.binary())})


def log_scores(block: Block, totals, order: int, words: int, min_count: int, alpha: float) -> np.ndarray:
    """log10 score of every word of a block; ``totals(hashes)`` gives corpus counts."""
    h, has = block.grams(1)
    below = totals(h)
    score = np.log10(below / words)
    for k in range(2, order + 1):
        h, has = block.grams(k)
        c = np.zeros(len(h))
        c[has] = totals(h[has])
        seen = has & (c >= min_count)
        at = np.flatnonzero(seen)
        score[has & ~seen] += np.log10(alpha)
        score[at] = np.log10(c[at] / below[at - 1])
        below = c
    return score


def _score(order: int, words: int, min_count: int, alpha: float):
    def run(store: pa.Table, told: pa.Table) -> pa.Table:
        scores = scored(store, told)
        tk.free_memory()
        return scores

    def scored(store: pa.Table, told: pa.Table) -> pa.Table:
        row = store.slice(0, 1)
        block = Block(*(row[c][0].as_py() for c in ("sizes", "vocabulary", "numbers")))
        ids = row["ids"].combine_chunks().flatten()
        n = block.sizes
        if len(block.hash):
            u, _ = block.entries(order)
            parts = told.sort_by("range")["totals"].to_pylist()
            c = np.concatenate([unpack(x, np.uint64) for x in parts]).astype(float)
            score = log_scores(block, lambda h: c[np.searchsorted(u, h)], order, words, min_count, alpha)
            total = tk.sums(score, np.concatenate([[0], np.cumsum(n)]))
        else:
            total = np.zeros(len(n))
        mean = total / np.maximum(n, 1)
        return pa.table({"doc_id": ids, "n_words": pa.array(n, pa.int64()), "log_prob": pa.array(total),
                         "score": pa.array(mean, mask=n == 0)})
    return run


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                   min_count: int = MIN_COUNT, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, n_words, log_prob, score) for every row."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    ranges = MIN_RANGES
    while ranges * RANGE_BYTES < size:
        ranges *= 2
    store = written(docs.mapInArrow(
        tk.tidy(_blocks), f"block long, words long, ids array<{kind}>, sizes binary, vocabulary binary, numbers binary"), "blocks")
    words = store.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("n")).first().n
    asked = store.select("block", "sizes", "vocabulary", "numbers").mapInArrow(
        tk.tidy(_requests(order, ranges)), "block long, range long, hashes binary, counts binary")
    told = asked.groupBy("range").applyInArrow(_count, "block long, range long, totals binary")
    return (store.groupBy("block").cogroup(told.groupBy("block"))
            .applyInArrow(_score(order, words, min_count, alpha),
                          f"doc_id {kind}, n_words long, log_prob double, score double"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = backoff_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scores.select("doc_id", "n_words", F.round("log_prob", 6).alias("log_prob"), F.round("score", 6).alias("score"))


SQL = fr"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t),
p AS (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM w),
c AS (SELECT w, count(*) AS n FROM w GROUP BY w),
c2 AS (SELECT v, w, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY v, w),
s AS (
  SELECT p.doc_id, CASE WHEN p.v IS NULL THEN log10(c.n / t.n) WHEN c2.n >= {MIN_COUNT} THEN log10(c2.n / cv.n)
                        ELSE log10(c.n / t.n) + log10({ALPHA}) END AS s
  FROM p JOIN c ON c.w = p.w LEFT JOIN c cv ON cv.w = p.v LEFT JOIN c2 ON c2.v = p.v AND c2.w = p.w,
       (SELECT CAST(count(*) AS DOUBLE) AS n FROM w) t)
SELECT t.doc_id, CAST(len(t.ws) AS BIGINT) AS n_words, round(coalesce(sum(s.s), 0.0), 6) AS log_prob,
       round(sum(s.s) / len(t.ws), 6) AS score
FROM t LEFT JOIN s ON s.doc_id = t.doc_id GROUP BY t.doc_id, t.ws
"""
