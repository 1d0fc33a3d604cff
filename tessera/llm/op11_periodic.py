"""Maximal periodic runs of words by the branching-tandem test on enhanced suffix arrays.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, numbered from 0. A run is a stretch
with smallest period q (words q apart are equal) and at least ``max(MIN_LENGTH, 2 q)``
words that cannot be extended. Documents of a batch are sorted together, each with words
of its own (a word's key holds its document), so nothing is shared across documents:

1. suffix array by prefix doubling (only suffixes that still tie are sorted again); the
   ranks of each doubling give the LCP of neighbours by binary descent;
2. LCP intervals from previous and next smaller values, found by descent over range
   minima; a child is the stretch between two places of the interval's own depth d;
3. for every suffix i of all children but the largest of an interval of depth d:
   if ISA[i + d] lies in the interval but in another child, the words from i are a square
   of root length d that does not go on; likewise for ISA[i - d] and i - d. No tree nodes;
4. squares with the same end: the shortest root is rotated left as long as the words d
   apart are equal, which gives the run; longer roots inside it are its multiples.

Every run has one such square at its end, so none is missed. Words are compared by 64-bit
hashes; a found run is compared word by word, and a document where that fails is done
again with exact word numbers.

``rewritten`` makes part of a text periodic, by a rule on its id, as the query asks.

Rows: a null text is the empty text (no words, no runs); a null id keeps its text as it is
in ``rewritten``; repeated rows are rows of their own; other columns are ignored. Work
and memory of a row grow as n log n with its words.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import prepare

MIN_LENGTH = 12
STEPS = 64
EXACT_CASE = tk.byte_table(lambda b: b == 32 or 9 <= b <= 13, lower=False)


def suffix_ranks(key: np.ndarray) -> list[np.ndarray]:
    """Ranks of the prefixes of 1, 2, 4, ... words of all suffixes; the last are all
    different. ``key`` must not have equal values in two documents."""
    n = len(key)
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks, h = [rank], 1
    open_ = order[~(new & np.append(new[1:], True))]  # suffixes that tie, in rank order
    while len(open_):
        ahead = open_ + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        first = rank[open_]
        by = np.lexsort((second, first))
        open_, first, second = open_[by], first[by], second[by]
        group = np.concatenate([[True], first[1:] != first[:-1]])
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        at = np.arange(len(open_))
        start = np.maximum.accumulate(np.where(part, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[open_] = first + start
        ranks.append(rank)
        open_ = open_[~(part & np.append(part[1:], True))]
        h *= 2
    return ranks


def neighbour_lcp(sa: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """lcp[r]: common words of the suffixes of rank r - 1 and r (0 for r = 0)."""
    n = len(sa)
    lcp = np.zeros(n, np.int64)
    a, b, at = sa[:-1].copy(), sa[1:].copy(), np.arange(1, n)
    for level in range(len(ranks) - 1, -1, -1):
        rank = ranks[level]
        inside = (a < n) & (b < n)
        same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        a[same] += 1 << level
        b[same] += 1 << level
        lcp[at[same]] += 1 << level
    return lcp


def intervals(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place r in ``at``: the first and the last rank of the LCP interval of depth
    lcp[r] that r lies in."""
    n = len(lcp)
    minima = [lcp]
    while 1 << len(minima) < n:
        last, w = minima[-1], 1 << (len(minima) - 1)
        minima.append(np.minimum(last[:-w], last[w:]) if len(last) > w else last[:0])
    depth, lo, hi = lcp[at], at.copy(), at.copy()
    for level in range(len(minima) - 1, -1, -1):
        m, w = minima[level], 1 << level
        if not len(m):
            continue
        start = lo - w  # the w places before lo
        go = (start >= 0) & (m[np.clip(start, 0, len(m) - 1)] >= depth)
        lo[go] -= w
        start = hi + 1
        go = (start + w <= n) & (m[np.clip(start, 0, len(m) - 1)] >= depth)
        hi[go] += w
    return lo - 1, hi


def _ranges(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges lo, ..., lo + size - 1, one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(lo - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, root length) of all squares whose next word does not go on with them."""
    n = len(sa)
    at = np.flatnonzero(lcp)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo, hi = intervals(lcp, at)
    depth = lcp[at]
    order = np.lexsort((at, depth, lo))  # the places of an interval, one after the other
    at, lo, hi, depth = at[order], lo[order], hi[order], depth[order]
    first = np.concatenate([[True], (lo[1:] != lo[:-1]) | (depth[1:] != depth[:-1])])
    last = np.append(first[1:], True)
    # children: up to the first place, and from each place to before the next or to the end
    c_lo = np.concatenate([lo[first], at])
    c_hi = np.concatenate([at[first] - 1, np.where(last, hi, np.append(at[1:], 0) - 1)])
    of = np.concatenate([np.flatnonzero(first), np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))])
    size = c_hi - c_lo + 1
    by = np.lexsort((size, of))
    largest = np.zeros(len(of), bool)
    largest[by] = np.append(of[by][1:] != of[by][:-1], True)
    c_lo, c_hi, of, size = (x[~largest] for x in (c_lo, c_hi, of, size))
    starts, roots = [], []
    total = np.cumsum(size)
    cuts = np.searchsorted(total, np.arange(0, int(total[-1]) + (1 << 21), 1 << 21)) if len(total) else [0]
    cuts = np.unique(np.append(cuts, len(size)))
    for x, y in zip(cuts[:-1], cuts[1:]):  # some million suffixes at once
        some = np.repeat(np.arange(x, y), size[x:y])
        i = sa[_ranges(c_lo[x:y], size[x:y])]
        d, a, b = depth[of[some]], lo[of[some]], hi[of[some]]
        ca, cb = c_lo[some], c_hi[some]
        for j, start in ((i + d, i), (i - d, i - d)):
            inside = (j >= 0) & (j < n)
            r = isa[np.where(inside, j, 0)]
            hit = inside & (r >= a) & (r <= b) & ((r < ca) | (r > cb))
            starts.append(start[hit])
            roots.append(d[hit])
    return np.concatenate(starts), np.concatenate(roots)


def rotated(key: np.ndarray, start: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The places that squares reach by rotating them left word by word."""
    start = start.copy()
    live = np.arange(len(start))
    for _ in range(STEPS):
        live = live[start[live] > 0]
        live = live[key[start[live] - 1] == key[start[live] + root[live] - 1]]
        if not len(live):
            return start
        start[live] -= 1
    for d in np.unique(root[live]).tolist():  # long ones: the last place before that differs
        some = live[root[live] == d]
        differ = np.flatnonzero(key[:-d] != key[d:])
        at = np.searchsorted(differ, start[some])
        start[some] = np.where(at > 0, differ[np.maximum(at, 1) - 1] + 1 if len(differ) else 0, 0)
    return start


def runs_of(key: np.ndarray, shortest: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of the words ``key``, by start, then period."""
    if not len(key):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    ranks = suffix_ranks(key)
    isa = ranks[-1]
    sa = np.empty(len(key), np.int64)
    sa[isa] = np.arange(len(key))
    start, root = branching_squares(sa, isa, neighbour_lcp(sa, ranks))
    end = start + 2 * root
    order = np.lexsort((root, end))
    start, root, end = start[order], root[order], end[order]
    if len(start):
        new = np.concatenate([[True], (end[1:] != end[:-1]) | (root[1:] != root[:-1])])
        start, root, end = start[new], root[new], end[new]
    found = []
    while len(start):
        first = np.concatenate([[True], end[1:] != end[:-1]])
        low = rotated(key, start[first], root[first])
        found.append((low, end[first], root[first]))
        inside = start >= low[np.cumsum(first) - 1]  # the shortest root and its multiples
        start, root, end = start[~inside], root[~inside], end[~inside]
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    s, e, q = (np.concatenate(x) for x in zip(*found))
    long = e - s >= np.maximum(shortest, 2 * q)
    s, e, q = s[long], e[long], q[long]
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


def rewritten(doc_id, n: int) -> np.ndarray | None:
    """Numbers of the original words that a document's words become, None where they stay."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _same(words: list[bytes], s, e, q) -> bool:
    return all(words[a:b - p] == words[a + p:b] for a, b, p in zip(s.tolist(), e.tolist(), q.tolist()))


def document_runs(doc_ids: list, texts: pa.Array, rewrite: bool):
    """Yield (words, starts, ends, periods) for each row."""
    at = 0
    for first, w in tk.scan(texts, EXACT_CASE):
        counts = np.diff(w.bounds)
        number = np.arange(len(w.hash))
        if rewrite:
            for d, n in enumerate(counts.tolist()):
                new = rewritten(doc_ids[first + d], n)
                if new is not None:
                    number[w.bounds[d]:w.bounds[d + 1]] = w.bounds[d] + new
        key = tk.mix64(w.hash[number] ^ tk.mix64(w.doc().astype(np.uint64) + np.uint64(1)))
        s, e, q = runs_of(key)
        raw = w.raw.tobytes()
        cut = np.searchsorted(s, w.bounds)
        offs = w.bounds.tolist()
        for d, n in enumerate(counts.tolist()):
            a, b = offs[d], offs[d + 1]
            words = [raw[x:y] for x, y in zip(w.start[a:b].tolist(), w.end[a:b].tolist())]
            if rewrite and n:
                words = [words[i] for i in (number[a:b] - a).tolist()]
            rs, re, rq = (x[cut[d]:cut[d + 1]] for x in (s, e, q))
            rs, re = rs - a, re - a
            if not _same(words, rs, re, rq):  # two words with one hash
                seen: dict[bytes, int] = {}
                rs, re, rq = runs_of(np.array([seen.setdefault(x, len(seen)) for x in words], np.uint64))
            yield words, rs, re, rq
            at += 1


def kept_words(n: int, s, e, q) -> np.ndarray:
    """Words that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, s + q, 1)
    np.add.at(change, e, -1)
    return np.cumsum(change[:n]) == 0


def _rows(rewrite: bool):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = []
            for words, s, e, q in document_runs(ids, batch.column(1), rewrite):
                said = "".join(f"{a},{b - a},{p}\n" for a, b, p in zip(s.tolist(), e.tolist(), q.tolist()))
                top = (None,) * 4
                if len(s):
                    i = int(np.lexsort((q, s, s - e))[0])
                    length, period = int(e[i] - s[i]), int(q[i])
                    top = (int(s[i]), length, period, 1000 * length // period)
                    keep = kept_words(len(words), s, e, q)
                    words = [x for x, k in zip(words, keep.tolist()) if k]
                out.append((len(s), *top, len(words), [*zip(s.tolist(), (e - s).tolist(), q.tolist())],
                            hashlib.sha256(said.encode()).hexdigest(), b" ".join(words)))
            n, start, length, period, milli, kept, runs, digest, text = zip(*out) if out else ((),) * 9
            long = [pa.array(x, pa.int64()) for x in (n, start, length, period, milli, kept)]
            runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs], RUNS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *long, runs, pa.array(digest, pa.string()),
                 pa.array([t.decode("utf-8", "replace") for t in text], pa.string())], names=NAMES)
    return run


RUNS = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "n_kept", "runs", "runs_sha256", "collapsed"]


def periodic_runs(docs: DataFrame, rewrite: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli of the longest run, n_kept,
    runs, runs_sha256, collapsed text) for every row; no shuffle."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(tk.tidy(_rows(rewrite)), f"doc_id {kind}, n_runs long, start long, length long, period long, "
                           "exponent_milli long, n_kept long, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                           "runs_sha256 string, collapsed string")


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), rewrite=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
