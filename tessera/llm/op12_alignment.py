"""Alignment of two tokenizers' tokens by interval coalescing, with corpus-wide link counts.

A encodes a space and the text with a byte-level BPE file, B the text with a piece model
that adds the space itself; both cover the same bytes. The tokens of both sides are
intervals of byte offsets: all are sorted by start together, the running maximum of their
ends is taken, and a group breaks where a start reaches it, so a group ends where tokens
of both sides end. Within a group every A token links with every B token.

Texts are cut at single spaces between visible characters, where both encoders always
start a new token, so the chunks are aligned one by one, each distinct chunk once per
worker (the piece model is checked for pieces that cross a space, and then texts stay
whole). A text where the bytes of either side differ from space and text has no tokens.

Jobs: (1) per document the figures, the digest of its groups and its distinct id pairs
with their number of links, a written table in blocks (one Arrow batch each); (2) an id
pair's count, the documents that hold it, by one aggregation of the exploded pairs, and
each A id's highest count; (3) the distinct pairs of every block joined with the counts
and brought back to the block, where documents add up theirs. What is shuffled are pairs
of documents (with map-side aggregation), pairs of blocks, and the documents' pair lists;
no group grows with the corpus.

Rows: null and empty texts have no tokens (zeros, empty digest); ids may be null or
repeat, every row is a document of its own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import prepare, written

#: a single space between visible characters
CUT = re.compile(r"(?<=[^\s᠎]) (?=[^\s᠎])")
CACHE_CHUNKS, CACHE_BYTES = 400_000, 40 << 20
TOGETHER = 4096
PART_CHARACTERS = 1 << 20


def byte_letters() -> dict[str, int]:
    """The byte of each character of the byte-level alphabet."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def coalesced(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray):
    """(group of each A token, group of each B token) of tokens in ascending order; groups
    are numbered from 0 in order of place."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    side = np.repeat([0, 1], [len(a_start), len(b_start)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group[:len(a_start)], group[len(a_start):]


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _spread(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges lo, ..., lo + size - 1, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(lo - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class Aligner:
    """Aligned chunks of texts, each distinct one worked out once."""

    def __init__(self, a_spec: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        added = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [b""] * (1 + max(self.a.get_vocab(with_added_tokens=True).values()))
        for piece, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = added[i] if i in added else bytes(letters[c] for c in piece)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.whole = any(re.search("[^▁]▁", p) for p in pieces)
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.bytes = 0
        self.digest: list[str] = []
        self.fits = np.zeros(0, bool)
        self.counts = np.zeros((4, 0), np.int64)  # A tokens, B tokens, groups, links of a chunk
        self.at = np.zeros(1, np.int64)  # where a chunk's pairs start
        self.pairs = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)

    def chunks(self, text: str) -> list[str]:
        return [text] if self.whole else CUT.split(text)

    @staticmethod
    def _covers(ids: list[list[int]], tokens: list[bytes], said: list[bytes]) -> np.ndarray:
        """Whether each chunk's tokens make up its bytes."""
        parts = [[tokens[i] for i in x] for x in ids]
        sizes = [sum(map(len, p)) for p in parts]
        if sizes == [len(x) for x in said] and b"".join(itertools.chain.from_iterable(parts)) == b"".join(said):
            return np.ones(len(ids), bool)
        return np.array([b"".join(p) == x for p, x in zip(parts, said)], bool)

    def _learn(self, new: list[str]):
        a_ids = [e.ids for e in self.a.encode_batch_fast([" " + c for c in new], add_special_tokens=False)]
        b_ids = self.b.encode(new, num_threads=1)
        said = [b" " + c.encode() for c in new]
        fits = self._covers(a_ids, self.a_bytes, said) & self._covers(b_ids, self.b_bytes, said)
        if not fits.all():
            a_ids = [x if ok else [] for x, ok in zip(a_ids, fits.tolist())]
            b_ids = [x if ok else [] for x, ok in zip(b_ids, fits.tolist())]
        na, nb = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = (np.array(list(itertools.chain.from_iterable(ids)), np.int64) for ids in (a_ids, b_ids))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ga, gb = coalesced(a_end - self.a_size[a], a_end, b_end - self.b_size[b], b_end)
        n = int(max(ga.max(initial=-1), gb.max(initial=-1))) + 1
        pa_, pb_ = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
        first = _offsets(pa_)[:-1]
        chunk = np.repeat(np.arange(len(new)), na)[first] if n else np.zeros(0, np.int64)
        groups = np.bincount(chunk, minlength=len(new))
        links = np.bincount(chunk, pa_ * pb_, len(new)).astype(np.int64)
        # distinct ids of a group with their number, then the pairs of the two sides
        ua, ca = np.unique(ga << 32 | a, return_counts=True)
        ub, cb = np.unique(gb << 32 | b, return_counts=True)
        da, db = np.bincount(ua >> 32, minlength=n), np.bincount(ub >> 32, minlength=n)
        left = np.repeat(np.arange(len(ua)), db[ua >> 32])
        right = _spread(_offsets(db)[:-1][ua >> 32], db[ua >> 32])
        pair = (ua[left] & 0xFFFFFFFF) << 32 | (ub[right] & 0xFFFFFFFF)
        of = chunk[ua[left] >> 32]
        said_a, said_b = [str(i) for i in a.tolist()], [str(i) for i in b.tolist()]
        oa, ob = _offsets(pa_).tolist(), _offsets(pb_).tolist()
        said = [",".join(said_a[oa[g]:oa[g + 1]]) + "|" + ",".join(said_b[ob[g]:ob[g + 1]]) for g in range(n)]
        og = _offsets(groups).tolist()
        self.digest += [";".join(said[x:y]) for x, y in zip(og[:-1], og[1:])]
        self.fits = np.append(self.fits, fits)
        self.counts = np.concatenate([self.counts, [na, nb, groups, links]], axis=1)
        self.at = np.concatenate([self.at, len(self.pairs) + np.cumsum(np.bincount(of, minlength=len(new)))])
        self.pairs = np.concatenate([self.pairs, pair])
        self.links = np.concatenate([self.links, ca[left] * cb[right]])
        self.bytes += sum(len(c) for c in new) + 16 * len(pair)

    def texts(self, texts: list[str | None]):
        """(counts [4, n], digests, pair bounds, pairs, links) of the texts of a batch."""
        if len(self.known) > CACHE_CHUNKS or self.bytes > CACHE_BYTES:
            self.clear()
        parts, new, add = [], [], len(self.known)
        for t in texts:
            cut = self.chunks(t) if t else []
            row = list(map(self.known.get, cut))
            if None in row:
                for i, c in enumerate(cut):
                    if row[i] is None:
                        row[i] = self.known.setdefault(c, add + len(new))
                        if row[i] == add + len(new):
                            new.append(c)
            parts.append(np.array(row, np.int64))
        for at in range(0, len(new), TOGETHER):
            self._learn(new[at:at + TOGETHER])
        size = np.array([len(p) if len(p) and self.fits[p].all() else 0 for p in parts], np.int64)
        parts = [p[:n] for p, n in zip(parts, size.tolist())]
        flat = np.concatenate([*parts, np.zeros(0, np.int64)])
        doc = np.repeat(np.arange(len(texts)), size)
        counts = np.zeros((4, len(texts)), np.int64)
        for i in range(4):
            np.add.at(counts[i], doc, self.counts[i][flat])
        said = [hashlib.sha256(";".join([self.digest[i] for i in p.tolist()]).encode()).hexdigest() if len(p) else ""
                for p in parts]
        one, times = np.unique(doc << 32 | flat, return_counts=True)
        doc, flat = one >> 32, one & 0xFFFFFFFF
        many = self.at[flat + 1] - self.at[flat]
        at = _spread(self.at[flat], many)
        doc, pair, links = np.repeat(doc, many), self.pairs[at], self.links[at] * np.repeat(times, many)
        order = np.lexsort((pair, doc))
        doc, pair, links = doc[order], pair[order], links[order]
        first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])])) if len(doc) else doc
        links = np.add.reduceat(links, first) if len(first) else links
        bounds = np.searchsorted(doc[first], np.arange(len(texts) + 1))
        return counts, said, bounds, pair[first], links


_ALIGNERS: dict[str, Aligner] = {}


def aligner_of(job: dict) -> Aligner:
    """The worker's aligner of a pair of files: its cache outlives the task, for more
    of this operator's tasks."""
    key = hashlib.blake2b(job["a"].encode() + job["b"]).hexdigest()
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(job["a"], job["b"])
        tk.keep("op12", _ALIGNERS)
    return _ALIGNERS[key]


def _align(job):
    def run(batches):
        aligner = aligner_of(job.value)
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            long = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            cuts = np.unique(np.append(np.searchsorted(long, np.arange(0, int(long[-1]) if len(long) else 0, PART_CHARACTERS)),
                                       batch.num_rows))
            for lo, hi in zip(np.append(0, cuts[cuts > 0][:-1]).tolist(), cuts[cuts > 0].tolist()):
                part = batch.slice(lo, hi - lo)
                counts, said, bounds, pairs, links = aligner.texts(part.column(1).to_pylist())
                offsets = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(part.num_rows, task << 32 | number)), part.column(0), *(pa.array(c) for c in counts),
                     pa.array(said, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(pairs, pa.int64())),
                     pa.ListArray.from_arrays(offsets, pa.array(links, pa.int64()))],
                    names=["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])
    return run


def _add_up(docs: pa.Table, counts: pa.Table) -> pa.Table:
    pair = counts["pair"].to_numpy()
    order = np.argsort(pair, kind="stable")
    pair, n, top = pair[order], counts["n"].to_numpy()[order], counts["best"].to_numpy(zero_copy_only=False)[order]
    held, links = docs["pairs"].combine_chunks(), docs["links"].combine_chunks().flatten().to_numpy()
    bounds = np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy())])
    at = np.searchsorted(pair, held.flatten().to_numpy())
    doc = np.repeat(np.arange(len(docs)), np.diff(bounds))
    best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    np.add.at(best, doc, links * top[at])
    np.add.at(total, doc, links * n[at])
    return pa.table([docs["doc_id"], docs["n_a"], docs["n_b"], docs["n_groups"], docs["n_links"], pa.array(best),
                     pa.array(total), docs["groups_sha256"]],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def tokens_linked(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, counts): a written table with each document's block, figures, digest and
    id pairs, and (pair, a, b, n, best) for every id pair of the corpus."""
    import public_tokenizers

    spark = docs.sparkSession
    prepare(spark)
    with open(a_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        a_spec = f.read()
    with open(b_path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        b_model = f.read()
    job = spark.sparkContext.broadcast({"a": a_spec, "b": b_model})
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = written(docs.mapInArrow(tk.tidy(_align(job), "op12"), f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, "
                                    "n_links long, groups_sha256 string, pairs array<long>, links array<long>"), "links")
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts.withColumn("a", F.shiftright("pair", 32).cast("int")), "counts")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))  # at most one row an id of A's vocabulary
    counts = counts.join(F.broadcast(top), "a").select(
        "pair", "a", F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "n", (F.col("n") == F.col("top")).alias("best"))
    return found, counts


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row."""
    found, counts = tokens_linked(docs, a_path, b_path, id_col, text_col)
    kind = found.schema["doc_id"].dataType.simpleString()
    asked = found.select(F.col("block").alias("of"), F.explode("pairs").alias("pair")).distinct()
    told = asked.join(counts.select("pair", "n", "best"), "pair").select("of", "pair", "n", "best")
    return found.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(
        _add_up, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
