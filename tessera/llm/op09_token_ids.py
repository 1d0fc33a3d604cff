"""Token ids in binary shards with a shared zstandard dictionary.

Every whole text is encoded with a public byte-level BPE file of the
``tokenizers`` library and ends with an end id. Documents are range-partitioned
and sorted by id; each partition writes one shard into the shared folder:

    magic 8 bytes | id width u32 | documents u32 | dictionary hash 16 bytes
    one zstandard frame per document (ids little-endian, dictionary-compressed)
    index: doc_id i64, null u8, offset u64, bytes u32, tokens u32 per document
    index offset u64 | magic

so a reader fetches one short document with the footer, the index and one frame.
The dictionary (hash: BLAKE2b-128) is trained on the serialized ids of at most
``SAMPLE_ROWS`` non-empty texts of at most ``SAMPLE_BYTES`` bytes, those with the
smallest hash of id and text among the rows below a hash threshold that leaves about
twice as many, so no task meets more of them than that at any size of the table; with
too little to train on, frames go without dictionary.
All other numbers cover all rows.

The encoder splits a text where the byte-level pattern always starts a new piece:
before a single space between visible characters, around a single line break
between them, and between an ASCII letter and ASCII punctuation other than an
apostrophe. Strings of the file's added tokens are split off first, as the library
does: each is a chunk of its own (a text with an added token that strips its
neighbours, asks for whole words or sees normalised text is one chunk as a whole).
So encoding the chunks one by one gives the ids of the whole; each
distinct chunk is encoded once per worker (128 bits of hash decide equality).
Plain chunks are encoded many at a time with line breaks between them.

A shard is written under a name of its own and then moved, so a repeated task
leaves the same file. Rows: null text is the empty text (only the end id); null
ids come first; rows of equal id are ordered by a hash of their text (null texts first),
and may go to several shards, equal rows too; other columns are ignored.
Ids must be integers.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import work_folder, written

MAGIC = b"TOKIDS01"
END_ID = 2
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 16384, 64 << 10
SHARD_ROWS = 8192
CACHE_CHUNKS = 1_500_000
TOGETHER = 2048
_ANY = [tk.byte_table(lambda b: False, lower=False, seed=s) for s in (101, 202)]
_KIND = np.zeros(256, np.uint8)  # 1 visible, 2 letter, 3 punctuation other than the apostrophe
_KIND[0x21:0x7F] = 3
_KIND[[0x27, *range(0x30, 0x3A)]] = 1
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 2
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("bytes", "<u4"), ("tokens", "<u4")])


def open_store(path: str):
    """(file system, path) of a shared-folder location."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class Encoder:
    """Ids of the documents of a text column, chunk by chunk with a cache."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        added = self.tokenizer.get_added_tokens_decoder().values()
        odd = [t for t in added if t.lstrip or t.rstrip or t.single_word or t.normalized]
        self.odd = {t.content for t in odd}
        self.added = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(
            (t.content for t in added if t.content), key=len, reverse=True))) if added else None
        self.apart = bool(odd) or any("\n" in t.content for t in added)  # no encoding of many chunks together
        self.type = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        (self.line,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.clear()

    def clear(self):
        self.known = np.zeros((2, 0), np.uint64)
        self.at = np.zeros((2, 0), np.int32)
        self.pool = np.zeros(0, self.type)

    def chunks(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Start positions of the chunks of a segment."""
        n = len(data)
        kind = _KIND[data]
        seen = kind >= 1
        before = seen.copy()
        before[1:] |= (data[1:] >= 0x80) & (data[:-1] == 0xC3)
        after = seen | (data == 0xC3)
        cut = np.zeros(n, bool)
        alone = before[:-2] & after[2:]
        cut[1:-1] = ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) & alone
        cut[2:] |= (data[1:-1] == 0x0A) & alone
        cut[1:] |= kind[1:] + kind[:-1] == 5  # a letter (2) beside punctuation (3)
        raw = data.tobytes() if self.added else b""
        if self.added and self.added.search(raw):
            for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                found = list(self.added.finditer(raw, a, b))
                if any(m.group().decode() in self.odd for m in found):
                    cut[a:b] = False
                    continue
                for m in found:
                    cut[m.start():m.end()] = False
                    cut[m.start()] = True
                    cut[m.end():m.end() + 1] = True
        cut[offs[:-1][offs[:-1] < n]] = True
        return np.flatnonzero(cut)

    def _new(self, raw: bytes, start, end) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after the other, number of ids of each)."""
        texts = [raw[a:b].decode() for a, b in zip(start.tolist(), end.tolist())]
        data = np.frombuffer(raw, np.uint8)
        # controls, and first bytes of all characters that hold white space beyond ASCII
        odd = (data < 0x20) | (data == 0x7F) | (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))
        odd = np.concatenate([[0], np.cumsum(odd)])
        spaces = np.concatenate([[0], np.cumsum(data == 0x20)])
        lead = data[start] == 0x20
        plain = (odd[end] == odd[start]) & (spaces[end] - spaces[start] == lead) & (end - start > lead) & (not self.apart)
        sizes = np.zeros(len(texts), np.int64)
        parts: list = [None] * len(texts)
        easy = np.flatnonzero(plain)
        joined = ["\n".join([texts[i] for i in easy[at:at + TOGETHER].tolist()] + [""])
                  for at in range(0, len(easy), TOGETHER)]
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        flat = np.concatenate([*ids, np.zeros(0, np.uint32)])
        stop = np.flatnonzero(flat == self.line)
        sizes[easy] = np.diff(np.concatenate([[-1], stop])) - 1
        kept = flat[flat != self.line]
        hard = np.flatnonzero(~plain)
        if not len(hard):
            return kept, sizes
        for i, e in zip(hard.tolist(), self.tokenizer.encode_batch_fast([texts[i] for i in hard.tolist()],
                                                                        add_special_tokens=False)):
            parts[i] = np.array(e.ids, np.uint32)
            sizes[i] = len(parts[i])
        for i, x in zip(easy.tolist(), np.split(kept, np.cumsum(sizes[easy])[:-1])):
            parts[i] = x
        return np.concatenate(parts), sizes

    def segment(self, data: np.ndarray, offs: np.ndarray):
        """(ids, bounds): ids of all documents of a segment and where each starts."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        start = self.chunks(data, offs)
        end = np.append(start[1:], n)
        p, q = tk.powers(n)
        h = []
        for table in _ANY:
            run = table[data] * p[:n]
            np.cumsum(run, out=run)
            h.append(tk.mix64((run[end - 1] - np.where(start > 0, run[start - 1], np.uint64(0))) * q[start]))
        u, first, back = np.unique(h[0], return_index=True, return_inverse=True)
        while (h[1] != h[1][first][back]).any():  # two chunks share 64 bits: use the other 64 too
            h[0] = tk.mix64(h[0] ^ (h[1] * tk.GRAM[3]))
            u, first, back = np.unique(h[0], return_index=True, return_inverse=True)
            self.clear()
        if self.known.shape[1] > CACHE_CHUNKS or len(self.pool) > 1 << 25:
            self.clear()
        pos = np.searchsorted(self.known[0], u)
        have = np.zeros(len(u), bool)
        inside = pos < self.known.shape[1]
        have[inside] = self.known[0][pos[inside]] == u[inside]
        if (self.known[1][pos[have]] != h[1][first][have]).any():
            self.clear()
            pos, have = np.zeros(len(u), np.int64), np.zeros(len(u), bool)
        new = ~have
        if new.any():
            got, size = self._new(data.tobytes(), start[first[new]], end[first[new]])
            lo = len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, got.astype(self.type)])
            self.known = np.insert(self.known, pos[new], np.array([u[new], h[1][first[new]]]), axis=1)
            self.at = np.insert(self.at, pos[new], np.array([lo, size], np.int32), axis=1)
            pos = np.searchsorted(self.known[0], u)
        lo, size = self.at[:, pos][:, back].astype(np.int64)
        ends = np.cumsum(size)
        ids = self.pool[np.repeat(lo - (ends - size), size) + np.arange(int(ends[-1]))]
        bounds = np.concatenate([[0], ends])[np.searchsorted(start, offs)]
        return ids, bounds

    def documents(self, arr: pa.Array, end_id: int):
        """Yield the ids of each document, end id included."""
        data, offs = tk.text_buffers(arr)
        tail = np.array([end_id], np.uint32)  # the ids become 32-bit with it
        for i, j in tk.segments(offs):
            ids, b = self.segment(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            for d in range(j - i):
                yield np.concatenate([ids[b[d]:b[d + 1]], tail])


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(spec: str) -> Encoder:
    """The worker's encoder of a tokenizer file: its cache outlives the task, for more of
    this operator's tasks."""
    key = hashlib.blake2b(spec.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
        tk.keep("op09", _ENCODERS)
    return _ENCODERS[key]


def _sample(job):
    def run(batches):
        encoder = encoder_of(job.value["spec"])
        for batch in batches:
            rows = [x.astype(job.value["type"]).tobytes() for x in encoder.documents(batch.column(0), job.value["end"])]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])
    return run


def train_dictionary(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _hash(dictionary: bytes) -> bytes:
    return hashlib.blake2b(dictionary, digest_size=16).digest()


def _write(job):
    def run(batches):
        import zstandard

        v = job.value
        shard = TaskContext.get().partitionId()
        store, folder = open_store(v["folder"])
        part, final = (f"{folder}/{x}" for x in (f"{uuid.uuid4().hex}.part", f"shard-{shard:07d}.tokids"))
        shape = zstandard.ZstdCompressionDict(v["dictionary"]) if v["dictionary"] else None
        pack = zstandard.ZstdCompressor(level=3, dict_data=shape)
        encoder, index, at = encoder_of(v["spec"]), [], 32
        out = store.open_output_stream(part)
        out.write(MAGIC + struct.pack("<II", v["type"].itemsize, 0) + _hash(v["dictionary"]))
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, x in zip(ids, encoder.documents(batch.column(1), v["end"])):
                frame = pack.compress(x.astype(v["type"]).tobytes())
                out.write(frame)
                index.append((doc_id or 0, doc_id is None, at, len(frame), len(x)))
                at += len(frame)
        table = np.array(index, INDEX)
        out.write(table.tobytes() + struct.pack("<QI", at, len(table)) + MAGIC)
        out.close()
        store.move(part, final)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([final], pa.string()), pa.array([len(table)], pa.int64()),
             pa.array([int(table["tokens"].sum(dtype=np.int64))], pa.int64())],
            names=["shard", "path", "docs", "tokens"])
    return run


class Shard:
    """Reader of one shard file: its index, and single documents by position."""

    def __init__(self, store, path: str, dictionary: bytes):
        import zstandard

        self.file = store.open_input_file(path)
        size = self.file.size()
        head = self._read(0, 32)
        tail = self._read(size - 20, 20)
        at, n = struct.unpack("<QI", tail[:12])
        width = struct.unpack("<I", head[8:12])[0]
        if head[:8] != MAGIC or tail[12:] != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        if head[16:32] != _hash(dictionary):
            raise ValueError(f"shard of another dictionary: {path}")
        self.index = np.frombuffer(self._read(at, n * INDEX.itemsize), INDEX)
        self.type = np.dtype(f"<u{width}")
        shape = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.unpack = zstandard.ZstdDecompressor(dict_data=shape)

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def document(self, i: int) -> np.ndarray:
        e = self.index[i]
        raw = self.unpack.decompress(self._read(int(e["offset"]), int(e["bytes"])))
        return np.frombuffer(raw, self.type).astype("<u4")


def _read_back(job):
    def run(batches):
        v = job.value
        store, _ = open_store(v["folder"])
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(store, path, v["dictionary"])
                tokens = shard.index["tokens"].astype(np.int64)
                start = base + np.cumsum(tokens) - tokens
                for lo in range(0, len(tokens), 8192):
                    some = slice(lo, min(lo + 8192, len(tokens)))
                    docs = [shard.document(i) for i in range(some.start, some.stop)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.index["doc_id"][some], pa.int64(), mask=shard.index["null"][some].astype(bool)),
                         pa.array(start[some]), pa.array([len(x) for x in docs], pa.int64()),
                         pa.array([zlib.crc32(x.tobytes()) for x in docs], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def write_shards(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text"):
    """Write all documents; returns (manifest table, job broadcast for readers)."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    sc = spark.sparkContext
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    kind = np.dtype("<u2" if max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = {"spec": spec, "type": kind, "end": end_id}
    fits = F.octet_length("text").between(1, SAMPLE_BYTES)
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(fits, 1)).alias("fit")).first()
    most = min((1 << 63) - 1, int(((1 << 64) * 2 * SAMPLE_ROWS) // max(1, size.fit)) - (1 << 63))
    sample = (docs.where(fits).select("text", F.xxhash64("doc_id", "text").alias("h")).where(F.col("h") <= most)
              .orderBy("h", "text").limit(SAMPLE_ROWS).select("text"))
    rows = sample.mapInArrow(tk.tidy(_sample(sc.broadcast(base)), "op09"), "ids binary").collect()  # bounded by the sample
    folder = work_folder(spark, "shards")
    store, at = open_store(folder)
    store.create_dir(at, recursive=True)
    dictionary = train_dictionary([bytes(r.ids) for r in rows])
    with store.open_output_stream(f"{at}/dictionary-{_hash(dictionary).hex()}.zdict") as f:
        f.write(dictionary)
    job = sc.broadcast(base | {"folder": folder, "dictionary": dictionary})
    n = max(2 * sc.defaultParallelism, -(-size.rows // SHARD_ROWS))
    order = ["doc_id", "some", "h", "nth"]
    keyed = docs.select("doc_id", "text", F.col("text").isNotNull().alias("some"), F.xxhash64("text").alias("h"),
                        F.monotonically_increasing_id().alias("nth"))
    ordered = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    manifest = written(ordered.mapInArrow(tk.tidy(_write(job), "op09"), "shard long, path string, docs long, tokens long"), "manifest")
    return manifest, job


def read_shards(manifest: DataFrame, job) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read from the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"), "shard")
    n = max(1, manifest.count())
    return (files.repartitionByRange(n, "shard").select("path", "base")
            .mapInArrow(tk.tidy(_read_back(job)), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_ids(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    return read_shards(*write_shards(docs, tokenizer_path, end_id))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents as token shards, read back. Rows that repeat an id or
    have none are encoded like all others, in the order that the module states."""
    return token_ids(docs)
