"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The likelihood of a word is the sum over all of its segmentations into pieces
(forward algorithm), that of a text the product over its words; the language
with the largest likelihood wins, ``score`` is its posterior under equal priors.

A word is a maximal run of ASCII letters and non-ASCII characters, lower-cased
(characters of one or two bytes), with a word-start mark before it. Runs and pieces may
have any length: runs longer than ``WINDOW`` bytes go through the forward algorithm window
by window, the last values of one carried over to the next and scaled, so segmentations
across a border are summed as well. Every byte is a piece of its own besides, so each word
has a segmentation.

Piece probabilities are learned by expectation-maximisation over the table of
(language, word, count) of all training rows; only sums per language and piece
(at most languages x vocabulary numbers) reach the driver.

Rows: a null text, or one without a letter, is ``und`` with score 0; so is every
text if nothing could be learned. Equal likelihoods go to the first language by
name. Rows with a null language do not train; a null id counts as held out of
training (its checksum is null) and ``held_out`` is false. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import written

WINDOW = 48  # bytes between scalings: FLOOR ** WINDOW is above the smallest double
CELLS = 1 << 18
FLOOR = 1e-6
ROUNDS = 2
CACHE_WORDS, CACHE_STEP = 600_000, 1 << 17
MARK = 1
_VALUE = tk.byte_table(lambda b: False, lower=False, seed=77)


def vocabulary(path: str | None = None) -> list[bytes]:
    """Pieces of the public vocabulary that can occur in a word: letters, lower
    case, with the word-start mark where they have it; then every byte."""
    import sentencepiece

    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        body = piece[1:] if piece.startswith("▁") else piece
        raw = (bytes([MARK]) if body is not piece and len(body) < len(piece) else b"") + body.encode()
        if body.isalpha() and body == body.lower() and len(raw) > 1:
            found[raw] = None
    return [*found, *(bytes([b]) for b in range(256))]


class Pieces:
    """Piece ids of substrings: hash lookup in two direct-address tables."""

    BITS = 20

    def __init__(self, pieces: list[bytes]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces))
        p, _ = tk.powers(self.longest)
        raw = np.array([int(np.add.reduce(_VALUE[list(x)] * p[:len(x)], dtype=np.uint64)) for x in pieces], np.uint64)
        self.hash = np.append(tk.mix64(raw), np.uint64(0))
        ids = np.arange(self.size, dtype=np.int32)
        self.one = np.full(1 << self.BITS, self.size, np.int32)
        self.two = self.one.copy()
        a, b = self._slots(self.hash[:-1])
        self.one[a] = ids
        left = np.flatnonzero(self.one[a] != ids)
        self.two[b[left]] = ids[left]
        if (self.two[b[left]] != ids[left]).any() or len(np.unique(self.hash)) <= self.size:
            raise ValueError("piece hashes collide")

    def _slots(self, h):
        return (h >> np.uint64(64 - self.BITS)).astype(np.int64), (h & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        a, b = self._slots(h)
        x = self.one[a]
        y = self.two[b]
        return np.where(self.hash[x] == h, x, np.where(self.hash[y] == h, y, self.size))

    def of(self, m: np.ndarray) -> list[np.ndarray]:
        """Ids of all substrings of the rows: entry l-1 has them by start, for length l."""
        n, w = m.shape
        p, q = tk.powers(w + 1)
        run = np.zeros((n, w + 1), np.uint64)
        np.cumsum(_VALUE[m] * p[:w], axis=1, out=run[:, 1:])
        return [self.find(tk.mix64((run[:, k:] - run[:, :-k]) * q[:w + 1 - k])) for k in range(1, min(self.longest, w) + 1)]


def _rows(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Words as byte matrices with the word-start mark: yields (word numbers, matrix,
    lengths). Words beyond WINDOW bytes come with others of the same length only."""
    size = end - start
    order = np.argsort(size, kind="stable")
    sizes = size[order]
    at = 0
    while at < len(order):
        w = int(sizes[at])
        if w <= WINDOW:
            stop = min(at + 8192, int(np.searchsorted(sizes, WINDOW, side="right")))
        else:
            stop = min(at + max(1, CELLS // w), int(np.searchsorted(sizes, w, side="right")))
        pick = order[at:stop]
        w = int(sizes[stop - 1])
        col = np.arange(w)
        m = np.zeros((len(pick), w + 1), np.uint8)
        m[:, 0] = MARK
        inside = col < size[pick][:, None]
        m[:, 1:][inside] = data[(start[pick][:, None] + col)[inside]]
        yield pick, m, size[pick] + 1
        at = stop


def forward_long(pieces: Pieces, look, m: np.ndarray, shape: tuple, keep: bool = False):
    """Log probability of rows of one length, window by window; with ``keep`` that of
    each prefix (entry j: the first j bytes). ``look`` gives the probabilities of piece ids."""
    n, w = m.shape
    k_most, scale, lo = pieces.longest, np.zeros(shape), 0
    carry = np.ones((1, *shape))  # positions lo ... b
    found = [np.zeros((1, *shape))]
    for b in range(0, w, WINDOW):
        e = min(b + WINDOW, w)
        ids = pieces.of(m[:, lo:e])
        now = np.zeros((e - lo + 1, *shape))
        now[:b - lo + 1] = carry
        for j in range(b - lo + 1, e - lo + 1):
            for k in range(1, min(k_most, j) + 1):
                now[j] += now[j - k] * look(ids[k - 1][:, j - k])
        if keep:
            found.append(np.log(now[b - lo + 1:]) + scale)
        new = max(0, e - k_most)
        carry = now[new - lo:]
        top = carry.max(axis=0)
        carry, scale, lo = carry / top, scale + np.log(top), new
    return np.concatenate(found) if keep else np.log(carry[-1]) + scale


def masses_long(pieces: Pieces, look, m: np.ndarray):
    """Yield (piece ids, posterior mass) for rows of one length, one language each."""
    n, w = m.shape
    k_most = pieces.longest
    before = forward_long(pieces, look, m, (n,), keep=True)
    carry, scale = np.ones((1, n)), np.zeros(n)  # positions e ... hi
    for b in reversed(range(0, w, WINDOW)):
        e = min(b + WINDOW, w)
        hi = min(w, e + k_most)
        ids = pieces.of(m[:, b:hi])
        now = np.zeros((hi - b + 1, n))
        now[e - b:] = carry[:hi - e + 1]
        for j in reversed(range(e - b)):
            for k in range(1, min(len(ids), hi - b - j) + 1):
                now[j] += look(ids[k - 1][:, j]) * now[j + k]
        ahead = before[b:e] - before[-1] + scale
        for k, x in enumerate(ids, 1):
            c = min(e - b, hi - b - k + 1)
            with np.errstate(divide="ignore"):
                mass = np.log(look(x[:, :c]).T * now[k:k + c])
            yield x[:, :c], np.exp(ahead[:c] + mass).T
        carry = now[:k_most + 1]
        top = carry.max(axis=0)
        carry, scale = carry / top, scale + np.log(top)


def forward(ids: list[np.ndarray], prob: np.ndarray, w: int) -> np.ndarray:
    """alpha[j]: probability, per row and language, of the first j bytes."""
    n = len(ids[0])
    alpha = np.zeros((w + 1, n, prob.shape[1]))
    alpha[0] = 1
    for j in range(1, w + 1):
        for k in range(1, min(len(ids), j) + 1):
            alpha[j] += alpha[j - k] * prob[ids[k - 1][:, j - k]]
    return alpha


def word_scores(pieces: Pieces, prob: np.ndarray, data, start, end) -> np.ndarray:
    """Log likelihood of each word in each language."""
    out = np.zeros((len(start), prob.shape[1]))
    for word, m, size in _rows(data, start, end):
        if m.shape[1] > WINDOW + 1:
            out[word] = forward_long(pieces, lambda x: prob[x], m, (len(word), prob.shape[1]))
        else:
            alpha = forward(pieces.of(m), prob, m.shape[1])
            out[word] = np.log(alpha[size, np.arange(len(size))])
    return out


def expected_counts(pieces: Pieces, prob: np.ndarray, lang: np.ndarray, weight: np.ndarray, data, start, end):
    """Expected piece counts per language (flat: language * (pieces + 1) + piece)."""
    k1 = pieces.size + 1
    total = np.zeros(prob.shape[1] * k1)
    flat = prob.T.reshape(-1)
    for word, m, size in _rows(data, start, end):
        if m.shape[1] > WINDOW + 1:
            own, many = lang[word] * k1, weight[word]
            look = lambda x: flat[x + (own if x.ndim == 1 else own[:, None])]
            for x, mass in masses_long(pieces, look, m):
                total += np.bincount((x + own[:, None]).ravel(), (mass * many[:, None]).ravel(), minlength=len(total))
            continue
        ids = [x + lang[word][:, None] * k1 for x in pieces.of(m)]
        n, w = m.shape
        alpha = np.zeros((w + 1, n))
        beta = np.zeros((w + 1, n))
        alpha[0] = 1
        own = [flat[x] for x in ids]
        for j in range(1, w + 1):
            for k in range(1, min(len(ids), j) + 1):
                alpha[j] += alpha[j - k] * own[k - 1][:, j - k]
        beta[size, np.arange(n)] = 1
        for j in range(w - 1, -1, -1):
            for k in range(1, min(len(ids), w - j) + 1):
                beta[j] += own[k - 1][:, j] * beta[j + k]
        scale = weight[word] / alpha[size, np.arange(n)]
        for k, x in enumerate(ids, 1):
            mass = alpha[:w + 1 - k].T * own[k - 1] * beta[k:].T * scale[:, None]
            total += np.bincount(x.ravel(), mass.ravel(), minlength=len(total))
    return total


def _word_counts(batches):
    for batch in batches:
        lang = batch.column(0).dictionary_encode()
        names, code = lang.dictionary, lang.indices.to_numpy(zero_copy_only=False)
        for first, words in tk.scan(batch.column(1), tk.LETTERS, fold=True):
            of = code[first:first + len(words.bounds) - 1][words.doc()]
            key = tk.mix64(words.hash ^ tk.mix64(of.astype(np.uint64) + np.uint64(1)))
            _, at, n = np.unique(key, return_index=True, return_counts=True)
            raw = words.data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(of[at])),
                 pa.array([raw[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())], pa.binary()),
                 pa.array(n, pa.int64())], names=["lang", "word", "n"])


def _expect(model):
    def run(batches):
        pieces, langs, prob = Pieces(model.value[0]), model.value[1], model.value[2]
        index = {x: i for i, x in enumerate(langs)}
        total = np.zeros(len(langs) * (pieces.size + 1))
        for batch in batches:
            code = np.array([index[x] for x in batch.column(0).to_pylist()], np.int64)
            if not len(code):
                continue
            words = batch.column(1).cast(pa.large_binary())
            _, off, data = words.buffers()
            offs = np.frombuffer(off, np.int64)[words.offset:words.offset + len(words) + 1]
            data = np.frombuffer(data, np.uint8)
            total += expected_counts(pieces, prob, code, batch.column(2).to_numpy().astype(float), data, offs[:-1], offs[1:])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["slot", "mass"])
    return run


def learn(rows: DataFrame, pieces: list[bytes], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, probability of each piece and language) from (lang, text) rows."""
    sc = rows.sparkSession.sparkContext
    counts = rows.where("lang is not null").select("lang", "text").mapInArrow(
        tk.tidy(_word_counts), "lang string, word binary, n long")
    counts = written(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    k = len(pieces)
    prob = np.full((k + 1, len(langs)), 1.0 / k)
    prob[k] = 0
    table = counts
    for _ in range(rounds if langs else 0):
        mass = table.mapInArrow(tk.tidy(_expect(sc.broadcast((pieces, langs, prob)))), "slot long, mass double")
        got = mass.groupBy("slot").agg(F.sum("mass").alias("mass")).collect()  # languages x pieces at most
        flat = np.zeros(len(langs) * (k + 1))
        flat[[r.slot for r in got]] = [r.mass for r in got]
        c = flat.reshape(len(langs), k + 1).T[:k] + 0.1
        prob = np.vstack([np.maximum(c / c.sum(axis=0), FLOOR), np.zeros(len(langs))])
    return langs, prob


def _predict(model):
    def run(batches):
        pieces, langs, prob = Pieces(model.value[0]), model.value[1], model.value[2]
        names = pa.array([*langs, "und"], pa.string())
        known, cached = np.zeros(0, np.uint64), np.zeros((0, len(langs)))
        fresh, fresh_score = known, cached
        for batch in batches:
            total = np.zeros((batch.num_rows, len(langs)))
            letters = np.zeros(batch.num_rows, bool)
            text = batch.column(2)
            for first, words in tk.scan(text, tk.LETTERS, fold=True):
                n = len(words.bounds) - 1
                seen = np.concatenate([[0], np.cumsum((words.data >= 97) & (words.data <= 122))])
                offs = _segment_offsets(text, first, n)
                letters[first:first + n] = seen[offs[1:]] > seen[offs[:-1]]
                if not len(words.hash) or not langs:
                    continue
                u, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
                pos = np.searchsorted(known, u)
                have = np.zeros(len(u), bool)
                inside = pos < len(known)
                have[inside] = known[pos[inside]] == u[inside]
                score = np.empty((len(u), len(langs)))
                score[have] = cached[pos[have]]
                new = ~have
                score[new] = word_scores(pieces, prob, words.data, words.start[at[new]], words.end[at[new]])
                fresh, fresh_score = np.concatenate([fresh, u[new]]), np.concatenate([fresh_score, score[new]])
                if 4 * len(fresh) > len(known) + CACHE_STEP:  # merged when a quarter is new: each row moves few times
                    if len(known) > CACHE_WORDS:
                        known, cached = known[:0], cached[:0]
                    known, cached = np.concatenate([known, fresh]), np.concatenate([cached, fresh_score])
                    known, at_ = np.unique(known, return_index=True)
                    cached, fresh, fresh_score = cached[at_], fresh[:0], fresh_score[:0]
                total[first:first + n] = tk.sums(score[back], words.bounds)
            for i in np.flatnonzero(~letters):
                letters[i] = any(c.isalpha() for c in (text[int(i)].as_py() or ""))
            if langs:
                best = total.argmax(axis=1)
                top = total.max(axis=1)
                score = 1 / np.exp(total - top[:, None]).sum(axis=1)
            else:
                best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            und = ~letters | (len(langs) == 0)
            best = np.where(und, len(langs), best)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), names.take(pa.array(best, pa.int64())),
                 pa.array(np.where(und, 0.0, score))], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def _segment_offsets(arr, first: int, n: int) -> np.ndarray:
    _, offs = tk.text_buffers(arr.slice(first, n))
    return offs


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; learns from the rows
    whose checksum of the id is not 2 modulo 4 and whose language is not null."""
    spark = docs.sparkSession
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4))
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
                       (fold != 2).alias("trains"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    pieces = vocabulary(vocabulary_path)
    langs, prob = learn(docs.where("trains"), pieces)
    model = spark.sparkContext.broadcast((pieces, langs, prob))
    rows = docs.select("doc_id", "held_out", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tk.tidy(_predict(model)), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a letter, or for which no learned language
    has at least half of the posterior, go. Learns from the rows of ``docs``."""
    names = docs.columns
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    pieces = vocabulary()
    langs, prob = learn(docs.where(fold != 2).select("lang", "text"), pieces)
    model = spark.sparkContext.broadcast((pieces, langs, prob))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at = names.index("text")

    def keep(batches):
        waiting = []  # the batch that is with the predictor, which lives as long as the task

        def probes():
            for batch in batches:
                waiting.append(batch)
                yield pa.RecordBatch.from_arrays([batch.column(at)] * 3, names=["doc_id", "held_out", "text"])

        for said in _predict(model)(probes()):
            good = (said.column(3).to_numpy() >= 0.5) & (said.column(2).to_numpy(zero_copy_only=False) != "und")
            yield waiting.pop().filter(pa.array(good))

    return docs.mapInArrow(tk.tidy(keep), types)
