"""Byte-level BPE: training as Spark jobs, encoding and decoding with merges.

Training
  1. pre-tokens: ``regexp_extract_all`` with the byte-level pre-token pattern,
     exploded and counted (``groupBy(word).count()``: partial aggregation, so
     a very frequent word costs one partial row per task);
  2. each distinct word becomes a string with one character per id
     (``id_char``), so a merge is ``replace(word, pair, new)``: linear, left to
     right, without overlaps, in the JVM;
  3. a count of all adjacent pairs (one aggregation) lists the ``LISTED`` most
     frequent ones; the next one's count is the *floor* of the list. Merges never
     make a pair of old symbols more frequent, so what is not listed stays at or
     below the floor;
  4. per round the list gives as many pairs as are certain to be the next merges
     (``certain_merges``). Only words that hold one of them change, and only
     their pairs are counted, before and after: the difference, summed by pair,
     updates the list, and new pairs enter it with their whole count. When the
     best pair is no longer above the floor, all pairs are counted anew.

A round is one job. Each round's word table is computed in the job of the next one,
before the one before it is released, and is written to the checkpoint folder every
``checkpoint_every`` rounds, so a lost executor recomputes from there only. The
driver holds the list and the pairs with symbols made since it was read: at most
``LISTED`` plus two rows for each new symbol and each symbol, a matter of the
vocabulary and not of the corpus.

The merge table ``(rank, a, b, new_id, n, piece)`` has one row per merge and
is bounded by the vocabulary size; ``piece`` holds the new token's bytes as a
Latin-1 string.

Encoding with merges: the JVM splits special tokens off and pre-tokenizes
(``regexp_extract_all``); an Arrow batch function dictionary-encodes the
units of the batch, merges each distinct unit once by rank (a per-worker
cache keeps frequent ones) and gathers all ids in one vectorized pass. The
merge table travels with the function; its size is bounded by the
vocabulary.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType

from ..functions.bytes import byte_to_id_table
from ..options import FIRST_MERGE_ID, PRETOKEN_PATTERN, SPECIAL_TOKENS
from ..session import cut_lineage, ship_package, small_batches
from .tokens import BATCH_BYTES

MERGES_SCHEMA = "rank int, a int, b int, new_id int, n long, piece string"


# Java regex needs UNICODE_CHARACTER_CLASS for \s to mean Unicode white space
JAVA_PRETOKEN = "(?U)" + PRETOKEN_PATTERN


def pretokens(df: DataFrame, col: str = "text", out: str = "word", keep: list[str] | None = None) -> DataFrame:
    """One row per pre-token, in text order (``pos``)."""
    keep = keep or []
    return df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(col), F.lit(JAVA_PRETOKEN), F.lit(0)))
                     .alias("pos", out))


def units(col: str) -> Column:
    """Pre-tokens of a text with special-token strings as whole units (the
    specials are split off first, then each piece is pre-tokenized). No
    pre-token can equal a special string, so a unit is unambiguous."""
    from ..functions.bytes import special_regex
    c = F.col(col)
    rx = special_regex()
    plain = F.regexp_extract_all(c, F.lit(JAVA_PRETOKEN), F.lit(0))
    split = F.flatten(F.zip_with(
        F.split(c, rx, -1), F.regexp_extract_all(c, F.lit("(" + rx + ")"), F.lit(1)),
        lambda p, m: F.concat(F.regexp_extract_all(p, F.lit(JAVA_PRETOKEN), F.lit(0)),
                              F.when(m.isNull(), F.array().cast("array<string>")).otherwise(F.array(m)))))
    return F.when(F.instr(c, "<") == 0, plain).otherwise(split)


def word_counts(df: DataFrame, col: str = "text") -> DataFrame:
    return pretokens(df, col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def id_char(i: int) -> str:
    """The character that stands for id ``i`` in word strings (rising with the
    id; surrogates are left out)."""
    c = 0x100 + i
    return chr(c if c < 0xD800 else c + 0x800)


def char_id(c: str) -> int:
    x = ord(c)
    return x - 0x100 if x < 0xD800 else x - 0x900


def _char_id(col: Column) -> Column:
    x = F.ascii(col)
    return F.when(x < 0xD800, x - 0x100).otherwise(x - 0x900)


def word_table(df: DataFrame, col: str = "text") -> DataFrame:
    """``(sym, n)``: distinct pre-tokens as strings of id characters, their count."""
    ids = byte_to_id_table()
    latin = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
    # the null byte cannot be an argument of translate; it is replaced by itself
    src = "".join(chr(b) for b in range(1, 256))
    dst = "".join(id_char(ids[b]) for b in range(1, 256))
    sym = F.replace(F.translate(latin, src, dst), F.lit("\0"), F.lit(id_char(ids[0])))
    return word_counts(df, col).select(sym.alias("sym"), "n")


def _pairs(words: DataFrame) -> DataFrame:
    """Weighted adjacent pairs ``(pair, n)``, a pair being two id characters."""
    return words.selectExpr(f"explode({_two('sym')}) as pair", "n").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_counts(words: DataFrame) -> DataFrame:
    """Weighted adjacent-pair counts ``(a, b, n)`` over a word table."""
    return _pairs(words).select(_char_id(F.substring("pair", 1, 1)).alias("a"),
                                _char_id(F.substring("pair", 2, 1)).alias("b"), "n")


#: best pairs looked at per round, and pairs listed by a full count
ROUND_PAIRS, LISTED = 256, 20_000


def certain_merges(best: list[tuple[str, int]], complete: bool) -> list[tuple[str, int]]:
    """The longest head of ``best`` (pairs by count, then by ids) that training
    one merge at a time would take too.

    The first pair is taken. A further pair with count n is certain if it has no
    symbol of a pair taken before, and if no other pair with count n or more has
    one: a merge leaves the counts of pairs without its symbols alone, and a pair
    made by it is at most as frequent as the old pair that it grows from, which
    holds one of its symbols. A pair of two equal symbols is the last of its round:
    in a run the new pairs grow from the merged pair itself, so they may be more
    frequent than all that follow. ``complete`` says that ``best`` is all there is;
    otherwise pairs as frequent as the last one listed are not certain."""
    taken, used = best[:1], set(best[0][0]) if best else set()
    for k in range(1, len(best)):
        if len(set(taken[-1][0])) == 1:
            break
        pair, n = best[k]
        tied = [p for p, m in best[k:] if m == n]
        if n == best[-1][1] and not complete or any(used & set(p) for p in tied):
            break
        taken.append(best[k])
        used |= set(pair)
    return taken


def _two(sym: str) -> str:
    """SQL of the adjacent pairs of a word string."""
    return (f"if(length({sym}) >= 2, transform(sequence(1, length({sym}) - 1), i -> substring({sym}, i, 2)), "
            "cast(array() as array<string>))")


def _changes(words: DataFrame, pairs: list[str], merged: str) -> DataFrame:
    """``(pair, n)``: how the merges change the counts, from the words that hold them."""
    held = " or ".join(f"contains(sym, '{p}')" for p in pairs)  # id characters need no quoting
    signed = (f"concat(transform({_two('sym')}, p -> struct(p as pair, -n as n)), "
              f"transform({_two('new')}, p -> struct(p as pair, n as n)))")
    return (words.where(held).selectExpr("sym", "n", f"{merged} as new").selectExpr(f"inline({signed})")
            .groupBy("pair").agg(F.sum("n").alias("n")).where("n <> 0"))


class _Listed:
    """The most frequent pairs, kept up to date by changes."""

    def __init__(self, words: DataFrame):
        rows = [(r["pair"], r["n"]) for r in
                _pairs(words).where("n > 0").orderBy(F.col("n").desc(), "pair").limit(LISTED + 1).collect()]
        self.floor = rows[LISTED][1] if len(rows) > LISTED else 0
        self.counts, self.first, self.made = dict(rows[:LISTED]), rows[:1], set()

    def best(self) -> tuple[list[tuple[str, int]], bool]:
        """(pairs above the floor by count, then by ids; whether these are all of them)."""
        above = [(-n, p) for p, n in self.counts.items() if n > self.floor]
        top = [(p, -n) for n, p in heapq.nsmallest(ROUND_PAIRS, above)]
        if not top and self.first and not self.made:
            top = self.first  # more pairs tie than are listed: the first of them all
        return top, len(above) < ROUND_PAIRS

    def change(self, rows, made: set[str]):
        self.made |= made
        for r in rows:
            pair = r["pair"]
            if pair in self.counts or self.made & set(pair):
                self.counts[pair] = self.counts.get(pair, 0) + r["n"]
                if not self.counts[pair]:
                    del self.counts[pair]


def train_bpe(df: DataFrame, col: str = "text", n_merges: int = 100, min_frequency: int = 0,
              first_id: int = FIRST_MERGE_ID, checkpoint_every: int = 16, on_round=None) -> DataFrame:
    """Learn up to ``n_merges`` merges from the text column, several per round
    where they are certain. Returns the merge table, ``rank`` 0-based in merge
    order. ``on_round(rounds, merges)`` is called after every round."""
    spark = df.sparkSession
    pieces = {i: t for i, t in enumerate(SPECIAL_TOKENS)}
    for byte, tid in enumerate(byte_to_id_table()):
        pieces[tid] = chr(byte)
    words = cut_lineage(word_table(df, col).repartition(spark.sparkContext.defaultParallelism, "sym"))
    merges, old, rounds, listed = [], None, 0, _Listed(words)
    while len(merges) < n_merges:
        best, complete = listed.best()
        if not best and listed.made:
            listed = _Listed(words)
            best, complete = listed.best()
        found = [(p, n) for p, n in certain_merges(best, complete) if n > 0 and n >= min_frequency]
        if not found:
            break
        sym, found = "sym", found[:n_merges - len(merges)]
        made = set()
        for pair, n in found:
            a, b, new = char_id(pair[0]), char_id(pair[1]), first_id + len(merges)
            pieces[new] = pieces[a] + pieces[b]
            merges.append((len(merges), a, b, new, n, pieces[new]))
            made.add(id_char(new))
            sym = f"replace({sym}, '{pair}', '{id_char(new)}')"
        rounds += 1
        if len(merges) < n_merges:
            changes = _changes(words, [p for p, _ in found], sym).collect()  # bounded by the vocabulary
            listed.change(changes, made)
            if old is not None:
                old.unpersist()  # ``words`` has been computed by now
            old = words if words.storageLevel != StorageLevel.NONE else None
            nxt = words.selectExpr(f"{sym} as sym", "n")
            words = (cut_lineage(nxt) if checkpoint_every and rounds % checkpoint_every == 0
                     else nxt.persist(StorageLevel.MEMORY_AND_DISK))
        if on_round:
            on_round(rounds, len(merges))
    if old is not None:
        old.unpersist()
    words.unpersist()
    return spark.createDataFrame(merges, MERGES_SCHEMA)


# ---------------------------------------------------------------------------
# encoding / decoding with merges (Arrow batches)
# ---------------------------------------------------------------------------
def _bpe_word(sym: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges by rank, leftmost first among equal ranks: a heap of
    adjacent pairs over a linked list, so a unit of n bytes takes n log n."""
    n = len(sym)
    sym, left, right = list(sym), list(range(-1, n - 1)), [*range(1, n), -1]
    heap = []
    for i in range(n - 1):
        r = ranks.get((sym[i], sym[i + 1]))
        if r is not None:
            heap.append((r[0], i, sym[i], sym[i + 1]))
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i] if sym[i] == a else -1
        if j < 0 or sym[j] != b:
            continue  # one of the two has been merged meanwhile
        sym[i], sym[j] = ranks[a, b][1], -1
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        for x, y in ((left[i], i), (i, right[i])):
            if x >= 0 and y >= 0 and (r := ranks.get((sym[x], sym[y]))) is not None:
                heapq.heappush(heap, (r[0], x, sym[x], sym[y]))
    return [x for x in sym if x >= 0]


#: bytes of cached units and ids per worker (the cache starts anew beyond)
_CACHE_BYTES = 128 << 20


def make_unit_encoder(merge_rows: list[tuple[int, int, int, int]]):
    """Arrow batch function: list of units -> ids. Per batch the units are
    dictionary-encoded, each distinct unit is merged once (and kept in a
    per-worker cache), and the ids of all units are gathered in one
    vectorized pass."""
    from ..functions.arrow_codec import _SPECIAL_IDS, list_array

    ranks = {(a, b): (r, new) for r, a, b, new in merge_rows}
    lut = np.asarray(byte_to_id_table(), dtype=np.int32)
    cache: dict[str, np.ndarray] = {}
    held = [0]

    def one(u: str) -> np.ndarray:
        sid = _SPECIAL_IDS.get(u)
        if sid is not None:
            return np.asarray([sid], dtype=np.int32)
        return np.asarray(_bpe_word(lut[np.frombuffer(u.encode("utf-8"), np.uint8)].tolist(), ranks),
                          dtype=np.int32)

    def encode_units(arr: pa.Array) -> pa.Array:
        if isinstance(arr, pa.ChunkedArray):
            arr = arr.combine_chunks()
        loff = np.asarray(arr.offsets.to_numpy(zero_copy_only=False), dtype=np.int64)
        loff = loff - loff[0]
        vals = arr.flatten()
        if held[0] > _CACHE_BYTES:
            cache.clear()
            held[0] = 0
        if len(vals):
            de = pc.dictionary_encode(vals)
            idx = np.asarray(de.indices.to_numpy(zero_copy_only=False), dtype=np.int64)
            enc = []
            for u in de.dictionary.to_pylist():
                e = cache.get(u)
                if e is None:
                    e = one(u)
                    cache[u] = e
                    held[0] += 200 + 4 * len(u) + e.nbytes
                enc.append(e)
            ulen = np.fromiter((len(e) for e in enc), dtype=np.int64, count=len(enc))
            uflat = np.concatenate(enc) if enc else np.zeros(0, dtype=np.int32)
            ustart = np.concatenate([[0], np.cumsum(ulen)[:-1]])
            lens = ulen[idx]
            ends = np.cumsum(lens)
            total = int(ends[-1]) if len(ends) else 0
            gather = np.repeat(ustart[idx] - (ends - lens), lens) + np.arange(total, dtype=np.int64)
            flat = uflat[gather]
            cum = np.concatenate([[0], ends])
        else:
            flat = np.zeros(0, dtype=np.int32)
            cum = np.zeros(1, dtype=np.int64)
        mask = arr.is_null().to_numpy(zero_copy_only=False) if arr.null_count else None
        return list_array(cum[loff], flat, mask)

    return encode_units


#: a merge table is a vocabulary: more rows than this are refused, never cut
MAX_VOCABULARY = 1 << 20


def merge_rows(merges: DataFrame) -> list:
    """All merges in rank order (one row per vocabulary entry)."""
    rows = merges.select("rank", "a", "b", "new_id", "piece").limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"merge table has more than {MAX_VOCABULARY} rows")
    return sorted(rows, key=lambda r: r["rank"])


def encode_with_merges(df: DataFrame, col: str, merges: DataFrame | list, out: str = "ids") -> DataFrame:
    """Text -> ids with merges (special tokens split first). ``merges`` is the
    merge table or its collected ``merge_rows``."""
    rows = merges if isinstance(merges, list) else merge_rows(merges)
    fn = arrow_udf(make_unit_encoder([(r["rank"], r["a"], r["b"], r["new_id"]) for r in rows]),
                   ArrayType(IntegerType())).asNondeterministic()
    return df.withColumn(out, fn(units(col)))


#: bytes of text in a block of ``encode_by_units``
BLOCK_BYTES = 4 << 20


def _gather(n_keys: int, names: list[str]):
    """Cogroup function: texts of a block (keys, units) and its units with their ids -> keys and ids."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        keys, lists = [left.column(i) for i in range(1, 1 + n_keys)], left.column(1 + n_keys).combine_chunks()
        rows = [(list(k) if None not in k else None) for k in zip(*(c.to_pylist() for c in keys))]
        where = {}
        for i, k in enumerate(rows):
            if k is not None:
                where.setdefault(tuple(k), []).append(i)
        again = {i: at for at in where.values() if len(at) > 1 for i in at}
        off = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        off = off - off[0]
        known, pieces = right.column(1).combine_chunks(), right.column(2).combine_chunks()
        at = pc.index_in(lists.flatten(), value_set=known).to_numpy(zero_copy_only=False).astype(np.int64)
        start = pieces.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        flat, start = pieces.flatten().to_numpy(zero_copy_only=False), start - start[0]
        lens = np.diff(start)[at]
        ends = np.concatenate([[0], np.cumsum(lens)])
        ids = flat[np.repeat(start[at] - ends[:-1], lens) + np.arange(ends[-1])] if len(at) else np.zeros(0, np.int32)
        cut = ends[off]
        out = []
        null = lists.is_null().to_numpy(zero_copy_only=False)
        for i, k in enumerate(rows):
            if i in again:  # rows that share their keys: their units by place, then by ids
                both = sorted((p, ids[ends[o]:ends[o + 1]].tolist()) for j in again[i]
                              for p, o in enumerate(range(off[j], off[j + 1])))
                part = np.array([x for _, piece in both for x in piece], np.int32)
            else:
                part = ids[cut[i]:cut[i + 1]] if k is not None else np.zeros(0, np.int32)
            out.append(None if null[i] and not len(part) else part)
        return pa.table([*keys, pa.array(out, pa.list_(pa.int32()))], names=names)
    return run


def encode_by_units(df: DataFrame, keys: list[str], col: str, merges: DataFrame | list, out: str = "ids") -> DataFrame:
    """``keys + ids``: the ids of ``encode_with_merges`` by a join. Every distinct unit
    (pre-token or special token) of the whole table is encoded once. Texts are dealt to
    blocks of about ``BLOCK_BYTES`` by their keys; what meets the encoded units is one row
    per block and distinct unit, and the ids of a block's units are gathered in its texts. So
    a text is shuffled once, and a frequent unit costs one row a block, not one a text.
    ``keys`` must name a row; texts that are null get null ids.

    Worth it where encoding a unit is dear (large merge tables, long units) or its ids are
    wanted as a table; ``encode_with_merges`` shuffles nothing."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession, BATCH_BYTES)
    rows = merges if isinstance(merges, list) else merge_rows(merges)
    fn = arrow_udf(make_unit_encoder([(r["rank"], r["a"], r["b"], r["new_id"]) for r in rows]),
                   ArrayType(IntegerType())).asNondeterministic()
    size = df.agg(F.sum(F.octet_length(col))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    texts = (df.select(F.pmod(F.xxhash64(*keys), F.lit(blocks)).alias("block_"), *keys, F.col(col).alias("text_"))
             .repartition("block_"))
    placed = texts.select("block_", F.explode(units("text_")).alias("unit_")).distinct()
    encoded = placed.select("unit_").distinct().withColumn("piece_", fn(F.array("unit_")))
    told = placed.join(encoded, "unit_").select(F.col("block_").alias("of_"), "unit_", "piece_")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    return (texts.select("block_", *keys, units("text_").alias("units_")).groupBy("block_")
            .cogroup(told.groupBy("of_")).applyInArrow(_gather(len(keys), [*keys, out]), f"{kinds}, `{out}` array<int>"))


def decode_with_merges(df: DataFrame, ids: str, merges: DataFrame | list, out: str = "text") -> DataFrame:
    from ..functions.arrow_codec import decoder_for_pieces
    rows = merges if isinstance(merges, list) else merge_rows(merges)
    extra = {int(r["new_id"]): r["piece"].encode("latin-1") for r in rows}
    return df.withColumn(out, decoder_for_pieces(extra)(F.col(ids)))
