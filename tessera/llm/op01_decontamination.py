"""Benchmark decontamination by template canonicalisation.

Texts become token sequences (runs of letters and digits, in lower
case) in which
numbers and number words, units behind a number, and names (capitalised words
inside a sentence) are replaced by typed placeholders. Windows of ``WINDOW``
template tokens of the benchmark items are hash-joined with those of the
documents. Each window stands for two templates, with names kept and with names
replaced. Per document, item and offset diagonal, the values behind equal
placeholders are compared: a re-parameterised question replaces a value by the
same other value everywhere, so the distinct (benchmark value, document value)
pairs should form a one-to-one relation. Diagonals with a consistency of
``MIN_CONSISTENCY`` count; of other diagonals the windows count whose values are
all equal. A document leaks an item if they cover at least ``MIN_COVERAGE`` of the
item's windows, or ``MIN_WINDOWS`` of them (13 tokens in a row, the usual measure
of contamination).

Only windows whose hash is set in a bit map of fixed size (2**MAP_BITS bits, from
all benchmark windows) leave the document scan; the join with the window table
then decides. Windows with more placeholders than literal tokens have no template;
they are joined by their literal tokens, values included, so that copies of sums,
sequences and tables are found (coverage is that of all windows or of the templates
alone, whichever is higher). Items shorter than a window form one window of their own length, with
three tokens at least; shorter items cannot be matched.

Result: one row per leaking (document, item). Rows: null or empty texts have no
windows; rows that share an id (or a null id) count as one document; repeated
items match each by themselves; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import small_enough, written

WINDOW, SHORTEST = 8, 3
MIN_COVERAGE, MIN_WINDOWS, MIN_CONSISTENCY = 0.5, 6, 0.9
MAP_BITS = 22

# Number words and unit words.
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand
million billion dozen half""".split()
UNIT_WORDS = """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce
ounces pound pounds lb lbs ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute
minutes h hour hours day days week weeks month months year years percent degree degrees celsius fahrenheit kelvin
volt volts watt watts kw joule joules newton newtons pascal hz khz mhz ghz byte bytes kb mb gb tb dollar dollars
usd euro euros eur cent cents pence""".split()

_NUMBER, _UNIT, _NAME, _LITERAL = (tk.GRAM[i] for i in (50, 51, 52, 53))


def _hashes(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return np.sort(tk.Words(raw, np.array([0, len(raw)]), tk.ALNUM).hash)


def _member(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return table[at] == x


class Template:
    """Template tokens of a segment: plain and named codes, values, document bounds."""

    def __init__(self, words: tk.Words):
        data, start, end, h = words.raw, words.start, words.end, words.hash
        n = len(start)
        doc = words.doc()
        lead = data[start]
        digit = (lead >= 48) & (lead <= 57)
        number = digit | _member(h, _hashes(NUMBER_WORDS))
        follows = np.zeros(n, bool)
        follows[1:] = doc[1:] == doc[:-1]
        gap = np.zeros(n, np.uint8)
        if n:
            gap[1:][start[1:] - end[:-1] == 1] = data[end[:-1]][start[1:] - end[:-1] == 1]
        joined = np.zeros(n, bool)
        joined[1:] = follows[1:] & digit[1:] & digit[:-1] & ((gap[1:] == 46) | (gap[1:] == 44))
        unit = np.zeros(n, bool)
        after = np.flatnonzero(follows[1:] & number[:-1] & ~number[1:]) + 1
        unit[after] = _member(h[after], _hashes(UNIT_WORDS))
        second = np.minimum(start + 1, len(data) - 1)
        two = lead >= 0xC2
        upper = (lead != words.data[start]) | (two & (data[second] != words.data[second]))
        behind = np.minimum(start + np.where(two, 2, 1), end - 1)
        small = data[behind] == words.data[behind]
        name = upper & small & (end - start > 1) & follows & (gap == 32) & ~number
        keep = ~joined
        value = h.copy()
        if joined.any():
            host = (np.cumsum(keep) - 1)[joined]
            held = value[keep]
            np.add.at(held, host, h[joined] * tk.GRAM[60])
            self.value = held
        else:
            self.value = value
        self.slot = (number | unit)[keep]
        self.name = name[keep]
        self.plain = np.where(number, _NUMBER, np.where(unit, _UNIT, h))[keep]
        self.named = np.where(self.name, _NAME, self.plain)
        self.bounds = np.concatenate([[0], np.cumsum(keep)])[words.bounds]

    def windows(self, k: int):
        """(document, position, hash, typed, place, slots) of all windows of k tokens;
        windows full of placeholders by their values (typed is false, no slots)."""
        n = len(self.plain) - k + 1
        if n <= 0:
            return
        doc = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        inside = doc[:n] == doc[k - 1:]
        for named in (False, True):
            code = self.named if named else self.plain
            slot = self.slot | self.name if named else self.slot
            filled = np.concatenate([[0], np.cumsum(slot)])
            ok = inside & (2 * (filled[k:] - filled[:-k]) <= k)
            if named:  # the same as the plain window where it holds no name
                held = np.concatenate([[0], np.cumsum(self.name)])
                ok &= held[k:] > held[:-k]
            at = np.flatnonzero(ok)
            yield doc[at], at - self.bounds[doc[at]], tk.grams(code, k)[at], True, at, slot
        # a leading unit is one only behind a number: with or without it the window is too full
        filled = np.concatenate([[0], np.cumsum(self.slot)])
        at = np.flatnonzero(inside & (2 * (filled[k:] - filled[:-k] + 1) > k))
        if len(at):
            h = tk.grams(self.value, k)[at] ^ _LITERAL
            yield doc[at], at - self.bounds[doc[at]], h, False, at, np.zeros(len(self.slot), bool)


def _rows(batches, lengths, keep, shortest_only):
    for batch in batches:
        ids = batch.column(0)
        for first, words in tk.scan(batch.column(1), tk.ALNUM, fold=True):
            t = Template(words)
            size = np.diff(t.bounds)
            for k in lengths:
                for doc, pos, h, typed, at, slot in t.windows(k):
                    ok = keep(h)
                    if shortest_only:  # benchmark items: their own length if short
                        ok &= (size[doc] == k) if k < WINDOW else (size[doc] >= k)
                    pick = np.flatnonzero(ok)
                    slots = [t.value[a:a + k][slot[a:a + k]].view(np.int64) for a in at[pick].tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(doc[pick] + first)), pa.array(pos[pick], pa.int64()),
                         pa.array(h[pick].view(np.int64)), pa.array(np.full(len(pick), k), pa.int32()),
                         pa.array(np.full(len(pick), typed), pa.bool_()),
                         tk.list_array(slots, pa.int64())], names=["id", "pos", "h", "k", "typed", "slots"])


def _slot_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _of_items(batches):
    lengths = range(SHORTEST, WINDOW + 1)
    yield from _rows(batches, lengths, lambda h: np.ones(len(h), bool), True)


def _of_documents(job):
    def run(batches):
        bits, lengths = np.unpackbits(np.frombuffer(job.value[0], np.uint8)).astype(bool), job.value[1]
        yield from _rows(batches, lengths, lambda h: bits[_slot_of(h)], False)
    return run


def _schema(df: DataFrame, column: str) -> str:
    return f"id {df.schema[column].dataType.simpleString()}, pos long, h long, k int, typed boolean, slots array<long>"


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, coverage, consistency, windows, reworded, first_token). Rows are
    told apart by id and text, so texts that share an id or have none are each judged alone."""
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h")).alias("doc_id"),
                       F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    index = written(items.mapInArrow(tk.tidy(_of_items), _schema(items, "item_id"))
                    .withColumnsRenamed({"id": "item_id", "pos": "item_pos", "slots": "item_slots"}), "windows")
    place = F.shiftrightunsigned("h", 64 - MAP_BITS)
    # one row a byte of the map, at most 2**(MAP_BITS - 3)
    used = (index.select(place.cast("int").alias("p")).groupBy(F.expr("p div 8").alias("byte"))
            .agg(F.expr("cast(bit_or(shiftleft(1, 7 - p % 8)) as int)").alias("bits")).toArrow())
    lengths = sorted(r.k for r in index.select("k").distinct().collect())
    bits = np.zeros(1 << MAP_BITS >> 3, np.uint8)
    bits[used["byte"].to_numpy()] = used["bits"].to_numpy().astype(np.uint8)
    job = sc.broadcast((bits.tobytes(), lengths))
    found = docs.mapInArrow(tk.tidy(_of_documents(job)), _schema(docs, "doc_id")).withColumnRenamed("id", "doc_id")
    of_item = index.groupBy("item_id").agg(F.countDistinct("item_pos").alias("windows"), F.countDistinct(
        F.when(F.col("typed"), F.col("item_pos"))).alias("templates"))
    hits = found.join(small_enough(index, 256), ["h", "k", "typed"])
    pairs = F.transform(F.arrays_zip("item_slots", "slots"),
                        lambda p: F.struct(p["item_slots"].alias("b"), p["slots"].alias("d")))
    same = F.col("item_slots") == F.col("slots")
    place_ = F.struct("item_pos", "typed")
    lines = (hits.groupBy("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("offset"))
             .agg(F.collect_set(place_).alias("at"), F.min("pos").alias("first"),
                  F.collect_set(F.when(same, place_)).alias("same_at"),
                  F.min(F.when(same, F.col("pos"))).alias("same_first"),
                  F.array_distinct(F.flatten(F.collect_list(pairs))).alias("pairs")))
    ones = F.least(F.size(F.array_distinct(F.transform("pairs", lambda p: p["b"]))),
                   F.size(F.array_distinct(F.transform("pairs", lambda p: p["d"]))))
    other = F.size(F.filter("pairs", lambda p: p["b"] != p["d"]))
    consistency = F.when(F.size("pairs") == 0, 1.0).otherwise(ones / F.size("pairs"))
    whole = consistency >= MIN_CONSISTENCY  # else only windows with equal values count
    lines = (lines.select("doc_id", "item_id", F.when(whole, consistency).otherwise(1.0).alias("consistency"),
                          F.when(whole, other).otherwise(0).alias("other"),
                          F.when(whole, F.col("at")).otherwise(F.col("same_at")).alias("at"),
                          F.when(whole, F.col("first")).otherwise(F.col("same_first")).alias("first"))
             .where(F.size("at") > 0))
    docs_ = (lines.groupBy("doc_id", "item_id")
             .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
                  F.min("consistency").alias("consistency"), (F.max("other") > 0).alias("reworded"),
                  F.min("first").alias("first_token")))
    return (docs_.alias("l").join(of_item.alias("i"), F.expr("l.item_id <=> i.item_id"))
            .withColumn("hit", F.size(F.array_distinct(F.transform("at", lambda p: p["item_pos"]))))
            .withColumn("typed", F.size(F.array_distinct(F.filter("at", lambda p: p["typed"]))))
            .withColumn("coverage", F.greatest(F.col("hit") / F.col("windows"), F.expr("try_divide(typed, templates)")))
            .where((F.col("coverage") >= MIN_COVERAGE) | (F.col("hit") >= MIN_WINDOWS))
            .select(F.col("doc_id.id").alias("doc_id"), "l.item_id", "coverage", "consistency", "windows", "reworded", "first_token"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that leak a benchmark item go. Rows are told apart
    by a hash of id and text, so null and repeated ids are each judged by their text."""
    row = F.xxhash64("doc_id", "text")
    marked = docs.select(row.alias("row"), "text")
    lost = written(leaks(marked, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row")
                   .select(F.col("doc_id").alias("__row")).distinct(), "leaks")
    return docs.join(small_enough(lost, 8), row == F.col("__row"), "left_anti")
