"""Loss masks and the next-token shift.

Two forms of the answer-span mask give the same result:
* array form (default, per row, no shuffle): ``span_mask``;
* relational form over an exploded ``(key, pos, id)`` table with window
  functions: ``span_mask_long``; used to cross-check and for sequences that
  are already long-form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.bytes import byte_to_id_table
from ..options import BOS_ID, EOS_ID, MAX_LENGTH


def answer_header(role: str = "assistant", merges: DataFrame | list | None = None) -> list[int]:
    """Ids of ``<|im_start|>{role}\n`` in the vocabulary in use.

    Without merges: the BOS id and the byte ids of ``role + "\n"``. With a
    merge table (bounded by the vocabulary size, collected once) the header
    text is encoded exactly as chat text is: special token first, then the
    pre-tokens of the rest merged by rank."""
    if merges is None:
        table = byte_to_id_table()
        return [BOS_ID] + [table[b] for b in (role + "\n").encode("utf-8")]
    import pyarrow as pa
    import regex

    from ..options import BOS_TOKEN, PRETOKEN_PATTERN
    from .bpe import make_unit_encoder, merge_rows
    rows = merges if isinstance(merges, list) else merge_rows(merges)
    enc = make_unit_encoder([(r["rank"], r["a"], r["b"], r["new_id"]) for r in rows])
    units = [BOS_TOKEN] + regex.findall(PRETOKEN_PATTERN, role + "\n")
    return enc(pa.array([units], pa.list_(pa.string()))).to_pylist()[0]


def real_mask(df: DataFrame, n_real: str = "n_real", n: int = MAX_LENGTH,
              out: str = "loss_mask") -> DataFrame:
    """1 on real ids, 0 on padding (pretraining)."""
    return df.withColumn(out, A.real_mask(n_real, n))


def span_mask(df: DataFrame, ids: str = "ids", header: list[int] | None = None,
              end: int = EOS_ID, out: str = "loss_mask") -> DataFrame:
    """1 from after each answer header through the next ``end`` id inclusive
    (chat fine-tuning); answers cut before their ``end`` get no mark."""
    header = header if header is not None else answer_header()
    return df.withColumn(out, F.expr(A.span_mask_sql(f"`{ids}`", header, end)))


def span_mask_long(long: DataFrame, key: str, pos: str = "pos", tok: str = "id",
                   header: list[int] | None = None, end: int = EOS_ID,
                   out: str = "mark") -> DataFrame:
    """Relational form over ``(key, pos, id)`` rows. A position is marked when
    the latest header ending before it lies in the same run of ids between
    ``end`` ids (no ``end`` in between) and an ``end`` id exists at or after
    it. Windows are per sequence (bounded by the sample length)."""
    header = header if header is not None else answer_header()
    h = len(header)
    w = Window.partitionBy(key).orderBy(pos)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    is_end = (F.col(tok) == F.lit(end)).cast("int")
    match = None
    for k, hid in enumerate(header):
        c = (F.lag(tok, h - 1 - k).over(w) if k < h - 1 else F.col(tok)) == F.lit(hid)
        match = c if match is None else (match & c)
    df = (long.withColumn("seg_", F.coalesce(F.sum(is_end).over(before), F.lit(0)))
              .withColumn("hdr_", F.coalesce(match, F.lit(False))))
    df = (df.withColumn("hseg_", F.max(F.when(F.col("hdr_"), F.col("seg_"))).over(before))
            .withColumn("end_after_", F.max(is_end).over(after)))
    mark = F.when((F.col("hseg_") == F.col("seg_")) & (F.col("end_after_") == 1), 1).otherwise(0)
    return df.withColumn(out, mark).drop("seg_", "hdr_", "hseg_", "end_after_")


def shift(df: DataFrame, ids: str = "ids", mask: str = "loss_mask", n: int = MAX_LENGTH) -> DataFrame:
    """``x = ids[:-1]``, ``y = ids[1:]``, mask aligned with ``y``."""
    return (df.withColumn("x", A.shift_x(ids, n))
              .withColumn("y", A.shift_y(ids, n))
              .withColumn(mask, A.shift_y(mask, n)))
