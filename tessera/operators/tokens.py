"""Token operators on DataFrames: encode, decode, fit to a fixed length.

Merge-free encoding maps special-token strings to their ids and every other
UTF-8 byte to its byte id. Two interchangeable implementations:
``impl="arrow"`` (default) runs one vectorized lookup per Arrow batch;
``impl="sql"`` is a pure SQL expression (higher-order functions, one lambda
call per byte, about 7x slower at sf0.1, no Python worker). With a merge
table (from ``bpe.train_bpe``) the byte ids of each pre-token are merged by
rank; see ``bpe.encode_with_merges``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.bytes import decode_sql, encode_sql
from ..options import MAX_LENGTH, PAD_ID
from ..session import ship_package, small_batches

#: bytes of texts or ids in one Arrow batch: ids and index arrays of a batch take many times that
BATCH_BYTES = 2 << 20


def encode(df: DataFrame, col: str = "text", out: str = "ids", merges: DataFrame | list | None = None,
           impl: str = "arrow") -> DataFrame:
    """Text to token ids. Special-token strings become their ids (a literal
    ``<|im_end|>`` in content becomes id 4, as when a rendered chat is
    tokenized); everything else becomes byte ids, merged when ``merges`` is
    given."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession, BATCH_BYTES)
    if merges is None:
        if impl == "sql":
            return df.withColumn(out, F.expr(encode_sql(f"`{col}`")))
        from ..functions.arrow_codec import encode_bytes_arrow
        return df.withColumn(out, encode_bytes_arrow(F.col(col)))
    from .bpe import encode_with_merges
    return encode_with_merges(df, col, merges, out=out)


def decode(df: DataFrame, ids: str = "ids", out: str = "text", merges: DataFrame | list | None = None,
           impl: str = "arrow") -> DataFrame:
    """Token ids back to text (special tokens as their strings)."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession, BATCH_BYTES)
    if merges is None:
        if impl == "sql":
            return df.withColumn(out, F.expr(decode_sql(f"`{ids}`")))
        from ..functions.arrow_codec import decode_bytes_arrow
        return df.withColumn(out, decode_bytes_arrow(F.col(ids)))
    from .bpe import decode_with_merges
    return decode_with_merges(df, ids, merges, out=out)


def fit_length(df: DataFrame, ids: str = "ids", n: int = MAX_LENGTH, pad: int = PAD_ID,
               out: str | None = None, real: str = "n_real") -> DataFrame:
    """Truncate to the first ``n`` ids, pad with ``pad`` to exactly ``n``;
    ``n_real`` keeps the number of real ids."""
    return (df.withColumn(real, A.real_length(ids, n))
              .withColumn(out or ids, A.fit_length(ids, n, pad)))


def truncated_count(df: DataFrame, ids: str = "ids", n: int = MAX_LENGTH) -> DataFrame:
    """How many rows lose ids to truncation (report for the sample builder)."""
    return df.agg(F.sum(F.when(F.size(ids) > n, 1).otherwise(0)).alias("n_truncated"),
                  F.count(F.lit(1)).alias("n_rows"))
