"""Corpus text operators: blank-text filter, fixed-width chunking, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import not_blank, pieces
from ..options import CHUNK_WIDTH


def drop_blank(df: DataFrame, col: str = "text") -> DataFrame:
    """Keep rows whose text is not blank (the text itself is not stripped)."""
    return df.filter(not_blank(col))


def chunk_text(df: DataFrame, col: str = "text", width: int = CHUNK_WIDTH,
               keep: list[str] | None = None) -> DataFrame:
    """Split each non-blank text into ``width``-code-point chunks.

    Output: ``keep`` columns + ``chunk_no`` (position among all pieces of the
    text) + ``chunk``. Blank chunks are dropped, edge blanks inside a chunk
    are kept. Filters run before the generator so that they stay next to the
    scan; one stage, no shuffle. A long text yields many rows from one input
    row; a later wide operator should repartition after this, not before.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != col]
    return (df.filter(not_blank(col))
            .select(*keep, F.posexplode(pieces(col, width)).alias("chunk_no", "chunk"))
            .filter(not_blank("chunk"))
            .withColumn("chunk_no", F.col("chunk_no").cast("long")))


def chunk_counts(chunks: DataFrame, by: str = "source") -> DataFrame:
    """Chunks and characters per key (partial aggregation before the shuffle)."""
    return chunks.groupBy(by).agg(F.count(F.lit(1)).alias("n_chunks"),
                                  F.sum(F.length("chunk")).alias("n_chars"))
