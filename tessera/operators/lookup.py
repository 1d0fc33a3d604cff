"""Id -> row lookups (vectors, text pieces) against a keyed table.

The looked-up table is keyed by id. ``lookup`` is a plain equi-join: Spark (and
AQE, from measured sizes) broadcasts a small side, and otherwise splits hot ids
of the large side. Loops that join the same written table in every step use
``checked_broadcast``, which asks for a broadcast only below a size in bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrow_codec import count_ids_arrow
from ..session import ship_package, small_batches
from .tokens import BATCH_BYTES

#: largest table, in bytes, that a loop broadcasts in every step
BROADCAST_BYTES = 64 << 20


def checked_broadcast(table: DataFrame, row_bytes: int = 32) -> DataFrame:
    """``broadcast(table)`` when rows x ``row_bytes`` is at most
    ``BROADCAST_BYTES``, else the table itself (a shuffle join). ``table`` must be
    materialised (checkpoint): it is counted here."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def explode_ids(df: DataFrame, ids: str, keys: list[str], pos: str = "pos", out: str = "id") -> DataFrame:
    """One row per id, position kept."""
    return df.select(*keys, F.posexplode(ids).alias(pos, out))


def lookup(long: DataFrame, table: DataFrame, id_col: str, key: str, how: str = "left") -> DataFrame:
    """Join ``table`` rows onto ``long`` by ``long[id_col] == table[key]``."""
    return long.join(table, long[id_col] == table[key], how)


def vector_lookup(df: DataFrame, ids: str, keys: list[str], vectors: DataFrame,
                  key: str = "vec_id", cols: tuple = ("embedding",)) -> DataFrame:
    """``keys + (pos, id, *cols)``: the vector row of every id, in position
    order (ids without a row get nulls). ``cols`` may be expressions: pass the
    needed elements rather than whole vectors."""
    long = explode_ids(df, ids, keys)
    v = vectors.select(F.col(key).cast("long").alias("k_"), *cols)
    return lookup(long, v, "id", "k_", "left").drop("k_")


def counted_lookup(df: DataFrame, ids: str, keys: list[str], table: DataFrame, key: str, cols: tuple,
                   pad: int | None = None) -> DataFrame:
    """``keys + (id, n, *cols)``: the looked-up row of every distinct id of a sample (a row
    of ``df``), with the number ``n`` of its places. Equal ids are added up inside the
    sample's own list, an Arrow batch at a time: a task holds no table of the ids of all
    its samples. So the padding id ``pad`` has one row a sample, as any other id, and goes
    the same way."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession, BATCH_BYTES)
    t = table.select(F.col(key).cast("long").alias("k_"), *cols)
    names = [c for c in t.columns if c != "k_"]
    counted = df.select(*keys, count_ids_arrow(F.col(ids)).alias("counts_"))
    counted = counted.select(*keys, F.explode("counts_").alias("c_")).select(*keys, "c_.id", "c_.n")
    return lookup(counted, t, "id", "k_").select(*keys, "id", "n", *names)
