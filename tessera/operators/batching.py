"""Seeded shuffle, fixed-size batches, epochs and the run plan.

The shuffle order of an epoch is ``md5(seed:epoch:sample_key)`` (ties by the
key itself), reproducible and identical in any SQL engine. A global position
in that order is computed without a single-task window and without sampling:

1. the md5 order key is uniform, so its first 32 bits split the order into
   ``buckets`` equal, contiguous ranges:
   ``bucket = prefix * buckets / 2^32``;
2. a tiny aggregate counts rows per ``(epoch, bucket)``; a window over that
   summary (``epochs x buckets`` rows, broadcast) gives each bucket's offset;
3. ``row_number()`` within ``(epoch, bucket)`` (about ``rows/buckets`` rows
   per window partition, no hot key since the key holds the sample id) plus
   the offset is the position.

Everything is a deterministic function of the data, so a recomputed task
(lost executor) produces the same positions; nothing goes through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrays import first_numbers
from ..functions.schedule import learning_rate
from ..options import BATCH_SIZE, RunOptions, SEED
from .lookup import BROADCAST_BYTES


def shuffle_key(id_cols: list[str], seed: int = SEED, epoch: Column | int = 0) -> Column:
    e = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), e.cast("string"),
                             *[F.col(c).cast("string") for c in id_cols]))


# Always the same number of buckets, whatever the input: their summary stays at
# 65536 rows per epoch, and a bucket holds rows/65536 rows (1.5 million of 10^11).
BUCKETS = 1 << 16


def hex_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a uniformly distributed hex key, monotone in the key."""
    prefix = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    return F.floor(prefix * F.lit(float(buckets)) / F.lit(4294967296.0)).cast("int")


def global_index(df: DataFrame, key_col: str, tie_cols: list[str], group_col: str,
                 buckets: int | None = None, out: str = "idx", groups: int = 1) -> DataFrame:
    """0-based position of each row within ``group_col`` in the order of
    ``(key_col, *tie_cols)``; ``key_col`` must be a uniform hex digest. The offsets,
    ``groups`` x buckets rows, are broadcast while they stay below ``BROADCAST_BYTES``."""
    nb = buckets or BUCKETS
    d = df.withColumn("bkt_", hex_bucket(F.col(key_col), nb))
    counts = d.groupBy(group_col, "bkt_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(group_col).orderBy("bkt_").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(group_col, "bkt_",
                            F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("off_"))
    within = Window.partitionBy(group_col, "bkt_").orderBy(key_col, *tie_cols)
    return (d.withColumn("rn_", F.row_number().over(within))
            .join(F.broadcast(offsets) if groups * nb * 32 <= BROADCAST_BYTES else offsets, [group_col, "bkt_"])
            .withColumn(out, (F.col("off_") + F.col("rn_") - 1).cast("long"))
            .drop("bkt_", "rn_", "off_"))


def assign_batches(df: DataFrame, id_cols: list[str], batch: int = BATCH_SIZE, epochs: int = 1,
                   seed: int = SEED, partitions: int | None = None) -> DataFrame:
    """Adds ``epoch, order_key, sample_idx, batch_id, batch_pos``: a fresh
    seeded order per epoch, batches of ``batch`` rows, the last one short.

    Every row comes once per epoch (rows x epochs, as the result has), then every
    epoch is ordered independently."""
    d = df.select("*", F.explode(first_numbers(epochs)).alias("epoch")) if epochs > 1 else df.withColumn("epoch", F.lit(0))
    d = d.withColumn("order_key", shuffle_key(id_cols, seed, F.col("epoch")))
    d = global_index(d, "order_key", list(id_cols), group_col="epoch",
                     buckets=partitions, out="sample_idx", groups=epochs)
    return (d.withColumn("batch_id", F.floor(F.col("sample_idx") / batch).cast("long"))
             .withColumn("batch_pos", (F.col("sample_idx") % batch).cast("int")))


def steps_per_epoch(n_rows: int, batch: int = BATCH_SIZE) -> int:
    """Batches per epoch; the short last batch counts."""
    return int(math.ceil(n_rows / batch))


def run_plan(spark: SparkSession, n_rows: int | DataFrame, opts: RunOptions = RunOptions()) -> DataFrame:
    """One row per training step.

    ``global_step`` drives the schedule; ``step`` restarts every epoch.
    ``is_update`` marks an optimizer update (every ``accumulation_steps``);
    steps after the last update of an epoch only add gradient that carries
    into the next epoch (``carries_over``) and is lost after the last one.
    ``is_log``, ``is_save`` and ``is_tagged_save`` follow the intervals."""
    n = n_rows.count() if isinstance(n_rows, DataFrame) else int(n_rows)
    per = steps_per_epoch(n, opts.batch_size)
    total = per * opts.epochs
    acc = opts.accumulation_steps
    last_update = (per // acc) * acc  # steps >= this carry over
    g = F.col("id")
    df = spark.range(total).select(
        (g / F.lit(per)).cast("int").alias("epoch") if per else F.lit(0).alias("epoch"),
        (g % F.lit(max(per, 1))).cast("long").alias("step"),
        g.alias("global_step"))
    return df.select(
        "epoch", "step", "global_step",
        F.lit(per).cast("long").alias("steps_per_epoch"),
        learning_rate(F.col("global_step"), total, opts.learning_rate, opts.warmup_iters).alias("lr"),
        ((F.col("step") + 1) % acc == 0).alias("is_update"),
        (F.col("step") % opts.log_interval == 0).alias("is_log"),
        ((F.col("step") + 1) % opts.save_interval == 0).alias("is_save"),
        ((F.col("step") + 1) % opts.tagged_save_interval == 0).alias("is_tagged_save"),
        (F.col("step") >= F.lit(last_update)).alias("carries_over"),
    )


def update_numbers(steps: DataFrame, per_epoch: int, opts: RunOptions = RunOptions(),
                   epoch: str = "epoch", step: str = "step", out: str = "update_no") -> DataFrame:
    """Adds the number (from 0) of the optimizer update that uses each step's gradient,
    null where none does. Updates fall on every ``accumulation_steps``-th step of an epoch;
    gradients of the steps behind an epoch's last update carry over into the first update
    of the next epoch, and those behind the last epoch's are lost. The number of updates
    before a step has a closed form, so there is no window over the steps."""
    updates = per_epoch // opts.accumulation_steps  # of an epoch
    number = F.col(epoch) * F.lit(updates) + F.floor(F.col(step) / F.lit(opts.accumulation_steps))
    return steps.withColumn(out, F.when(number < updates * opts.epochs, number.cast("long")))


def progress(metrics: DataFrame, steps_per_epoch_col: str = "steps_per_epoch",
             step: str = "step", spent: str = "spent_sec") -> DataFrame:
    """Minutes left estimate per logged step:
    ``(spent/(step+1)*steps) // 60 - spent // 60``."""
    s = F.col(spent).cast("double")
    return metrics.withColumn(
        "minutes_left",
        F.floor(s / (F.col(step) + 1) * F.col(steps_per_epoch_col) / 60) - F.floor(s / 60))
