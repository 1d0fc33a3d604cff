"""Sinks: chunk and message JSONL, training samples, metrics, generations.

Durability comes from the task commit protocol of each write; no periodic
flushing is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import few_listing_tasks


def write_chunks(df: DataFrame, path: str, text_col: str = "text", mode: str = "overwrite") -> None:
    """One ``{"text": chunk}`` object per line, raw Unicode."""
    df.select(F.col(text_col).alias("text")).write.mode(mode).json(path)


def messages_json(col: str = "messages"):
    """JSON array text of a messages column; null content is kept as null."""
    return F.to_json(F.col(col), {"ignoreNullFields": "false"})


def write_messages(df: DataFrame, path: str, col: str = "messages", mode: str = "overwrite") -> None:
    """One JSON array of ``{role, content}`` per line."""
    df.select(messages_json(col).alias("value")).write.mode(mode).text(path)


def write_samples(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: str | None = "epoch") -> None:
    """Samples ``(sample_id, x, y, loss_mask, ...)`` to parquet, partitioned by
    epoch when present and sorted by batch inside each file."""
    w = df
    if "batch_id" in df.columns:
        w = w.sortWithinPartitions("batch_id")
    writer = w.write.mode(mode)
    if partition_by and partition_by in df.columns:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


#: batches of a file: about 150 MB of samples of 511 positions
BATCHES_PER_FILE = 512


def write_batch_files(df: DataFrame, path: str, batches_per_file: int = BATCHES_PER_FILE, mode: str = "overwrite",
                      build: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Samples with ``epoch, batch_id, batch_pos`` laid out for a loader: under
    ``path/samples`` one file for every ``batches_per_file`` consecutive batches of an epoch,
    sorted by batch and place, and under ``path/index`` the file of every batch
    ``(epoch, batch_id, file, n_samples)``, which is returned. A batch is in one file only:
    its samples share the task that writes it, and the files' size is a parameter.

    With ``build`` the rows of ``df`` hold what samples are made from, such as texts, and the
    tasks that write make them: ``build`` maps every row by itself and keeps all columns that
    it does not read, so that texts are shuffled and sorted, not ids of many times their size."""
    spark = df.sparkSession
    part = F.floor(F.col("batch_id") / batches_per_file).cast("long")
    # a number of tasks, or few bytes of texts would get few tasks: files to write are what they cost
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    laid = df.withColumn("part", part).repartition(tasks, "epoch", "part").sortWithinPartitions("epoch", "part", "batch_id", "batch_pos")
    made = build(laid) if build else laid
    made.write.mode(mode).partitionBy("epoch", "part").parquet(f"{path}/samples")
    back = read_batch_files(spark, path)
    index = (back.select("epoch", "batch_id", F.col("_metadata.file_path").alias("file"))
             .groupBy("epoch", "batch_id", "file").agg(F.count(F.lit(1)).alias("n_samples")))
    index.write.mode(mode).parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_batch_files(spark: SparkSession, path: str) -> DataFrame:
    """All samples of ``write_batch_files``, in no order."""
    with few_listing_tasks(spark):
        return spark.read.parquet(f"{path}/samples")


def read_batch(spark, path: str, epoch: int, batch_id: int) -> DataFrame:
    """One batch of ``write_batch_files``, in order: opens the one file that the index names."""
    rows = spark.read.parquet(f"{path}/index").where((F.col("epoch") == epoch) & (F.col("batch_id") == batch_id)).collect()
    files = [r["file"] for r in rows]
    if not files:
        return read_batch_files(spark, path).limit(0)
    return (spark.read.option("basePath", f"{path}/samples").parquet(*files)
            .where(F.col("batch_id") == batch_id).drop("part").orderBy("batch_pos"))


def append_metrics(df: DataFrame, path: str) -> None:
    """Append rows to a metrics table (parquet)."""
    df.write.mode("append").parquet(path)


def write_generations(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
