"""Line, message, chunk and prompt sources."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: most bytes of split offsets that are broadcast, bytes of one of them, most ``FILE:`` prompts' files
BROADCAST_BYTES, PLACE_BYTES, MAX_FILES = 64 << 20, 256, 1 << 20
MESSAGES_TYPE = "array<struct<role:string,content:string>>"
CHUNK_SCHEMA = "text string"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the prepared parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """A plain scan dealt by ``keys`` when its files give fewer tasks than there are cores
    (a file of one row group is one task); as it is otherwise. The rows are the same."""
    few = scan.rdd.getNumPartitions() < scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(*keys) if few else scan


def read_lines(spark: SparkSession, path: str, number: bool = False) -> DataFrame:
    """Lines of text files (``\\n``, ``\\r\\n`` and ``\\r`` end a line).

    ``number=True`` adds ``line_id``, the 1-based line number within its file,
    and ``file``. Lines are numbered per input split: each split's first
    monotonically-increasing id gives the position inside the split, and the
    line counts of the earlier splits of the same file give its offset. The
    offset table has one row per input split, a number the scan keeps on the
    driver: below ``BROADCAST_BYTES`` it is broadcast, and no shuffle touches the lines.
    """
    df = spark.read.text(path)
    if not number:
        return df
    base = with_places(df)
    offsets = split_offsets(base)
    rows = len(df.inputFiles()) + df.rdd.getNumPartitions()  # at most one for each file and cut
    offsets = F.broadcast(offsets) if rows * PLACE_BYTES <= BROADCAST_BYTES else offsets
    return (base.join(offsets, ["file", "block"])
            .select("value", "file", _line_id().alias("line_id")))


PLACE = ("file", "block", "mid")


def with_places(lines: DataFrame) -> DataFrame:
    """``(value, file, block, mid)``: each line's input split and its place in the scan."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("mid"))


def split_offsets(placed: DataFrame) -> DataFrame:
    """``(file, block, first_mid, offset)``: a split's first place and the lines of its
    file before it. One row per input split, which the scan itself lists on the driver."""
    stats = placed.groupBy("file", "block").agg(F.min("mid").alias("first_mid"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return stats.select("file", "block", "first_mid", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("offset"))


def _line_id():
    return F.col("offset") + F.col("mid") - F.col("first_mid") + 1


def numbered(placed: DataFrame, offsets: DataFrame) -> DataFrame:
    """``placed`` (some of the lines) with the 1-based ``line_id`` in their file."""
    return (placed.join(offsets, ["file", "block"]).withColumn("line_id", _line_id())
            .drop("block", "mid", "first_mid", "offset"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk JSONL written by ``write_chunks``."""
    return spark.read.schema(CHUNK_SCHEMA).json(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Message JSONL: each line is a JSON array of ``{role, content}``."""
    return spark.read.text(path).select(
        F.from_json("value", MESSAGES_TYPE).alias("messages"))


def read_prompts(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Prompts, one per line, or one per file with ``whole_file=True``.

    ``prompt_id`` is stable: file path plus line position."""
    if whole_file:
        df = spark.read.text(path, wholetext=True)
        return df.select(F.xxhash64(F.col("_metadata.file_path")).alias("prompt_id"),
                         F.col("value").alias("prompt"))
    df = read_lines(spark, path, number=True)
    return df.select(F.xxhash64("file", "line_id").alias("prompt_id"),
                     F.col("value").alias("prompt"))


def expand_file_prompts(spark: SparkSession, prompts: DataFrame, col: str = "prompt",
                        prefix: str = "FILE:") -> DataFrame:
    """Replace prompts written as ``FILE:<path>`` by that file's whole text.

    A task cannot open files named by the data, so the distinct paths (one per
    named file, not per prompt) are listed on the driver, each resolved once to
    the URI that the file source reports, read with
    ``read.text(wholetext=True)`` and joined back on equality of that URI. A
    path that does not name exactly one file is an error."""
    is_file = F.col(col).startswith(prefix)
    path = F.expr(f"substring(`{col}`, {len(prefix) + 1})")
    paths = [r[0] for r in prompts.filter(is_file).select(path).distinct().limit(MAX_FILES + 1).collect()]
    if len(paths) > MAX_FILES:
        raise ValueError(f"more than {MAX_FILES} files are named by prompts")
    if not paths:
        return prompts
    conf = spark._jsc.hadoopConfiguration()
    named = []
    for p in paths:
        hp = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if not fs.exists(hp) or not fs.getFileStatus(hp).isFile():
            raise FileNotFoundError(f"prompt file not found: {p}")
        named.append((p, re.sub("^([^:/]+):/+", r"\1:/", fs.getFileStatus(hp).getPath().toUri().toString())))
    of = spark.createDataFrame(named, "p_ string, fp_ string")
    escaped = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]  # names, not patterns
    texts = (spark.read.text(escaped, wholetext=True)
             .select(F.regexp_replace(F.col("_metadata.file_path"), "^([^:/]+):/+", "$1:/").alias("fp_"),
                     F.col("value").alias("ft_")).distinct())
    keyed = prompts.withColumn("p_", F.when(is_file, path))
    j = keyed.join(of.join(texts, "fp_").select("p_", "ft_"), "p_", "left")
    return (j.withColumn(col, F.when(F.col("p_").isNotNull(), F.col("ft_")).otherwise(F.col(col)))
             .select(*prompts.columns))


def prompts_from_list(spark: SparkSession, prompts: list[str]) -> DataFrame:
    """A prompt table from literal strings (interactive use)."""
    return spark.createDataFrame([(i, p) for i, p in enumerate(prompts)],
                                 "prompt_id long, prompt string")
