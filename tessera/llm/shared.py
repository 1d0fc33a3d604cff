"""Written tables, size-checked broadcasts and connected components.

Intermediate tables are Parquet folders under the session's checkpoint folder
(``spark.checkpoint.dir``), which driver and executors share: lineage ends
there, and a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, ship_package, small_batches

#: a side is broadcast only after its row count times its row width is known to be below this
BROADCAST_BYTES = 32 << 20


#: bytes of rows handed to a Python worker at once
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers, and keep Arrow batches of long texts small
    unless the session already asks for smaller ones."""
    ship_package(spark)
    small_batches(spark, BATCH_BYTES)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    prepare(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back with its own schema."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a ``written`` table that nothing reads any more, so that it takes
    no disk while the steps behind it run. Nothing lazy may still refer to ``df``. Spark
    removes the shuffle files of finished steps when the driver collects their plans,
    which a driver with room may put off until the job ends: so it is asked to here."""
    jvm = df.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("tessera-"):
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    jvm.System.gc()


def small_enough(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (a written table) marked for broadcast if it is known to be small,
    else as it is, for a shuffle join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table: (node, component = smallest node).

    Alternating large-star and small-star rounds; each round groups by node with
    map-side minima, so a hub costs one row a task, and is written to the shared
    folder. Nodes without an edge are not returned.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    while True:
        many = e.groupBy("u").count().where("count > 1").select("u").limit(1)
        chained = e.select(F.col("v").alias("u")).join(e.select("u"), "u", "left_semi").limit(1)
        if not many.unionAll(chained).take(1):
            break
        sym = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        e = written(small.where("u <> v").distinct(), "edges")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
