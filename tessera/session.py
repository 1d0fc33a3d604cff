"""Session helpers: building a local session for tests/bench and finding the
reliable checkpoint folder for iterative jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the jobs expect (AQE on, no UI)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in the Python workers.

    The Arrow UDFs are pickled by reference to this package, so the workers
    must import it. On a cluster, install it or pass it with ``--py-files``;
    otherwise this zips the package once per SparkContext and hands it to
    ``SparkContext.addPyFile``, which distributes it with the job."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), "tessera.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


#: bytes of rows handed to a Python worker at once (Spark's own default is 64 MB)
ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


_BATCHES_SET: dict = {}


def small_batches(spark: SparkSession, most: int) -> None:
    """Keep Arrow batches at ``most`` bytes unless the session itself asks for smaller
    ones: what a Python worker holds is a multiple of its batch, whatever the input.
    A value that another operator has set here does not count as the session's."""
    said = str(spark.conf.get(ARROW_BATCH)).rstrip("b")  # the default reads 67108864b
    ours = _BATCHES_SET.get(spark.sparkContext.applicationId) == said
    if ours or not said.isdigit() or int(said) > most:
        spark.conf.set(ARROW_BATCH, str(most))
        _BATCHES_SET[spark.sparkContext.applicationId] = str(most)


#: tasks that list the folders of a partitioned table (Spark's own default is 10000: one a folder)
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Tables read inside list their folders in four tasks a core at most: a task that lists
    one folder costs the driver more than the folder costs the task."""
    said = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(said), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, said)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local-mode session (tests, bench) without the setting gets a
    fresh temporary folder; a cluster session without it is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master == "local" or sc.master.startswith("local["):
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative jobs need a shared, "
        "reliable folder to cut lineage")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, which all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (eager) into the session's checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
