"""Session helpers: sane defaults and a reliable checkpoint location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Built = TypeVar("Built")

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partitions that fit an executor's memory when sorting for windows
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_made: list[str] = []


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "omoplate") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; use it.
    Only a local-mode session (tests, a laptop) without that setting gets a
    private temporary folder. A cluster session without it is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="omoplate-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared checkpoint folder and
    continue from it.

    One job computes the rows once and writes them (a ``checkpoint()``
    would compute them twice unless also persisted); the read-back plan
    has no lineage to replay if an executor is lost. Never a local folder.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(folder)
    _made.append(folder)
    return spark.read.parquet(folder)


def side_by_side(spark: SparkSession, builds: Sequence[Callable[[], Built]], at_a_time: int = 2) -> list[Built]:
    """Run builds that do not need each other, two at a time: the jobs of one fill the cores that another leaves idle
    between its jobs and at their ends. More at a time hold more plans and broadcasts in the driver. Results in order;
    the first error is raised when all have ended."""
    with ThreadPoolExecutor(at_a_time) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(build)) for build in builds]
    return [run.result() for run in runs]


def tables_made() -> int:
    """How many tables ``cut_lineage`` has written in this process and not released."""
    return len(_made)


def release_tables(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables that ``cut_lineage`` has written since ``tables_made()`` was ``since``.

    For the end of a build whose results are written: DataFrames that
    still read those tables fail afterwards. Returns how many went.
    """
    n = 0
    while len(_made) > since:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        n += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return n
