"""Session settings and the shared folder used to cut lineage and to stage tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A session for tests and for the bench, with ``shared`` as its checkpoint folder; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fieldbook")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
    )
    for key, value in {**SETTINGS, **({"spark.checkpoint.dir": shared} if shared else {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors do not
    share the driver's disk, so an unset folder is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="fieldbook-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder, one per call."""
    return f"{shared_folder(spark).rstrip('/')}/fieldbook/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that a lost executor cannot change it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as compressed Parquet in the shared folder and read again; a checkpoint of many rows takes several times the disk."""
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Rows of a training table that one task reads at least, and at most: an iteration over fewer costs more in starting tasks than
#: in work. In between there are as many tasks as cores, since every task of a forest sends the figures of all nodes.
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 50_000, 500_000


def training_tasks(rows: int, cores: int) -> int:
    return 1 if rows <= ROWS_PER_TASK else max(cores, -(-rows // MOST_ROWS_PER_TASK))


def dealt(df: DataFrame, tasks: int) -> DataFrame:
    """The rows of ``df`` in so many tasks, the same rows in the same order on every run."""
    place = F.xxhash64(*df.columns)
    return df.repartition(tasks, place).sortWithinPartitions(place)


def spread(df: DataFrame) -> DataFrame:
    """``df`` materialised, over as many tasks as training takes where its files have fewer splits. A small file is one split
    whatever its rows, and all that follows without a shuffle would stay in that one task."""
    kept = cut_lineage(df)
    tasks = training_tasks(kept.count(), df.sparkSession.sparkContext.defaultParallelism)
    return kept if kept.rdd.getNumPartitions() >= tasks else cut_lineage(dealt(kept, tasks))


def in_new_session(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read by a session of its own.

    A classifier's training summary keeps the session it was fitted in, and a session that has observed metrics cannot be sent
    to tasks; models fitted on this frame can be. A table of fewer splits than training takes tasks is dealt out.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    rows = df.sparkSession.newSession().read.schema(df.schema).parquet(folder)
    tasks = training_tasks(rows.count(), df.sparkSession.sparkContext.defaultParallelism)
    return cut_lineage(dealt(rows, tasks)) if rows.rdd.getNumPartitions() < tasks else rows.coalesce(tasks)


#: Models that are fitted at once: a fit is a long row of short jobs, most of whose time goes into starting them.
FITS_AT_ONCE = 4


def side_by_side(spark: SparkSession, work: Sequence[Callable]) -> list:
    """What each function of ``work`` returns, in that order, some of them running at once; the first error is raised."""
    from pyspark import inheritable_thread_target

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(w)) for w in work]]


#: Rows of a few numbers that may be broadcast; a larger table is joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def if_small(df: DataFrame) -> DataFrame:
    """``df``, which must be cheap to count, marked for broadcast where it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, joined by a shuffle. The planner's sizes come from files and miss the rows and columns that functions add, so it
    would collect such a table in the driver and leave the other side in the few tasks that read it."""
    return df.hint("merge")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
