"""Session helper and the shared folder that written tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def get_session(app: str = "tocsin", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with adaptive execution. On a cluster leave ``master`` unset."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. A cluster
    session without it is refused: a machine-local folder would not survive
    the loss of its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tocsin-")
    return _local_roots[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call gets."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored_once(df: DataFrame, label: str) -> DataFrame:
    """Written to a new path under the shared folder and read back: computed once for
    several uses, also when an executor is lost."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *actions: Callable[[], object]) -> list:
    """Run independent actions side by side, so that small jobs overlap on the
    cluster. Results come in order; the first failure is raised once all are done."""
    with ThreadPoolExecutor(len(actions)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [job.result() for job in waiting]
