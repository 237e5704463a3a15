"""Session helpers and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "textloom", cores: str | int = "*", partitions: int = 8,
                  memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. Cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in
    ``spark.checkpoint.dir``. Only a local session may fall back to a temporary one."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="textloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


_MADE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    own = f"{shared_root(spark).rstrip('/')}/textloom-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(own)
    return f"{own}/{name}"


@contextlib.contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Removes on leaving what was written to scratch paths inside. Results that read them must be written by then,
    to a path taken outside."""
    held = _MADE.set([])
    try:
        yield
    finally:
        for path in _MADE.get():
            remove(spark, path)
        _MADE.reset(held)


DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet. The shuffle files of its plan go when it stands; else they stay on the executors' disks until
    the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(DROPS_SHUFFLES, "false")
    conf.set(DROPS_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(DROPS_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, short lineage,
    survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` makes, written; all that was written on the way is removed."""
    path = scratch_path(spark, name)
    with scratch_tables(spark):
        df = make()
        write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path this package has written."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
