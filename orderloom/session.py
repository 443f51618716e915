"""Session helpers: UTC time, ANSI casts, AQE, and a reliable checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "orderloom", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, pass your own session instead."""
    scratch = tempfile.mkdtemp(prefix="orderloom-checkpoint-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", scratch)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are epoch seconds; every date derived from them is a UTC date."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back to a temporary one in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="orderloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, prefix: str = "table") -> str:
    """A path that does not exist yet, below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{prefix}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared checkpoint folder and read it back as a table.

    Lineage ends here, so a lost executor costs no recomputation of what came before. Unlike an RDD
    checkpoint the table is columnar, readers prune columns, and its size is known to the optimizer.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside go when a query ends, not when the driver happens to collect garbage.

    For queries that write a table: nothing reads their shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def packed(df: DataFrame) -> DataFrame:
    """As `stored`, for steps of large tables: packed tighter, and without the shuffle files of the step afterwards."""
    path = scratch_path(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcasts(df: DataFrame) -> bool:
    """Whether Spark broadcasts `df` to its join partner without a hint, by its measured size."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


#: Rows of one task where rows are dealt by count.
TASK_ROWS = 250_000


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks of `TASK_ROWS` for so many rows, and one for every core at least."""
    return max(-(-rows // TASK_ROWS), spark.sparkContext.defaultParallelism)


def dealt(df: DataFrame, *keys: str, rows: int) -> DataFrame:
    """`df` dealt by `keys` into tasks of `TASK_ROWS`, where `rows` are all rows of it or of what it is joined to."""
    return df.repartition(task_count(df.sparkSession, rows), *keys)
