"""Session helpers: settings, staged intermediate tables and checked broadcasts."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds under which a lookup table is hinted as broadcast: rows, and bytes of its values.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Folder per local application whose session names none.
_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("logloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for staged tables and checkpoints: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster the
    folder must be one that every executor reaches, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    app = spark.sparkContext.applicationId
    if app in _LOCAL_DIRS:
        return _LOCAL_DIRS[app]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _LOCAL_DIRS.setdefault(app, tempfile.mkdtemp(prefix="logloom-"))


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{shared_dir(spark)}/logloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged. Only for the end of a job: its results are gone then."""
    drop_path(spark, f"{shared_dir(spark)}/logloom/{spark.sparkContext.applicationId}")


def stage_at(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), **options: str) -> tuple[DataFrame, str]:
    """``stage`` with the folder, for a caller that drops it with ``drop_path`` once a later table replaces it."""
    path = new_dir(df.sparkSession, label)
    df.write.partitionBy(*partition_by).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage for iterative jobs, survives lost executors, and gives the planner true sizes.
    """
    return stage_at(df, label, partition_by)[0]


def drop_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs, which stay until the driver happens to collect its garbage."""
    # Events that listeners have not read yet still hold the plans of their queries.
    with contextlib.suppress(Py4JJavaError):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    gc.collect()
    spark._jvm.System.gc()


def _value_bytes(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        column = F.to_json(F.struct(column))
    elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16)
    return F.coalesce(F.octet_length(column), F.lit(0)) + 16


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` as broadcast when it has at most ``rows`` rows and ``size`` bytes of values.

    Beyond that the plain table is returned and the join shuffles, with adaptive skew
    splitting for hot keys. The size comes from an aggregate that combines per task; ``df`` should
    be cheap to compute, as it is measured here.
    """
    total = sum((_value_bytes(f) for f in df.schema.fields), F.lit(0)).cast("bigint")
    found, used = df.agg(F.count("*"), F.coalesce(F.sum(total), F.lit(0))).first()
    return F.broadcast(df) if found <= rows and used <= size else df
