"""Session helpers: local sessions for tests/bench and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


HUGE_METHODS = "-XX:-DontCompileHugeMethods"

#: Bytes of a method from which HotSpot interprets it, unless it is started with HUGE_METHODS.
JIT_LIMIT = 8000


def compilable(spark: SparkSession) -> None:
    """Let Spark split what would be a method beyond JIT_LIMIT, as a projection of all columns is; a lower limit of the session stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > JIT_LIMIT:
        spark.conf.set(name, str(JIT_LIMIT))


@contextmanager
def counted_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of what runs inside end by their rows (``maxRecordsPerBatch``) alone, for rows of numbers and short keys.

    Spark otherwise sums the bytes of all columns at every row, which took a third to a half of such passes. Where rows
    aren't limited, the limit of bytes stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(name, None)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 0:
        yield
        return
    spark.conf.set(name, str(2 ** 31 - 1))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, was)


def local_session(cores: int | str = "*", app: str = "pluvio",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off).

    Only for tests and the bench: a checkpoint folder is created under the
    system temp dir when the session has none, which is never done on a
    cluster (there ``spark.checkpoint.dir`` names the shared folder).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PLUVIO_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Wide projections/aggregates generate methods above the JVM's 8 KB
        # JIT limit; without this flag they run interpreted (~5x slower).
        .config("spark.driver.extraJavaOptions", HUGE_METHODS)
        .config("spark.executor.extraJavaOptions", HUGE_METHODS)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local=True)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, allow_local: bool = False) -> str | None:
    """Return the session's checkpoint folder, wiring ``spark.checkpoint.dir``.

    The folder comes from the session (``spark.checkpoint.dir``). Only when it
    is unset and ``allow_local`` is true (tests, bench) is a fresh temp folder
    created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if allow_local:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pluvio-ckpt-"))
        return sc.getCheckpointDir()
    return None


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; an error where it names none."""
    found = ensure_checkpoint_dir(spark, allow_local=spark.sparkContext.master.startswith("local["))
    if not found:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return found


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage at a stage boundary so lost executors do not replay it.

    Writes Parquet into the session's checkpoint folder and reads it back, so
    readers prune columns and push filters down. When the session names no folder,
    falls back to a disk-backed persist (recomputed from lineage on loss) rather
    than inventing a machine-local one. :func:`stages` releases what was stored.
    """
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if folder:
        path = f"{folder.rstrip('/')}/pluvio-stage-{uuid.uuid4().hex}"
        _own(lambda: _delete(spark, path))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _own(lambda: out.unpersist(blocking=True))
    out.count()
    return out


#: Releases of the open scopes, innermost last.
_SCOPES: list[list[Callable[[], object]]] = []


def _own(release: Callable[[], object]) -> None:
    if _SCOPES:
        _SCOPES[-1].append(release)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def stages() -> Iterator[None]:
    """Release every stage that is stored inside, on errors too.

    For callers that use up a result before they leave: a frame built inside
    reads the stored files, so it can't be executed afterwards. Scopes nest; each
    owns what is stored while it is the innermost. Stages stored outside any scope
    stay until the session's folder is cleared.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for release in reversed(_SCOPES.pop()):
            release()
