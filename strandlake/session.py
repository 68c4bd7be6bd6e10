"""Session settings, table access and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "strandlake", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on; extra settings by keyword with ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


class Tables:
    """Lazy access to the Parquet tables of one folder: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        for key, value in RUNTIME_SETTINGS.items():
            spark.conf.set(key, value)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def sql(self, text: str, views: tuple[str, ...], args: dict | None = None) -> DataFrame:
        """Run a SQL string with the named tables bound as DataFrames, never as pasted text."""
        frames = {v: getattr(self, v) for v in views}
        return self.spark.sql(text, args=args, **frames)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Without that setting a temporary folder is used in local mode only; on a cluster a
    machine-local folder would not survive a lost executor, so it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="strandlake-ckpt-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts the lineage and survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def join_back(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Per-key values joined to their rows; a NULL key meets the NULL key, as it does in a window.

    Without keys ``per_key`` is one row, broadcast by its known size.
    """
    if not keys:
        return rows.join(F.broadcast(per_key))
    side = per_key.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return rows.join(side, same, how).drop(*[f"_key_{k}" for k in keys])


def computed_once(df: DataFrame, kept: list[str], columns: dict[str, Column]) -> DataFrame:
    """``kept`` and new columns that are computed once per row, however often later conditions and columns use them.

    Spark pushes a condition below a projection by repeating the projection's expressions in it, once for each use; it does
    not push one below a generator, so the columns come from a generator of one row.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def spread(df: DataFrame) -> DataFrame:
    """Give heavy per-row work one task per core when the input has fewer file splits than that.

    A large table has far more splits than cores and is left alone, so nothing is shuffled there.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
