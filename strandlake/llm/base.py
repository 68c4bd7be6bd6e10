"""Shared helpers: Arrow batches, stored tables, word rules and column names."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strandlake
from strandlake.session import RUNTIME_SETTINGS, scratch_path

#: Rows of one Arrow batch: whole texts go to Python in small batches, so that a worker's memory stays bounded.
BATCH_ROWS = 256

#: The words of all contracts are runs of bytes other than 0x20 and 0x09-0x0D, which is what bytes.split() gives.
ASCII_LOWER = bytes(range(256)).lower()


def ship_code(spark: SparkSession) -> None:
    """Give this package's modules to the executors' Python workers, which may run where it is not installed."""
    context = spark.sparkContext
    if getattr(context, "_strandlake_shipped", False):
        return
    root = Path(strandlake.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="strandlake-code-")) / "strandlake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(archive))  # Spark sends it to every executor, later ones too
    context._strandlake_shipped = True


def prepare(spark: SparkSession) -> None:
    """Code and session settings that the operators of this subpackage rely on."""
    ship_code(spark)
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Larger Arrow batches for what is run inside, where rows are a few numbers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, str(BATCH_ROWS))


_scopes: list[Intermediate] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: each row is made once and the lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    if _scopes:
        _scopes[-1].paths.append(path)
        _scopes[-1].of[id(back)] = (back, path)
    return back


class Intermediate:
    """``with Intermediate(spark) as tables``: tables that are stored inside go at its end, but for those given to
    ``tables.keep``. What is returned must not read any other, as it is evaluated later."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.of = spark, [], {}

    def __enter__(self) -> Intermediate:
        _scopes.append(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        _, path = self.of[id(df)]
        self.paths.remove(path)
        if len(_scopes) > 1:  # the scope around this one decides
            _scopes[-2].paths.append(path)
            _scopes[-2].of[id(df)] = (df, path)
        return df

    def __exit__(self, *_) -> None:
        _scopes.pop()
        for path in self.paths:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty), other columns only where named."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a whole text."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def words_of(text: str) -> list[bytes]:
    return text.encode().split()
