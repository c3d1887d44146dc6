"""Helpers shared by the training-data operators: tables, the shared folder, cutting lineage, ranges of an order."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the one given to setCheckpointDir().

    Only a local session that names none gets a folder of its own; a cluster without one is refused, as executors would
    write to their own disks what others must read.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="spark-"))
    return _OWN[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lodestack/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: later jobs neither recompute it nor need the executors that made it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove(*tables: DataFrame) -> None:
    """Delete tables written by cut() that no later job reads."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            delete(df.sparkSession, folder)


def free_name(columns: list[str], wanted: str) -> str:
    """A column name that none of these has, in any case."""
    taken, name = {c.lower() for c in columns}, f"_{wanted}"
    while name in taken:
        name += "_"
    return name


def held_out(doc_id) -> F.Column:
    """Rows that no model learns from: crc32 of the id as text, mod 4, is 2. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def ranged(rows: DataFrame, order: list[Column], name: str, rows_a_range: int = 20_000) -> DataFrame:
    """The rows written in ascending ranges of `order`, numbered by `_range`; read back without a given order inside a range.

    The number of ranges grows with the table, so no task takes more than its share of the rows; end `order` with a
    column that tells rows apart, so that ties are split too.
    """
    n = max(1, -(-rows.count() // rows_a_range))
    return cut(rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), name)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from stage to stage, and what they hold counts as the executor's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc's; others keep less
        ctypes.CDLL(None).malloc_trim(0)


def batches(it: Iterator, max_bytes: int, column: str = "text") -> Iterator:
    """Cut Arrow batches to whole rows of about max_bytes of text, which bounds the memory of what follows."""
    from .kernels import text_buffer

    give_back()  # what the worker's earlier tasks left
    for batch in it:
        if batch.num_rows == 0:
            continue
        _, offsets = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(offsets.searchsorted(offsets[at] + max_bytes, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end
