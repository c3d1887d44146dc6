"""Stores that are written by digest: a blob is written once, however often it comes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, or in a local session without one, a local one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(shared or 'file://' + tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/lodestack/{name}-{uuid.uuid4().hex}"


def write_missing(blobs: DataFrame, path: str, batch: str) -> None:
    """Append the blobs (digest, content) whose digest the store lacks, one of each digest.

    A batch lies in a folder of its own, which is written as a whole: a batch tried again takes the place of what an
    attempt that failed left.
    """
    spark = blobs.sparkSession
    schema = StructType().add("digest", StringType()).add("content", BinaryType()).add("batch", StringType())
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(hadoop):
        there = spark.read.schema(schema).parquet(path).filter(F.col("batch") != batch)
        blobs = blobs.join(there.select("digest"), "digest", "left_anti")
    blobs.select("digest", "content").dropDuplicates(["digest"]).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def write_cache(files: DataFrame, path: str) -> None:
    """Store files (repo, revision, title, digest, content): the bytes once by digest, and a snapshot's entries beside them.

    Content that doesn't have its digest is not written, nor is its entry. Snapshots lie in folders by repository and
    revision, so that a look-up reads those only.
    """
    sound = files.filter(F.sha2("content", 256) == F.col("digest"))
    write_missing(sound.select("digest", "content"), f"{path}/blobs", "first")
    sound.select("repo", "revision", "title", "digest").write.partitionBy("repo", "revision").mode("overwrite").parquet(f"{path}/snapshots")


def look_up(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """Adds `digest` of the cached file to (repo, revision, title); null where the cache has none."""
    entries = spark.read.parquet(f"{path}/snapshots")
    kinds = dict(asked.dtypes)
    entries = entries.select(F.col("repo").cast(kinds["repo"]).alias("repo"), F.col("revision").cast(kinds["revision"]).alias("revision"), "title", "digest")
    return asked.join(entries, ["repo", "revision", "title"], "left")


COMMITS = "repo string, revision string, manifest string, place long"


def current(spark: SparkSession, path: str) -> DataFrame:
    """(repo, revision, manifest, place): the last committed manifest of each repository."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], COMMITS)
    last = F.max_by(F.struct("revision", "manifest", "place"), "place").alias("c")
    return spark.read.schema(COMMITS).parquet(path).groupBy("repo").agg(last).select("repo", "c.*")


def commit(asked: DataFrame, path: str) -> DataFrame:
    """Commit manifests (repo, expected, revision, manifest) to a log; returns (repo, revision, outcome).

    A commit is taken if it expects nothing or the repository's current revision; of several in one call for one
    repository the first by revision is, and the others are in conflict with it. The log is only added to, one call
    after the other.
    """
    spark = asked.sparkSession
    now = current(spark, path).select("repo", F.col("revision").alias("_now"), "place")
    rows = asked.join(now, "repo", "left").withColumn("fits", F.col("expected").isNull() | F.coalesce(F.col("expected") == F.col("_now"), F.lit(False)))
    first = Window.partitionBy("repo", "fits").orderBy("revision")
    rows = rows.withColumn("taken", F.col("fits") & (F.row_number().over(first) == 1))
    out = scratch(spark, "outcomes")
    rows.select("repo", "revision", "manifest", (F.coalesce("place", F.lit(0)) + 1).alias("place"), "taken").write.parquet(out)  # decided once, before the log changes
    decided = spark.read.parquet(out)
    decided.filter("taken").select("repo", "revision", "manifest", "place").write.mode("append").parquet(path)
    return decided.select("repo", "revision", F.when(F.col("taken"), "committed").otherwise("conflict").alias("outcome"))
