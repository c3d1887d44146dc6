"""Tables in the shape of content-addressed data, made from the star schema's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: file_id, repo, title, content. A null text is an empty file."""
    d = table(spark, sf_dir, "documents")
    title = F.concat_ws("/", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return d.select(F.col("doc_id").alias("file_id"), F.col("source").alias("repo"), title.alias("title"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as manifest layers: repo (order), layer_idx, media_type, title (missing, empty or a name), size, digest,
    file_offset (the sizes before it). Number and offset come from one window."""
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "repo")  # renamed before the window: what follows by repository is not shuffled again
    order = Window.partitionBy("repo").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    size = F.col("l_quantity").cast("long")
    before = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size
    li = li.withColumns({"layer_idx": (F.row_number().over(order) - 1).cast("long"), "file_offset": before})
    n = F.col("l_linenumber")
    return li.select(  # made after the shuffle, which digests would double
        "repo",
        "layer_idx",
        F.when(n % 3 == 1, "pointer").otherwise("blob").alias("media_type"),
        F.when(n % 4 == 0, F.lit(None)).when(n == 7, "").otherwise(F.concat(F.lit("part\\"), (F.col("l_partkey") % 5).cast("string"))).alias("title"),
        size.alias("size"),
        F.sha2(F.col("l_partkey").cast("string"), 256).alias("digest"),
        "file_offset",
    )


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a model index: project, repo, name, format, architecture, quantization, parameter_count."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), (F.col("p_partkey") % 7).cast("string")).alias("project"),
        F.col("p_partkey").alias("repo"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("format"),
        F.col("p_brand").alias("architecture"),
        F.concat(F.lit("q"), (F.col("p_size") % 5).cast("string")).alias("quantization"),
        (F.col("p_size").cast("long") * 100_000_000).alias("parameter_count"),
    )
