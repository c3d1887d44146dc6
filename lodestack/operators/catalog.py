"""Queries over the model index, revisions and usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def search_models(models: DataFrame, format: str | None = None, architecture: str | None = None, quantization: str | None = None, min_params: int | None = None, max_params: int | None = None, q: str | None = None) -> DataFrame:
    """Conjunction of the given filters; a falsy argument is no filter. Bounds are inclusive, q is a substring of the name in any case."""
    for column, value in (("format", format), ("architecture", architecture), ("quantization", quantization)):
        models = models.filter(F.col(column) == value) if value else models
    models = models.filter(F.col("parameter_count") >= min_params) if min_params else models
    models = models.filter(F.col("parameter_count") <= max_params) if max_params else models
    return models.filter(F.contains(F.lower("name"), F.lit(q.lower()))) if q else models


def page(rows: DataFrame, order: list, number: int = 1, size: int = 25) -> DataFrame:
    """One page in a total order; pages count from 1."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def facets(models: DataFrame) -> DataFrame:
    """One row: sorted distinct formats, architectures and quantizations."""
    return models.agg(*[F.array_join(F.array_sort(F.collect_set(c)), ",").alias(f"{c}s") for c in ("format", "architecture", "quantization")])


def newest_first(revisions: DataFrame, by: str) -> DataFrame:
    """Adds rank by created (as text, missing last), then revision, both descending, and latest: the first row with a created time."""
    order = Window.partitionBy(by).orderBy(F.coalesce("created", F.lit("")).desc(), F.col("revision").desc())
    return revisions.withColumn("rank", F.row_number().over(order)).withColumn("latest", (F.col("rank") == 1) & F.col("created").isNotNull())


def probe_report(parts: DataFrame) -> DataFrame:
    """Per report (parts with idx, ms, bytes): throughput in decimal MB/s, slowest part (first of ties), and whether the
    later half of four parts or more runs below half the earlier one's mean speed."""
    mbps = F.when(F.col("ms") > 0, F.col("bytes") / 1e6 / (F.col("ms") / 1000)).otherwise(0.0)
    half = F.floor(F.count("*").over(Window.partitionBy("report")) / 2)
    rows = parts.withColumn("mbps", mbps).withColumn("n", F.count("*").over(Window.partitionBy("report"))).withColumn("early", F.col("idx") < half)
    rows = rows.groupBy("report").agg(
        F.count("*").alias("n_parts"),
        F.max(F.struct("ms", (-F.col("idx")).alias("i"))).alias("worst"),
        F.sum("bytes").alias("bytes"),
        F.sum("ms").alias("ms"),
        F.avg(F.when(F.col("early"), F.col("mbps"))).alias("a"),
        F.avg(F.when(~F.col("early"), F.col("mbps"))).alias("b"),
    )
    total = F.when(F.col("ms") > 0, F.col("bytes") / 1e6 / (F.col("ms") / 1000)).otherwise(0.0)
    slower = (F.col("n_parts") >= 4) & (F.coalesce("a", F.lit(0.0)) > 0) & (F.coalesce("b", F.lit(0.0)) < 0.5 * F.col("a"))
    return rows.select("report", "n_parts", F.round(total, 6).alias("mbps"), (-F.col("worst.i")).alias("slowest"), slower.alias("slows_down"))


def versions(rows: DataFrame, by: str, order: str, name: str, newest: int) -> DataFrame:
    """(by, versions, newest): how many rows each group has, and the names of the newest of them."""
    place = Window.partitionBy(by).orderBy(F.desc(order))
    rows = rows.withColumn("_k", F.row_number().over(place))
    first = F.array_sort(F.collect_list(F.when(F.col("_k") <= newest, F.struct("_k", name))))
    return rows.groupBy(by).agg(F.count("*").alias("versions"), first.alias("f")).select(by, "versions", F.array_join(f"f.{name}", "|").alias("newest"))


def latest(rows: DataFrame, by: str, order: list[str], most: int) -> DataFrame:
    """The last `most` rows of each group by these columns."""
    place = Window.partitionBy(by).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_k", F.row_number().over(place)).filter(F.col("_k") <= most).drop("_k")


def parallel_throughput(parts: DataFrame) -> DataFrame:
    """(report, survivors, failed, mbps) of parts (report, bytes, ms) that ran side by side; a failed part has null bytes."""
    rows = parts.groupBy("report").agg(F.count("bytes").alias("survivors"), F.count_if(F.col("bytes").isNull()).alias("failed"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.max("ms").alias("wall"))
    return rows.select("report", "survivors", "failed", F.round(F.when(F.col("wall") > 0, F.col("b") / 1e6 / (F.col("wall") / 1000)).otherwise(0.0), 6).alias("mbps"))
