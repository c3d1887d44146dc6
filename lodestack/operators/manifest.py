"""Layers of manifests: grouping, titles, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def title_of(title: Column) -> Column:
    """A path with `/`; a missing or empty title is none."""
    return F.nullif(F.replace(title, F.lit("\\"), F.lit("/")), F.lit(""))


def group_files(layers: DataFrame) -> DataFrame:
    """(repo, layer_idx, title, is_chunked, size, digest) of titled layers; others are no files."""
    return layers.withColumn("title", title_of(F.col("title"))).filter("title is not null").select("repo", "layer_idx", "title", (F.col("media_type") == "pointer").alias("is_chunked"), "size", "digest")


def first_titles(files: DataFrame) -> DataFrame:
    """The first file of each title."""
    first = F.min_by(F.struct("layer_idx", "is_chunked", "size", "digest"), "layer_idx").alias("f")
    return files.groupBy("repo", "title").agg(first).select("repo", "title", "f.*")


def positional_groups(layers: DataFrame) -> DataFrame:
    """Adds group_no: a titled layer starts a group, others belong to the one before; those before any title have group 0."""
    order = Window.partitionBy("repo").orderBy("layer_idx").rowsBetween(Window.unboundedPreceding, 0)
    return layers.withColumn("group_no", F.sum(F.when(title_of(F.col("title")).isNotNull(), 1).otherwise(0)).over(order).cast("long"))


def merge_flagged(rows: DataFrame, deleted: list[str]) -> DataFrame:
    """Layers after a commit, from one table of old and new ones (`is_new`) in one pass by repository.

    Old groups stay, as a whole, unless their title is new or deleted; groups without a title stay. The new layers follow.
    """
    whole = Window.partitionBy("repo")
    order = whole.orderBy("layer_idx").rowsBetween(Window.unboundedPreceding, 0)
    path, old = title_of(F.col("title")), ~F.col("is_new")
    rows = rows.withColumn("_title", F.last(F.when(old, path), ignorenulls=True).over(order)).withColumn("_new", F.collect_set(F.when(~old, path)).over(whole))
    gone = F.coalesce(F.array_contains("_new", F.col("_title")) | F.col("_title").isin(deleted), F.lit(False))
    return rows.filter(~old | ~gone).select("repo", "layer_idx", "media_type", "title", "size", "digest", F.when(old, "kept").otherwise("new").alias("origin"))


def glob_regex(pattern: str) -> str:
    """An anchored regular expression for a shell pattern, whose `*` crosses `/`; a pattern that ends in `/` means all below it."""
    import fnmatch

    return "(?s)^" + fnmatch.translate(pattern + "*" if pattern.endswith("/") else pattern).replace("(?s:", "(?:").replace("\\Z", "$").replace("\\z", "$")


def glob_filter(rows: DataFrame, column: str, allow: list[str] | None = None, ignore: list[str] | None = None) -> DataFrame:
    """Rows that match any allowed pattern (if given) and no ignored one."""
    any_of = lambda ps: F.lit(False) if not ps else F.col(column).rlike("|".join(f"(?:{glob_regex(p)})" for p in ps))
    kept = rows if allow is None else rows.filter(any_of(allow))
    return kept.filter(~any_of(ignore or []))
