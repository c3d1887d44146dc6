"""Files, JSON rows, manifests, pages and test reports as tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KNOWN_LAYOUTS = ("chunked-v2",)


def walk(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, modified, content) of all files below a folder, path from there with `/`. Only the columns asked for are read, so listing doesn't open a file. Spark's reader passes over files without a byte."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/")
    path = F.regexp_replace("path", "^([a-z]+:)?/*", "/")
    return rows.select(F.substring(path, len(root) + 2, 1 << 30).alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")


def json_rows(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Adds `doc`, the column's JSON by a declared schema; what isn't JSON has null fields only."""
    return rows.withColumn("doc", F.from_json(column, schema, {"mode": "PERMISSIVE"}))


def fetch_manifests(asked: DataFrame, stored: DataFrame, known: tuple[str, ...] = KNOWN_LAYOUTS) -> DataFrame:
    """Each asked (repo, revision) with its manifest and outcome: `ok`, `not found`, or the layout that isn't known. A manifest without a layout is of the plain one."""
    rows = asked.join(stored.select("repo", "revision", "manifest"), ["repo", "revision"], "left")
    layout = F.try_element_at(F.from_json("manifest", "struct<annotations:map<string,string>>")["annotations"], F.lit("chunked.layout"))
    outcome = F.when(F.col("manifest").isNull(), "not found").when(layout.isNull() | layout.isin(*known), "ok").otherwise(F.concat(F.lit("layout "), layout))
    return rows.withColumn("outcome", outcome)


def follow_pages(pages: DataFrame) -> DataFrame:
    """The pages (repo, page, link, ...) that following `next` links from page 1 reaches. A page without such a link, or with one that an earlier page had, is the last."""
    after = F.nullif(F.regexp_extract("link", '<([^>]*)>; *rel="?next"?', 1), F.lit(""))
    rows = pages.withColumn("_next", after)
    again = F.row_number().over(Window.partitionBy("repo", "_next").orderBy("page")) > 1
    rows = rows.withColumn("_stops", (F.col("_next").isNull() | again).cast("int"))
    before = Window.partitionBy("repo").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_stopped", F.coalesce(F.sum("_stops").over(before), F.lit(0)))
    return rows.filter("_stopped = 0").drop("_next", "_stops", "_stopped")


STAGE = "struct<outcome:string,crash:struct<message:string>,longrepr:string>"


def failures(reports: DataFrame, column: str) -> DataFrame:
    """The failed tests of JSON test reports: the report's columns, test, stage (the first of call, setup and teardown
    that failed), message and longrepr of it. A report that can't be read has no tests; a test none of whose stages failed is left out."""
    schema = f"struct<tests:array<struct<nodeid:string,outcome:string,call:{STAGE},setup:{STAGE},teardown:{STAGE}>>>"
    keep = [c for c in reports.columns if c != column]
    tests = json_rows(reports, column, schema).select(*keep, F.explode("doc.tests").alias("t"))
    failed = lambda c: c.isin("failed", "error")
    stage = F.coalesce(*[F.when(failed(F.col(f"t.{s}.outcome")), F.lit(s)) for s in ("call", "setup", "teardown")])
    pick = lambda field: F.coalesce(*[F.when(F.col("stage") == s, F.col(f"t.{s}.{field}")) for s in ("call", "setup", "teardown")])
    rows = tests.filter(failed(F.col("t.outcome"))).withColumn("stage", stage).filter("stage is not null")
    return rows.select(*keep, F.coalesce("t.nodeid", F.lit("unknown")).alias("test"), "stage", pick("crash.message").alias("message"), pick("longrepr").alias("longrepr"))


def in_memory(spark: SparkSession, items: list[tuple[str, object]]) -> DataFrame:
    """(title, content) of things given by the caller: text (as UTF-8), bytes, open binary files, or paths, which Spark reads."""
    given, paths = [], {}
    for title, thing in items:
        if isinstance(thing, os.PathLike):
            paths[title] = os.fspath(thing)
        else:
            raw = thing.read() if hasattr(thing, "read") else thing
            given.append((title, bytearray(raw.encode() if isinstance(raw, str) else raw)))
    rows = spark.createDataFrame(given, "title string, content binary")  # what the caller holds in memory already
    for title, path in paths.items():
        rows = rows.unionByName(spark.read.format("binaryFile").load(path).select(F.lit(title).alias("title"), "content"))
    return rows
