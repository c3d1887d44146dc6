"""Registered queries of streams, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import chunking, sinks
from ..sources import corpus
from ..streaming import stateful
from .reference import _CHUNKS, _PLAN, CHUNK, PACK, _chunks, _planned, query


def _in_batches(rows: DataFrame, batches: int, by: Column, state: Callable[[DataFrame], DataFrame], mode: str = "append") -> DataFrame:
    """What a stateful stream gives if the rows come in so many batches, by a number from 0. The stream ends after each and goes on from its checkpoint."""
    spark = rows.sparkSession
    whole, source, out, checkpoint = (sinks.scratch(spark, name) for name in ("rows", "stream", "out", "checkpoint"))
    numbered = rows.withColumn("_by", by.cast("int"))
    numbered.write.partitionBy("_by").parquet(whole)  # else each batch makes all rows again
    for k in range(batches):
        spark.read.schema(numbered.schema).parquet(whole).filter(F.col("_by") == k).drop("_by").write.mode("append").parquet(source)
        made = stateful.run_all(state(spark.readStream.schema(rows.schema).parquet(source)), out, checkpoint, mode)
    return made


@query(f"WITH RECURSIVE {_PLAN} SELECT file_id, pack_idx, sum(size)::BIGINT AS size, count(*) AS n_chunks FROM w WHERE pack_idx IS NOT NULL GROUP BY ALL")
def t03_streamed_packs(spark, d):
    """Packs given as soon as they are complete by a stateful stream, whose chunks come in three batches out of order; in the end, all of the plan."""
    new = _planned(spark, d).filter("pack_idx is not null")
    order = Window.partitionBy("file_id").orderBy("chunk_idx")
    place = F.row_number().over(order) - 1
    rows = new.select("file_id", place.cast("long").alias("chunk_idx"), "size", F.lead("size").over(order).isNull().alias("last"))
    return _in_batches(rows, 3, F.col("chunk_idx") * 7 % 3, lambda stream: stateful.stream_packs(stream, PACK))


@query(f"""WITH {_CHUNKS}, e AS (SELECT h.file_id, "offset" AS o, "offset" + size AS stop, chunk_idx, octet_length(content)::BIGINT AS total FROM h JOIN f USING (file_id) WHERE (h.file_id + chunk_idx) % 7 <> 5),
b AS (SELECT DISTINCT file_id, (file_id + chunk_idx) * 5 % 3 AS batch, total FROM e),
s AS (SELECT b.file_id, b.batch, b.total, e.o, e.stop FROM b JOIN e ON e.file_id = b.file_id AND (e.file_id + e.chunk_idx) * 5 % 3 <= b.batch),
g AS (SELECT *, coalesce(max(stop) OVER (PARTITION BY file_id, batch ORDER BY o, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS covered FROM s)
SELECT file_id, batch::INTEGER AS batch, coalesce(min(covered) FILTER (o > covered), max(stop))::BIGINT AS watermark, count(*) FILTER (o > covered) AS waiting, coalesce(min(covered) FILTER (o > covered), max(stop)) = any_value(total) AND count(*) FILTER (o > covered) = 0 AS whole FROM g GROUP BY file_id, batch""")
def t04_streamed_watermark(spark, d):
    """How far each file is covered after each batch of extents, some of which never come."""
    files = corpus.files(spark, d).withColumn("total", F.octet_length("content").cast("long"))
    rows = chunking.fixed_chunks(files, CHUNK, ("total",)).filter("(file_id + chunk_idx) % 7 <> 5").select("file_id", "chunk_idx", "offset", "size", "total")
    return _in_batches(rows, 3, (F.col("file_id") + F.col("chunk_idx")) * 5 % 3, stateful.stream_watermark, "update")


@query(f"WITH {_CHUNKS} SELECT 'batch' AS kind, count(*) AS rows FROM h UNION ALL SELECT 'done', 1")
def t01_bounded_stream(spark, d):
    """What a stream that ends gives: all rows in its batches, then once that it is done."""
    source = sinks.scratch(spark, "stream")
    rows = _chunks(spark, d).select("file_id", "chunk_idx", "size")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 64).parquet(source)
    said = stateful.Bounded(stream, sinks.scratch(spark, "checkpoint")).run(lambda batch: None)
    events = spark.createDataFrame(said, "kind string, n long")  # a row a batch
    return events.groupBy("kind").agg(F.when(F.col("kind") == "batch", F.sum("n")).otherwise(F.count("*")).alias("rows"))
