"""Registered queries of integrity checks and small parsers, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import pointers
from ..sources import corpus
from .reference import _CHUNKS, _chunks, query


@query(f"""WITH {_CHUNKS}, e AS (SELECT file_id, "offset" AS o, "offset" + size AS stop FROM h WHERE (file_id + chunk_idx) % 7 <> 5),
g AS (SELECT *, coalesce(max(stop) OVER (PARTITION BY file_id ORDER BY o, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS covered FROM e)
SELECT file_id, coalesce(min(covered) FILTER (o > covered), max(stop))::BIGINT AS watermark, count(*) FILTER (o > covered) AS gaps FROM g GROUP BY file_id""")
def w07_contiguous_watermark(spark, d):
    """How far each file is covered from its start by the extents that arrived, in whatever order."""
    came = _chunks(spark, d).filter("(file_id + chunk_idx) % 7 <> 5").select("file_id", F.col("offset").alias("o"), (F.col("offset") + F.col("size")).alias("stop"))
    before = Window.partitionBy("file_id").orderBy("o", "stop").rowsBetween(Window.unboundedPreceding, -1)
    came = came.withColumn("covered", F.coalesce(F.max("stop").over(before), F.lit(0)))
    gap = F.col("o") > F.col("covered")
    return came.groupBy("file_id").agg(F.coalesce(F.min(F.when(gap, F.col("covered"))), F.max("stop")).cast("long").alias("watermark"), F.count_if(gap).alias("gaps"))


@query(f"""WITH {_CHUNKS}, e AS (SELECT h.file_id, chunk_idx, content, CASE WHEN h.file_id % 13 = 0 THEN reverse(digest) ELSE digest END AS expected, CASE WHEN h.file_id % 13 = 1 THEN "offset" * octet_length(content) ELSE "offset" END AS o, size FROM h JOIN f USING (file_id))
SELECT file_id, o AS "offset", size, CASE WHEN o + size > octet_length(content) THEN 'out of range' WHEN sha256(array_slice(content, o + 1, o + size)) = expected THEN 'sound' ELSE 'differs' END AS status FROM e""")
def x14_verify_chunks(spark, d):
    """Each chunk's slice of the file against the digest it should have; a slice past the end is out of range. A file
    meets the list of its chunks, so its bytes are joined once."""
    files = corpus.files(spark, d).select("file_id", "content", F.octet_length("content").alias("n"))
    chunks = _chunks(spark, d).select("file_id", "chunk_idx", "offset", "size", F.when(F.col("file_id") % 13 == 0, F.reverse("digest")).otherwise(F.col("digest")).alias("digest"))
    chunks = chunks.join(files.select("file_id", "n"), "file_id").withColumn("offset", F.when(F.col("file_id") % 13 == 1, F.col("offset") * F.col("n")).otherwise(F.col("offset")))
    plan = chunks.groupBy("file_id").agg(F.collect_list(F.struct("offset", "size", F.col("offset").alias("file_offset"), "digest")).alias("targets"))
    cut_out = pointers.scatter(plan.withColumn("pack", F.col("file_id")), files.withColumnRenamed("file_id", "pack"))
    return cut_out.select("file_id", F.col("file_offset").alias("offset"), "size", "status")


@query("""WITH h AS (SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages)
SELECT page_id, host, host IN (SELECT host FROM h WHERE page_id % 3 = 0) AS known FROM h""")
def j11_same_host(spark, d):
    """Addresses whose host equals one that has a login; a longer name that holds it does not count."""
    rows = corpus.table(spark, d, "pages").select("page_id", F.regexp_extract(F.lower("url"), "^[a-z]+://([^/:?#]+)", 1).alias("host"))
    logins = rows.filter("page_id % 3 = 0").select("host").distinct().withColumn("known", F.lit(True))
    return rows.join(logins, "host", "left").select("page_id", "host", F.coalesce("known", F.lit(False)).alias("known"))


@query("""WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'bogus' WHEN 1 THEN 'bytes 5/42' WHEN 2 THEN 'bytes ' || event_id || '-' || event_id * 2 || '/*' ELSE 'bytes 0-' || event_id || '/99' END AS r,
CASE event_id % 7 WHEN 0 THEN '0-0' WHEN 1 THEN '0-' || event_id WHEN 2 THEN 'bytes=0-' || event_id WHEN 3 THEN '7- ' || event_id || ' ' WHEN 4 THEN event_id::VARCHAR WHEN 5 THEN '0-9223372036854775807' ELSE 'junk' END AS c FROM events)
SELECT event_id, TRY_CAST(regexp_extract(r, '^bytes ([0-9]+)-([0-9]+)/', 1) AS BIGINT) AS first_byte, TRY_CAST(regexp_extract(r, '^bytes ([0-9]+)-([0-9]+)/', 2) AS BIGINT) AS last_byte,
CASE WHEN n IS NULL OR n = 0 THEN 0 WHEN n = 9223372036854775807 THEN n ELSE n + 1 END AS committed
FROM (SELECT *, TRY_CAST(nullif(regexp_extract(c, '(?:^|-)[ ]*([0-9]+)[ ]*$', 1), '') AS BIGINT) AS n FROM e)""")
def c07_c08_byte_ranges(spark, d):
    """Bounds of a content range (null if malformed), and the bytes that a range header says are committed."""
    i = F.col("event_id")
    text = i.cast("string")
    given = F.when(i % 4 == 0, "bogus").when(i % 4 == 1, "bytes 5/42").when(i % 4 == 2, F.concat(F.lit("bytes "), text, F.lit("-"), (i * 2).cast("string"), F.lit("/*"))).otherwise(F.concat(F.lit("bytes 0-"), text, F.lit("/99")))
    k = i % 7
    held = F.when(k == 0, "0-0").when(k == 1, F.concat(F.lit("0-"), text)).when(k == 2, F.concat(F.lit("bytes=0-"), text)).when(k == 3, F.concat(F.lit("7- "), text, F.lit(" "))).when(k == 4, text).when(k == 5, "0-9223372036854775807").otherwise("junk")
    bound = lambda k: F.regexp_extract(given, "^bytes ([0-9]+)-([0-9]+)/", k).try_cast("bigint")
    return corpus.table(spark, d, "events").select("event_id", bound(1).alias("first_byte"), bound(2).alias("last_byte"), X.committed_bytes(held).alias("committed"))


@query("""WITH r AS (SELECT doc_id, source || '/' || lang || '/' || doc_id AS id FROM documents)
SELECT doc_id, split_part(id, '/', 1) AS project, substr(id, strpos(id, '/') + 1) AS repo, replace(substr(id, strpos(id, '/') + 1), '/', '%2F') AS encoded, 'models--' || replace(id, '/', '--') AS folder FROM r""")
def c13_c15_repository_names(spark, d):
    """Project and repository of an id (split at its first slash), the name as one address part, and the cache folder."""
    ident = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    rows = corpus.table(spark, d, "documents").select("doc_id", ident.alias("id"))
    parts = F.split("id", "/", 2)
    return rows.select("doc_id", parts[0].alias("project"), parts[1].alias("repo"), F.replace(parts[1], F.lit("/"), F.lit("%2F")).alias("encoded"), F.concat(F.lit("models--"), F.replace("id", F.lit("/"), F.lit("--"))).alias("folder"))


@query("""WITH v AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '0.6.0rc1' WHEN 1 THEN o_orderkey || '.5' WHEN 2 THEN '1.2.' || (o_orderkey % 9) ELSE '0.0.0+unknown' END AS t FROM orders),
p AS (SELECT o_orderkey, list_transform(string_split(t, '.'), lambda x: regexp_extract(x, '^([0-9]*)', 1)) AS d FROM v),
n AS (SELECT o_orderkey, list_transform(CASE WHEN list_contains(d, '') THEN d[:list_position(d, '') - 1] ELSE d END, lambda x: x::BIGINT) AS n FROM p)
SELECT o_orderkey, n::VARCHAR AS version, n > [0, 6, 0]::BIGINT[] AS newer FROM n""")
def c16_versions(spark, d):
    """The leading integers of version texts, and whether they come after 0.6.0."""
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, "0.6.0rc1").when(k % 4 == 1, F.concat(k.cast("string"), F.lit(".5"))).when(k % 4 == 2, F.concat(F.lit("1.2."), (k % 9).cast("string"))).otherwise("0.0.0+unknown")
    rows = corpus.table(spark, d, "orders").select("o_orderkey", X.leading_version(text).alias("v"))
    newer = F.col("v") > F.array(*[F.lit(n).cast("long") for n in (0, 6, 0)])
    return rows.select("o_orderkey", F.concat(F.lit("["), F.array_join(F.col("v").cast("array<string>"), ", "), F.lit("]")).alias("version"), newer.alias("newer"))


@query("""SELECT page_id, rtrim(coalesce(nullif(CASE WHEN page_id % 4 > 0 THEN url || repeat('/', (page_id % 3)::INTEGER) ELSE '' END, ''), 'https://registry.example.org/'), '/') AS registry, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'digest=' || page_id AS upload FROM pages""")
def c26_c27_addresses(spark, d):
    """Addresses, or the default one, without slashes at their end, and with a digest added to their query."""
    url = F.col("url")
    given = F.when(F.col("page_id") % 4 > 0, F.concat(url, F.repeat(F.lit("/"), (F.col("page_id") % 3).cast("int")))).otherwise("")
    upload = F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("digest="), F.col("page_id").cast("string"))
    return corpus.table(spark, d, "pages").select("page_id", X.registry(given, "https://registry.example.org/").alias("registry"), upload.alias("upload"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 > 0 AND regexp_matches(name, '^(datasets|spaces)/') THEN NULL WHEN p_size % 3 = 0 THEN name WHEN p_size % 3 = 1 THEN 'datasets/' || name ELSE 'spaces/' || name END AS path,
coalesce(nullif(CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END, ''), nullif(p_type, ''), '-') AS label FROM (SELECT *, CASE WHEN p_partkey % 5 = 0 THEN 'spaces/' || p_name ELSE p_name END AS name FROM part)""")
def c12_c28_paths_and_labels(spark, d):
    """Repository paths by kind (null where the name has a prefix already), and the first of two names that is not empty."""
    size = F.col("p_size")
    name = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("spaces/"), F.col("p_name"))).otherwise(F.col("p_name"))
    path = X.repository_path(name, F.when(size % 3 == 1, "dataset").when(size % 3 == 2, "space").otherwise("model"))
    first = F.when(size % 2 == 0, "").otherwise(F.col("p_brand"))
    label = F.coalesce(F.nullif(first, F.lit("")), F.nullif("p_type", F.lit("")), F.lit("-"))
    return corpus.table(spark, d, "part").select("p_partkey", path.alias("path"), label.alias("label"))


@query("""SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS made FROM events""")
def c22_revision_times(spark, d):
    """The time that a revision's name holds; names of another form have none."""
    name = F.when(F.col("event_id") % 3 == 0, "smoke-2026-x").otherwise(F.concat(F.lit("smoke-"), F.date_format("ts", "yyyyMMdd-HHmmss"), F.lit("-ab")))
    held = F.regexp_extract(name, r"^smoke-([0-9]{8}-[0-9]{6})-", 1)
    made = F.try_to_timestamp(F.nullif(held, F.lit("")), F.lit("yyyyMMdd-HHmmss"))
    return corpus.table(spark, d, "events").select("event_id", F.date_format(made, "yyyy-MM-dd HH:mm:ss").alias("made"))
