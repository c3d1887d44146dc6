"""Registered queries of the content-addressed operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import catalog, chunking, manifest, packing
from ..sources import corpus

CHUNK, PACK = 1024, 4096
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

_CHUNKS = f"""f AS (SELECT doc_id AS file_id, source AS repo, encode(coalesce(text, '')) AS content FROM documents),
c AS (SELECT file_id, i AS chunk_idx, i * {CHUNK} AS "offset", array_slice(content, i * {CHUNK} + 1, least((i + 1) * {CHUNK}, octet_length(content))) AS payload
      FROM (SELECT *, unnest(range(0, CAST(ceil(octet_length(content) / {CHUNK}.0) AS BIGINT))) AS i FROM f WHERE octet_length(content) > 0)),
h AS (SELECT file_id, chunk_idx, "offset", octet_length(payload)::BIGINT AS size, sha256(payload) AS digest, payload FROM c)"""
_INDEX = """x AS (SELECT digest, 'sha256:' || file_digest AS pack_digest, "offset" AS index_offset
      FROM h JOIN (SELECT file_id, sha256(content) AS file_digest FROM f) USING (file_id) WHERE {prior} QUALIFY row_number() OVER (PARTITION BY digest ORDER BY file_id, chunk_idx) = 1)"""
_FOLD = f"""k AS (SELECT h.file_id, h.chunk_idx, h.digest, h.size, x.pack_digest, x.index_offset, x.pack_digest IS NOT NULL AS reused FROM h LEFT JOIN x USING (digest)),
w AS (
  SELECT file_id, chunk_idx, digest, size, reused, pack_digest, CASE WHEN NOT reused THEN 0::BIGINT END AS pack_idx, CASE WHEN reused THEN index_offset ELSE 0::BIGINT END AS pack_offset,
         CASE WHEN reused OR size >= {PACK} THEN 0 ELSE size END AS held, CASE WHEN NOT reused AND size >= {PACK} THEN 1 ELSE 0 END::BIGINT AS pack
  FROM k WHERE chunk_idx = 0
  UNION ALL
  SELECT k.file_id, k.chunk_idx, k.digest, k.size, k.reused, k.pack_digest, CASE WHEN NOT k.reused THEN w.pack END, CASE WHEN k.reused THEN k.index_offset ELSE w.held END,
         CASE WHEN k.reused THEN w.held WHEN w.held + k.size >= {PACK} THEN 0 ELSE w.held + k.size END,
         CASE WHEN NOT k.reused AND w.held + k.size >= {PACK} THEN w.pack + 1 ELSE w.pack END
  FROM w JOIN k ON k.file_id = w.file_id AND k.chunk_idx = w.chunk_idx + 1)"""
_PLAN = f"""{_CHUNKS}, {_INDEX.format(prior="file_id % 10 <> 0")}, {_FOLD}"""
_LAYERS = """l AS (SELECT l_orderkey AS repo, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS layer_idx,
  CASE WHEN l_linenumber % 3 = 1 THEN 'pointer' ELSE 'blob' END AS media_type,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber = 7 THEN '' ELSE 'part\\' || (l_partkey % 5) END AS title,
  CAST(l_quantity AS BIGINT) AS size, sha256(l_partkey::VARCHAR) AS digest FROM lineitem),
t AS (SELECT *, nullif(replace(title, '\\', '/'), '') AS path FROM l)"""
_MODELS = """m AS (SELECT 'p' || (p_partkey % 7) AS project, p_partkey AS repo, p_name AS name, p_type AS format, p_brand AS architecture, 'q' || (p_size % 5) AS quantization, p_size::BIGINT * 100000000 AS parameter_count FROM part)"""
_PARTS = """p AS (SELECT user_id AS report, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS idx, CAST(floor(value) AS BIGINT) AS ms, 1000000 + event_id % 1000 AS bytes FROM events)"""
_REVISIONS = """r AS (SELECT o_custkey AS repo, o_orderkey AS revision, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS created FROM orders)"""


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.fixed_chunks(corpus.files(spark, d), CHUNK)


def _refs(spark: SparkSession, d: str) -> DataFrame:
    """References of an earlier revision: each of its files is a pack of its own."""
    files = corpus.files(spark, d).filter("file_id % 10 <> 0")
    files = files.withColumn("pack_digest", F.concat(F.lit("sha256:"), F.sha2("content", 256)))
    return chunking.fixed_chunks(files, CHUNK, ("pack_digest",)).drop("payload")


def _planned(spark: SparkSession, d: str) -> DataFrame:
    return packing.plan_packs(packing.classify(_chunks(spark, d).drop("payload"), packing.dedup_index(_refs(spark, d))), PACK)


@query(f"""WITH {_CHUNKS} SELECT file_id, chunk_idx, "offset", size, digest FROM h""")
def x01_fixed_chunks(spark, d):
    return _chunks(spark, d).drop("payload")


@query("")
def x02_content_chunks(spark, d):
    return chunking.content_chunks(corpus.files(spark, d), 1024)


@query("SELECT doc_id AS file_id, sha256(coalesce(text, '')) AS digest, octet_length(encode(coalesce(text, '')))::BIGINT AS size FROM documents")
def a02_file_digest(spark, d):
    return corpus.files(spark, d).select("file_id", F.sha2("content", 256).alias("digest"), F.octet_length("content").cast("long").alias("size"))


@query(f"WITH {_CHUNKS} SELECT file_id, count(*) AS n_chunks, sum(size)::BIGINT AS total_size FROM h GROUP BY file_id")
def a05_a08_chunk_totals(spark, d):
    return _chunks(spark, d).groupBy("file_id").agg(F.count("*").alias("n_chunks"), F.sum("size").alias("total_size"))


@query(f"""WITH {_CHUNKS}, {_INDEX.format(prior="file_id % 10 <> 0")} SELECT digest, pack_digest, index_offset FROM x""")
def a06_dedup_index(spark, d):
    return packing.dedup_index(_refs(spark, d))


@query(f"WITH {_CHUNKS}, {_INDEX.format(prior='file_id % 10 <> 0')} SELECT file_id, chunk_idx, digest, size, pack_digest, index_offset, pack_digest IS NOT NULL AS reused FROM h LEFT JOIN x USING (digest)")
def j01_x05_classify(spark, d):
    return packing.classify(_chunks(spark, d).drop("payload", "offset"), packing.dedup_index(_refs(spark, d)))


@query(f"WITH RECURSIVE {_PLAN} SELECT file_id, chunk_idx, digest, size, reused, pack_digest, pack_idx, pack_offset FROM w")
def x06_pack_plan(spark, d):
    return _planned(spark, d)


@query(f"WITH RECURSIVE {_PLAN} SELECT file_id, pack_idx, sum(size)::BIGINT AS pack_size, count(*) AS n_chunks FROM w WHERE pack_idx IS NOT NULL GROUP BY ALL")
def a01_pack_size(spark, d):
    return _planned(spark, d).filter("pack_idx is not null").groupBy("file_id", "pack_idx").agg(F.sum("size").alias("pack_size"), F.count("*").alias("n_chunks"))


@query(f"""WITH RECURSIVE {_PLAN} SELECT w.file_id, w.pack_idx, sum(w.size)::BIGINT AS size, count(*) AS n_chunks, sha256(unhex(string_agg(hex(h.payload), '' ORDER BY w.pack_offset))) AS digest
FROM w JOIN h USING (file_id, chunk_idx) WHERE w.pack_idx IS NOT NULL GROUP BY w.file_id, w.pack_idx""")
def x08_pack_digest(spark, d):
    return packing.pack_digests(_planned(spark, d), _chunks(spark, d))


@query("SELECT doc_id AS file_id, sha256(coalesce(text, '')) AS digest, octet_length(encode(coalesce(text, '')))::BIGINT AS size FROM documents")
def a03_x15_reassembled_digest(spark, d):
    """Files put together again from their chunks; the SQL hashes the texts as they were."""
    return packing.reassemble(_chunks(spark, d), corpus.files(spark, d))


@query(f"""WITH {_CHUNKS}, e AS (SELECT file_id, "offset" + CASE WHEN file_id % 11 = 3 AND chunk_idx = 1 THEN 1 ELSE 0 END AS o, size FROM h WHERE NOT (file_id % 7 = 5 AND chunk_idx = 2)),
n AS (SELECT *, lag(o + size, 1, 0) OVER (PARTITION BY file_id ORDER BY o) AS before FROM e),
s AS (SELECT file_id, bool_and(o = before) AS joined, max(o + size) AS stop FROM n GROUP BY 1)
SELECT f.file_id, CASE WHEN octet_length(content) = 0 THEN stop IS NULL ELSE coalesce(joined AND stop = octet_length(content), false) END AS tiles FROM f LEFT JOIN s USING (file_id)""")
def w04_tiling(spark, d):
    """Which files their chunks cover without gap or overlap; some chunks are moved or lost."""
    lengths = corpus.files(spark, d).select("file_id", F.octet_length("content").cast("long").alias("length"))
    moved = F.col("offset") + F.when((F.col("file_id") % 11 == 3) & (F.col("chunk_idx") == 1), 1).otherwise(0)
    chunks = _chunks(spark, d).drop("payload").filter("not (file_id % 7 = 5 and chunk_idx = 2)").withColumn("offset", moved)
    return chunking.tiling(chunks, lengths)


@query("SELECT sha256(coalesce(text, '')) AS digest, count(*) AS copies, min(doc_id) AS first_file FROM documents GROUP BY 1")
def x18_whole_file_reuse(spark, d):
    return corpus.files(spark, d).groupBy(F.sha2("content", 256).alias("digest")).agg(F.count("*").alias("copies"), F.min("file_id").alias("first_file"))


@query(f"""WITH {_CHUNKS}, b AS (SELECT DISTINCT digest FROM h WHERE file_id % 10 <> 0), a AS (SELECT DISTINCT digest FROM h)
SELECT count(*) AS after_chunks, count(b.digest) AS shared_chunks, coalesce(count(b.digest) * 100.0::DOUBLE / nullif(count(*), 0), 0) AS reuse_percent FROM a LEFT JOIN b USING (digest)""")
def a17_u03_reuse_percent(spark, d):
    after = _chunks(spark, d).select("digest").distinct()
    before = _chunks(spark, d).filter("file_id % 10 <> 0").select("digest").distinct().withColumn("_b", F.lit(1))
    both = after.join(before, "digest", "left").agg(F.count("*").alias("after_chunks"), F.count("_b").alias("shared_chunks"))
    return both.withColumn("reuse_percent", F.coalesce(F.col("shared_chunks") * 100.0 / F.nullif("after_chunks", F.lit(0)), F.lit(0.0)))


@query(f"WITH {_LAYERS} SELECT repo, layer_idx, sum(size) OVER (PARTITION BY repo ORDER BY layer_idx)::BIGINT - size AS file_offset FROM l")
def w01_file_offset(spark, d):
    return corpus.layers(spark, d).select("repo", "layer_idx", "file_offset")


@query(f"WITH {_LAYERS} SELECT repo, layer_idx, path AS title, media_type = 'pointer' AS is_chunked, size, digest FROM t WHERE path IS NOT NULL")
def f01_group_files(spark, d):
    return manifest.group_files(corpus.layers(spark, d))


@query(f"WITH {_LAYERS} SELECT repo, string_agg(path, '|' ORDER BY layer_idx) AS titles FROM t WHERE path IS NOT NULL GROUP BY repo")
def f03_layer_titles(spark, d):
    titles = manifest.group_files(corpus.layers(spark, d)).groupBy("repo").agg(F.array_sort(F.collect_list(F.struct("layer_idx", "title"))).alias("t"))
    return titles.select("repo", F.array_join("t.title", "|").alias("titles"))


@query(f"WITH {_LAYERS} SELECT repo, path AS title, layer_idx, media_type = 'pointer' AS is_chunked, size, digest FROM t WHERE path IS NOT NULL QUALIFY row_number() OVER (PARTITION BY repo, path ORDER BY layer_idx) = 1")
def w08_first_title(spark, d):
    return manifest.first_titles(manifest.group_files(corpus.layers(spark, d)))


@query(f"WITH {_LAYERS} SELECT repo, layer_idx, sum(CASE WHEN path IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY repo ORDER BY layer_idx)::BIGINT AS group_no FROM t")
def w05_positional_groups(spark, d):
    return manifest.positional_groups(corpus.layers(spark, d)).select("repo", "layer_idx", "group_no")


@query(f"""WITH {_LAYERS}, g AS (SELECT *, sum(CASE WHEN path IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY repo ORDER BY layer_idx) AS group_no FROM t),
e AS (SELECT * FROM g WHERE layer_idx < 4), n AS (SELECT * FROM t WHERE layer_idx >= 4 AND path IS NOT NULL),
hd AS (SELECT repo, group_no, max(path) AS gt FROM e GROUP BY ALL)
SELECT e.repo, e.layer_idx, e.media_type, e.title, e.size, e.digest, 'kept' AS origin FROM e JOIN hd USING (repo, group_no)
WHERE hd.gt IS NULL OR (hd.gt <> 'part/3' AND NOT EXISTS (SELECT 1 FROM n WHERE n.repo = e.repo AND n.path = hd.gt))
UNION ALL SELECT repo, layer_idx, media_type, title, size, digest, 'new' FROM n""")
def x11_u02_merge_manifest(spark, d):
    rows = corpus.layers(spark, d).withColumn("is_new", F.col("layer_idx") >= 4)
    rows = rows.filter(~F.col("is_new") | manifest.title_of(F.col("title")).isNotNull())
    return manifest.merge_flagged(rows, ["part/3"])


@query("SELECT doc_id AS file_id, lang || '/' || doc_id || '.txt' AS title FROM documents WHERE (lang || '/' || doc_id || '.txt' GLOB 'en*' OR lang || '/' || doc_id || '.txt' GLOB '*/?3*') AND NOT lang || '/' || doc_id || '.txt' GLOB '*[67].txt'")
def f04_glob_filter(spark, d):
    return manifest.glob_filter(corpus.files(spark, d).select("file_id", "title"), "title", ["en*", "*/?3*"], ["*[67].txt"])


@query(f"WITH {_CHUNKS} SELECT file_id, chunk_idx, digest FROM h WHERE digest NOT IN (SELECT digest FROM h WHERE file_id % 10 <> 0)")
def j06_k01_missing_blobs(spark, d):
    chunks = _chunks(spark, d).select("file_id", "chunk_idx", "digest")
    return chunks.join(chunks.filter("file_id % 10 <> 0").select("digest"), "digest", "left_anti").select("file_id", "chunk_idx", "digest")


@query("SELECT bool_or(octet_length(encode(text)) >= 8192) AS any_large, count(*) FILTER (octet_length(encode(text)) >= 8192) AS n_chunked, count(*) FILTER (octet_length(encode(text)) < 8192) AS n_plain FROM documents")
def f06_large_files(spark, d):
    large = F.octet_length("content") >= 8192
    return corpus.files(spark, d).agg(F.bool_or(large).alias("any_large"), F.count_if(large).alias("n_chunked"), F.count_if(~large).alias("n_plain"))


@query(f"WITH {_MODELS} SELECT * FROM m WHERE format = 'ECONOMY' AND parameter_count BETWEEN 500000000 AND 2500000000 AND contains(lower(name), 'ring')")
def f07_search_models(spark, d):
    return catalog.search_models(corpus.models(spark, d), format="ECONOMY", min_params=500_000_000, max_params=2_500_000_000, q="RING")


@query(f"WITH {_MODELS} SELECT *, (SELECT count(*) FROM m WHERE quantization = 'q1') AS matching FROM m WHERE quantization = 'q1' ORDER BY project, repo LIMIT 25 OFFSET 25")
def o02_a10_model_page(spark, d):
    found = catalog.search_models(corpus.models(spark, d), quantization="q1")
    total = found.agg(F.count("*").alias("matching"))
    return catalog.page(found, ["project", "repo"], 2).join(F.broadcast(total))  # one row


@query(f"WITH {_MODELS} SELECT array_to_string(list_sort(list(DISTINCT format)), ',') AS formats, array_to_string(list_sort(list(DISTINCT architecture)), ',') AS architectures, array_to_string(list_sort(list(DISTINCT quantization)), ',') AS quantizations FROM m")
def a09_model_facets(spark, d):
    return catalog.facets(corpus.models(spark, d))


@query(f"WITH {_MODELS} SELECT project, count(*) AS repos, sum(parameter_count)::BIGINT AS params, count(DISTINCT architecture) AS architectures FROM m GROUP BY project")
def a12_usage_totals(spark, d):
    return corpus.models(spark, d).groupBy("project").agg(F.count("*").alias("repos"), F.sum("parameter_count").alias("params"), F.count_distinct("architecture").alias("architectures"))


@query(f"WITH {_REVISIONS} SELECT *, row_number() OVER (PARTITION BY repo ORDER BY coalesce(created, '') DESC, revision DESC)::INTEGER AS rank, row_number() OVER (PARTITION BY repo ORDER BY coalesce(created, '') DESC, revision DESC) = 1 AND created IS NOT NULL AS latest FROM r")
def o01_w09_newest_first(spark, d):
    o = corpus.table(spark, d, "orders")
    created = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return catalog.newest_first(o.select(F.col("o_custkey").alias("repo"), F.col("o_orderkey").alias("revision"), created.alias("created")), "repo")


def _parts(spark, d):
    e = corpus.table(spark, d, "events")
    idx = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    return e.select(F.col("user_id").alias("report"), idx.cast("long").alias("idx"), F.floor("value").cast("long").alias("ms"), (1_000_000 + F.col("event_id") % 1000).alias("bytes"))


@query(f"""WITH {_PARTS}, s AS (SELECT *, CASE WHEN ms > 0 THEN bytes / 1e6 / (ms / 1000.0::DOUBLE) ELSE 0 END AS mbps, count(*) OVER (PARTITION BY report) AS n FROM p)
SELECT report, count(*) AS n_parts, round(CASE WHEN sum(ms) > 0 THEN sum(bytes) / 1e6 / (sum(ms) / 1000.0::DOUBLE) ELSE 0 END, 6) AS mbps,
arg_min(idx, (-ms, idx)) AS slowest,
count(*) >= 4 AND coalesce(avg(mbps) FILTER (idx < n // 2), 0) > 0 AND coalesce(avg(mbps) FILTER (idx >= n // 2), 0) < 0.5 * avg(mbps) FILTER (idx < n // 2) AS slows_down FROM s GROUP BY report""")
def a13_a14_a15_probe_report(spark, d):
    return catalog.probe_report(_parts(spark, d))


@query(f"WITH {_PARTS} SELECT report, median(ms)::DOUBLE AS median_ms FROM p GROUP BY report")
def a16_median(spark, d):
    return _parts(spark, d).groupBy("report").agg(F.percentile("ms", 0.5).alias("median_ms"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, ceil(CAST(l_extendedprice AS BIGINT) / 4096.0)::BIGINT AS n_chunks,
least(4095, CAST(l_extendedprice AS BIGINT) - 1)::BIGINT AS first_end FROM lineitem""")
def c04_c05_chunk_math(spark, d):
    n = F.col("l_extendedprice").cast("decimal(20,4)")
    length = F.bround(n, 0).cast("long")
    return corpus.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", chunking.num_chunks(length, F.lit(4096)).alias("n_chunks"), X.chunk_end(length, F.lit(4096).cast("long"), F.lit(0)).cast("long").alias("first_end"))


@query("""SELECT event_id, CASE WHEN s IN (408, 429) OR s BETWEEN 500 AND 599 THEN true ELSE false END AS retry, CASE WHEN event_id % 4 = 0 THEN 'refs/heads/main' ELSE 'refs/tags/v' || (event_id % 9) END AS ref
FROM (SELECT event_id, 400 + event_id % 200 AS s FROM events)""")
def f11_c21_status_and_ref(spark, d):
    revision = F.when(F.col("event_id") % 4 == 0, "main").otherwise(F.concat(F.lit("v"), (F.col("event_id") % 9).cast("string")))
    return corpus.table(spark, d, "events").select("event_id", X.retryable(400 + F.col("event_id") % 200).alias("retry"), X.ref_name(revision).alias("ref"))


@query("SELECT doc_id, NOT (starts_with(p, '/') OR list_contains(string_split(replace(p, '\\', '/'), '/'), '..')) AND NOT starts_with(p, '\\') AS safe FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '/' WHEN 1 THEN 'a\\..\\' WHEN 2 THEN 'a..b/' WHEN 3 THEN '../' ELSE '' END || doc_id AS p FROM documents)")
def f10_safe_path(spark, d):
    k = F.col("doc_id") % 5
    path = F.concat(F.when(k == 0, "/").when(k == 1, "a\\..\\").when(k == 2, "a..b/").when(k == 3, "../").otherwise(""), F.col("doc_id").cast("string"))
    return corpus.table(spark, d, "documents").select("doc_id", X.safe_path(path).alias("safe"))


@query(f"""WITH {_CHUNKS}, u AS (SELECT file_id, repo, sha256(content) AS digest FROM f), v AS (SELECT * FROM u WHERE file_id % 13 <> 0)
SELECT u.file_id, CASE WHEN v.digest IS NULL THEN 'missing' WHEN v.digest = u.digest THEN 'same' ELSE 'differs' END AS status FROM u LEFT JOIN v USING (file_id)""")
def j13_round_trip(spark, d):
    up = corpus.files(spark, d).select("file_id", F.sha2("content", 256).alias("digest"))
    down = up.filter("file_id % 13 <> 0").select("file_id", F.col("digest").alias("got"))
    status = F.when(F.col("digest").isNull(), "extra").when(F.col("got").isNull(), "missing").when(F.col("digest") == F.col("got"), "same").otherwise("differs")
    return up.join(down, "file_id", "full_outer").select("file_id", status.alias("status"))


@query(f"""WITH {_CHUNKS} SELECT digest, min(repo) AS first_repo, count(DISTINCT repo) AS repos, count(*) AS uses, sum(size)::BIGINT AS bytes FROM h JOIN f USING (file_id) GROUP BY digest HAVING count(*) > 1""")
def x05_shared_chunks(spark, d):
    rows = _chunks(spark, d).join(corpus.files(spark, d).select("file_id", "repo"), "file_id")
    return rows.groupBy("digest").agg(F.min("repo").alias("first_repo"), F.count_distinct("repo").alias("repos"), F.count("*").alias("uses"), F.sum("size").alias("bytes")).filter("uses > 1")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By repository: chunks, new and reused bytes, and packs of a second revision against the first."""
    repo = corpus.files(spark, sf_dir).select("file_id", "repo")
    per_file = _planned(spark, sf_dir).groupBy("file_id").agg(F.count("*").alias("n"), F.sum(F.when(F.col("reused"), 0).otherwise(F.col("size"))).alias("new"), F.sum(F.when(F.col("reused"), F.col("size")).otherwise(0)).alias("old"), F.count_distinct("pack_idx").alias("packs"))
    return per_file.join(repo, "file_id").groupBy("repo").agg(F.sum("n").alias("chunks"), F.sum("new").alias("new_bytes"), F.sum("old").alias("reused_bytes"), F.sum("packs").alias("packs"))
