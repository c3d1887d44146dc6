"""Registered queries of catalogs, listings, reports and time series, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import catalog
from ..sources import corpus, documents
from .reference import _MODELS, _PARTS, _parts, query

_PAGES = """g AS (SELECT user_id AS repo, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page, 'v' || event_id AS tag, event_id,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '<https://r/v2/tags?last=again>; rel="next"' WHEN event_id % 11 = 0 THEN '<https://r/x>; rel="prev"' ELSE '<https://r/v2/tags?n=1000&last=v' || event_id || '>; rel="next"' END AS link FROM events),
n AS (SELECT *, nullif(regexp_extract(link, '<([^>]*)>; *rel="?next"?', 1), '') AS next FROM g),
s AS (SELECT *, next IS NULL OR row_number() OVER (PARTITION BY repo, next ORDER BY page) > 1 AS stops FROM n),
k AS (SELECT *, coalesce(sum(CASE WHEN stops THEN 1 ELSE 0 END) OVER (PARTITION BY repo ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS reached FROM s)"""
_REPORTS = """j AS (SELECT event_id, user_id, CASE WHEN event_id % 50 = 0 THEN 'oops{' ELSE '{"tests":[{"nodeid":"t' || (event_id % 7) || '","outcome":"' || CASE WHEN event_id % 3 = 0 THEN 'failed' ELSE 'passed' END || '","setup":{"outcome":"' || CASE WHEN event_id % 2 = 0 THEN 'error' ELSE 'passed' END || '"},"call":{"outcome":"'
  || CASE WHEN event_id % 4 = 0 THEN 'failed' ELSE 'passed' END || '","crash":{"message":"' || CASE event_id % 5 WHEN 0 THEN 'x.UploadError: EntryNotFoundError' WHEN 1 THEN 'Odd: UploadError' ELSE 'AssertionError: no' END || '"},"longrepr":"' || CASE WHEN event_id % 3 = 0 THEN 'lib/site-packages/a.py:7: in x\\n' ELSE '' END || 'tests/b.py:' || event_id || ': in y"}},{"nodeid":"u","outcome":"error","teardown":{"outcome":"error"}}]}' END AS report FROM events),
v AS (SELECT event_id, user_id, CASE WHEN json_valid(report) THEN report END AS report FROM j),
t AS (SELECT event_id, user_id, unnest(json_extract(report, '$.tests[*]')) AS t FROM v),
o AS (SELECT event_id, user_id, t, json_extract_string(t, '$.nodeid') AS test, CASE WHEN json_extract_string(t, '$.call.outcome') IN ('failed', 'error') THEN 'call' WHEN json_extract_string(t, '$.setup.outcome') IN ('failed', 'error') THEN 'setup' WHEN json_extract_string(t, '$.teardown.outcome') IN ('failed', 'error') THEN 'teardown' END AS stage
  FROM t WHERE json_extract_string(t, '$.outcome') IN ('failed', 'error')),
b AS (SELECT event_id, user_id, test, stage, json_extract_string(t, '$.' || stage || '.crash.message') AS message, json_extract_string(t, '$.' || stage || '.longrepr') AS longrepr FROM o WHERE stage IS NOT NULL)"""


def _pages(spark, d):
    e = F.col("event_id")
    text = e.cast("string")
    link = F.when(e % 17 == 0, F.lit(None)).when(e % 13 == 0, '<https://r/v2/tags?last=again>; rel="next"').when(e % 11 == 0, '<https://r/x>; rel="prev"').otherwise(F.concat(F.lit("<https://r/v2/tags?n=1000&last=v"), text, F.lit('>; rel="next"')))
    page = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long")
    return corpus.table(spark, d, "events").select(F.col("user_id").alias("repo"), page.alias("page"), F.array(F.concat(F.lit("v"), text), F.concat(F.lit("w"), text)).alias("tags"), link.alias("link"))


@query(f"WITH {_PAGES} SELECT repo, page, tag FROM (SELECT repo, page, tag FROM k WHERE reached UNION ALL SELECT repo, page, 'w' || event_id FROM k WHERE reached)")
def s05_u01_tag_pages(spark, d):
    """The tags of all pages that following the `next` links reaches: until a page has none, or one that was followed before."""
    return documents.follow_pages(_pages(spark, d)).select("repo", "page", F.explode("tags").alias("tag"))


@query("""WITH m AS (SELECT o_custkey AS repo, o_orderkey AS revision, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'chunked-v2' WHEN 2 THEN 'chunked-v9' ELSE NULL END AS layout FROM orders WHERE o_orderkey % 7 > 0),
a AS (SELECT o_orderkey AS revision, o_custkey AS repo FROM orders)
SELECT a.revision, CASE WHEN m.revision IS NULL THEN 'not found' WHEN layout IS NULL OR layout IN ('chunked-v2') THEN 'ok' ELSE 'layout ' || layout END AS outcome FROM a LEFT JOIN m USING (repo, revision)""")
def s03_s06_manifest_fetch(spark, d):
    """Manifests asked for by repository and revision: missing ones, and those of a layout that is not known."""
    o = corpus.table(spark, d, "orders")
    body = F.to_json(F.struct(F.lit(2).alias("schemaVersion"), F.when(F.col("o_orderkey") % 4 == 1, F.create_map(F.lit("chunked.layout"), F.lit("chunked-v2"))).when(F.col("o_orderkey") % 4 == 2, F.create_map(F.lit("chunked.layout"), F.lit("chunked-v9"))).alias("annotations")))
    stored = o.filter("o_orderkey % 7 > 0").select(F.col("o_custkey").alias("repo"), F.col("o_orderkey").alias("revision"), body.alias("manifest"))
    return documents.fetch_manifests(o.select(F.col("o_custkey").alias("repo"), F.col("o_orderkey").alias("revision")), stored).select("revision", "outcome")


@query("""SELECT event_id, user_id AS name, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0) AS artifact_count, 0::BIGINT AS pull_count, json_extract_string(props, '$.update_time') AS update_time FROM events""")
def s08_console_rows(spark, d):
    """Rows of a console's JSON by a declared schema: absent counts are 0, other absent fields stay null."""
    rows = documents.json_rows(corpus.table(spark, d, "events"), "props", "struct<k:bigint,pull_count:bigint,update_time:string>")
    return rows.select("event_id", F.col("user_id").alias("name"), F.coalesce("doc.k", F.lit(0)).alias("artifact_count"), F.coalesce("doc.pull_count", F.lit(0)).alias("pull_count"), F.col("doc.update_time").alias("update_time"))


def _reports(spark, d):
    e = F.col("event_id")
    word = lambda cond, a, b: F.when(cond, a).otherwise(b)
    message = F.when(e % 5 == 0, "x.UploadError: EntryNotFoundError").when(e % 5 == 1, "Odd: UploadError").otherwise("AssertionError: no")
    text = F.concat(
        F.lit('{"tests":[{"nodeid":"t'), (e % 7).cast("string"), F.lit('","outcome":"'), word(e % 3 == 0, "failed", "passed"), F.lit('","setup":{"outcome":"'), word(e % 2 == 0, "error", "passed"), F.lit('"},"call":{"outcome":"'),
        word(e % 4 == 0, "failed", "passed"), F.lit('","crash":{"message":"'), message, F.lit('"},"longrepr":"'), word(e % 3 == 0, "lib/site-packages/a.py:7: in x\\n", ""), F.lit("tests/b.py:"), e.cast("string"), F.lit(': in y"}},{"nodeid":"u","outcome":"error","teardown":{"outcome":"error"}}]}'),
    )
    return corpus.table(spark, d, "events").select("event_id", "user_id", F.when(e % 50 == 0, "oops{").otherwise(text).alias("report"))


#: what is said of an error whose kind holds a name, in this order
SAID = (("EntryNotFoundError", "a file is missing"), ("UploadError", "an upload failed"), ("AssertionError", "not what was expected"))


@query(f"""WITH {_REPORTS} SELECT event_id, user_id, test, stage, CASE WHEN contains(split_part(message, ':', 1), 'EntryNotFoundError') THEN 'a file is missing' WHEN contains(split_part(message, ':', 1), 'UploadError') THEN 'an upload failed' WHEN contains(split_part(message, ':', 1), 'AssertionError') THEN 'not what was expected' END AS explanation,
regexp_extract(list_filter(string_split(longrepr, chr(10)), lambda x: regexp_matches(x, '^\\S+\\.py:[0-9]+:') AND NOT contains(regexp_extract(x, '^(\\S+\\.py):', 1), 'site-packages'))[1], '^(\\S+\\.py:[0-9]+):', 1) AS frame,
row_number() OVER (PARTITION BY user_id ORDER BY event_id, test)::INTEGER AS place FROM b""")
def s13_f17_o05_c24_c25_failures(spark, d):
    """The failed tests of JSON reports (unreadable ones have none) with their first failing stage, what it means and the
    first line of one's own code; numbered by report, then test."""
    rows = documents.failures(_reports(spark, d), "report").select("event_id", "user_id", "test", "stage", X.explanation(F.col("message"), SAID).alias("explanation"), X.first_own_frame(F.col("longrepr")).alias("frame"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id", "test")))


@query(f"""WITH {_REPORTS} SELECT user_id, count(*) AS failures, array_to_string(list(event_id || '/' || test ORDER BY event_id, test)[:5], ', ') AS first_five FROM b GROUP BY user_id""")
def a19_failure_counts(spark, d):
    """Failures of each user, and the first five in order."""
    rows = documents.failures(_reports(spark, d), "report")
    order = Window.partitionBy("user_id").orderBy("event_id", "test")
    rows = rows.withColumn("k", F.row_number().over(order))
    first = F.array_sort(F.collect_list(F.when(F.col("k") <= 5, F.struct("k", F.concat(F.col("event_id").cast("string"), F.lit("/"), "test").alias("t")))))
    return rows.groupBy("user_id").agg(F.count("*").alias("failures"), first.alias("f")).select("user_id", "failures", F.array_join("f.t", ", ").alias("first_five"))


@query(f"WITH {_MODELS} SELECT project, count(*) AS versions, array_to_string(list(name ORDER BY repo DESC)[:3], '|') AS newest FROM m GROUP BY project")
def a11_versions(spark, d):
    """How many versions each project has, and its newest three."""
    return catalog.versions(corpus.models(spark, d), "project", "repo", "name", 3)


@query("""WITH x AS (SELECT event_id, 'blob unknown sha256:' || substr(sha256((event_id % 10)::VARCHAR), 1, 64) || ', sha256:' || sha256((event_id % 3)::VARCHAR) || ' sha256:' || sha256((event_id % 10)::VARCHAR) || ' sha256:short' AS message FROM events)
SELECT event_id, array_to_string(list_transform(list_filter(list_zip(m, range(1, len(m) + 1)), lambda z: list_position(m, z[1]) = z[2]), lambda z: z[1]), ',') AS missing FROM (SELECT event_id, regexp_extract_all(message, 'sha256:[0-9a-f]{64}') AS m FROM x)""")
def a18_missing_digests(spark, d):
    """The digests that a refusal names, once each, in the order named."""
    h = lambda k: F.sha2((F.col("event_id") % k).cast("string"), 256)
    message = F.concat(F.lit("blob unknown sha256:"), h(10), F.lit(", sha256:"), h(3), F.lit(" sha256:"), h(10), F.lit(" sha256:short"))
    return corpus.table(spark, d, "events").select("event_id", F.array_join(X.named_digests(message), ",").alias("missing"))


@query("""WITH u AS (SELECT o_custkey AS repo, strftime(o_orderdate, '%Y-%m-%d') AS snapshot_at, o_orderkey, o_totalprice FROM orders)
SELECT repo, snapshot_at, o_orderkey AS snapshot, o_totalprice AS storage FROM u QUALIFY row_number() OVER (PARTITION BY repo ORDER BY snapshot_at DESC, o_orderkey DESC) <= 7""")
def o03_usage_history(spark, d):
    """The last seven snapshots of each repository."""
    rows = corpus.table(spark, d, "orders").select(F.col("o_custkey").alias("repo"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("snapshot_at"), F.col("o_orderkey").alias("snapshot"), F.col("o_totalprice").alias("storage"))
    return catalog.latest(rows, "repo", ["snapshot_at", "snapshot"], 7)


@query(f"WITH {_PARTS} SELECT report, string_agg(idx || ':' || ms, ',' ORDER BY idx) AS parts, string_agg(DISTINCT 'p' || (idx % 4), ', ' ORDER BY 'p' || (idx % 4)) AS proxies FROM p GROUP BY report")
def o04_o06_w06_parts_in_order(spark, d):
    """The parts of each report, which came in any order, by index; and the names of the proxies they went through, in order."""
    text = F.concat(F.col("idx").cast("string"), F.lit(":"), F.col("ms").cast("string")).alias("t")
    rows = _parts(spark, d).groupBy("report").agg(F.array_sort(F.collect_list(F.struct("idx", text))).alias("p"), F.array_sort(F.collect_set(F.concat(F.lit("p"), (F.col("idx") % 4).cast("string")))).alias("x"))
    return rows.select("report", F.array_join("p.t", ",").alias("parts"), F.array_join("x", ", ").alias("proxies"))


@query("""WITH p AS (SELECT user_id AS report, CASE WHEN event_id % 9 > 0 THEN 1000000 + event_id % 1000 END AS bytes, CAST(floor(value) AS BIGINT) AS ms, event_id % 9 > 0 AS ok FROM events)
SELECT report, count(*) FILTER (ok) AS survivors, count(*) FILTER (NOT ok) AS failed, round(CASE WHEN max(ms) > 0 THEN coalesce(sum(bytes), 0) / 1e6::DOUBLE / (max(ms) / 1000.0::DOUBLE) ELSE 0 END, 6) AS mbps FROM p GROUP BY report""")
def a13_parallel_throughput(spark, d):
    """Bytes of the parts that came through over the wall time of all: parts run side by side, so the longest one's. A failed part counts as failed only."""
    parts = corpus.table(spark, d, "events").select(F.col("user_id").alias("report"), F.when(F.col("event_id") % 9 > 0, 1_000_000 + F.col("event_id") % 1000).alias("bytes"), F.floor("value").cast("long").alias("ms"))
    return catalog.parallel_throughput(parts)


@query("""SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END, p_type, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END], lambda x: x IS NOT NULL AND x <> ''), ', ') AS tags FROM part""")
def n06_tags(spark, d):
    """Tags joined, without empty and missing ones."""
    size = F.col("p_size")
    tags = F.array(F.when(size % 2 == 0, "").otherwise(F.col("p_brand")), F.col("p_type"), F.when(size % 3 != 0, F.col("p_name")))
    return corpus.table(spark, d, "part").select("p_partkey", F.array_join(F.filter(tags, lambda x: x.isNotNull() & (x != "")), ", ").alias("tags"))


@query("""SELECT source AS repo, string_agg('{"rfilename":"' || lang || '/' || doc_id || '","size":' || n_chars || CASE WHEN doc_id % 5 = 0 THEN '' ELSE ',"blobId":"' || sha256(doc_id::VARCHAR) || '"' END || '}', ',' ORDER BY doc_id) AS siblings FROM documents GROUP BY source""")
def n08_siblings(spark, d):
    """The files of each repository as siblings (name, size, blob) in order; an unknown blob is left out."""
    rows = corpus.table(spark, d, "documents").select(F.col("source").alias("repo"), F.struct(F.col("doc_id").alias("k"), F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("name"), F.col("n_chars").alias("size"), F.when(F.col("doc_id") % 5 != 0, F.sha2(F.col("doc_id").cast("string"), 256)).alias("blob")).alias("f"))
    own = rows.groupBy("repo").agg(F.array_sort(F.collect_list("f")).alias("files"))
    text = F.transform("files", lambda f: F.to_json(F.struct(f["name"].alias("rfilename"), f["size"].alias("size"), f["blob"].alias("blobId"))))
    return own.select("repo", F.array_join(text, ",").alias("siblings"))


@query("""WITH g AS (SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT event_id, user_id, coalesce(ts - before > INTERVAL 30 SECOND, false) AS stalled, coalesce(ts - before > INTERVAL 120 SECOND, false) AS given_up FROM g""")
def t05_stalls(spark, d):
    """Where more than 30 seconds pass between two signs of life, and where more than 120 do."""
    rows = corpus.table(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    gap = F.col("t") - F.lag("t").over(Window.partitionBy("user_id").orderBy("t", "event_id"))
    over = lambda s: F.coalesce(gap > s * 1_000_000, F.lit(False))
    return rows.select("event_id", "user_id", over(30).alias("stalled"), over(120).alias("given_up"))


@query("")
def s01_walk(spark, d):
    """All files below the tables' folder: path from there, size. Contents are not read."""
    return documents.walk(spark, d).select("path", "size")
