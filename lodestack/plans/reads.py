"""Registered queries of lookups, validity checks and read plans, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import manifest
from ..sources import corpus
from .reference import _LAYERS, _PLAN, _planned, query


@query(f"""WITH RECURSIVE {_PLAN}, z AS (SELECT file_id, pack_idx, sum(size)::BIGINT AS pack_size FROM w WHERE pack_idx IS NOT NULL AND file_id % 11 <> 0 GROUP BY ALL)
SELECT w.file_id, w.chunk_idx, w.pack_idx, z.pack_size IS NULL AS malformed, coalesce(w.pack_offset + w.size <= z.pack_size, false) AS inside
FROM w LEFT JOIN z USING (file_id, pack_idx) WHERE w.pack_idx IS NOT NULL""")
def j02_j03_pack_reference(spark, d):
    """Each planned chunk against the sizes of the packs that a manifest lists; an unlisted pack makes it malformed."""
    plan = _planned(spark, d).filter("pack_idx is not null")
    sizes = plan.filter("file_id % 11 <> 0").groupBy("file_id", "pack_idx").agg(F.sum("size").alias("pack_size"))
    inside = F.coalesce(F.col("pack_offset") + F.col("size") <= F.col("pack_size"), F.lit(False))
    return plan.join(sizes, ["file_id", "pack_idx"], "left").select("file_id", "chunk_idx", "pack_idx", F.col("pack_size").isNull().alias("malformed"), inside.alias("inside"))


@query(f"""WITH RECURSIVE {_PLAN} SELECT file_id, pack_idx, min(chunk_idx) AS first_chunk, count(*) AS n_chunks, sum(size)::BIGINT AS bytes,
row_number() OVER (PARTITION BY file_id ORDER BY min(chunk_idx)) AS appearance FROM w WHERE pack_idx IS NOT NULL GROUP BY file_id, pack_idx""")
def a04_a07_packs_in_order(spark, d):
    """The packs of each file in the order of their first chunk."""
    packs = _planned(spark, d).filter("pack_idx is not null").groupBy("file_id", "pack_idx")
    packs = packs.agg(F.min("chunk_idx").alias("first_chunk"), F.count("*").alias("n_chunks"), F.sum("size").alias("bytes"))
    return packs.withColumn("appearance", F.row_number().over(Window.partitionBy("file_id").orderBy("first_chunk")).cast("long"))


@query(f"WITH {_LAYERS} SELECT repo, layer_idx, path AS title FROM t WHERE path IS NULL OR path NOT IN ('part/1', 'part/4')")
def j05_not_deleted(spark, d):
    """Layers without those of deleted titles; untitled ones stay."""
    rows = corpus.layers(spark, d).select("repo", "layer_idx", manifest.title_of(F.col("title")).alias("title"))
    gone = spark.createDataFrame([("part/1",), ("part/4",)], "title string")
    return rows.join(F.broadcast(gone), "title", "left_anti").select("repo", "layer_idx", "title")  # two rows


@query("""WITH c AS (SELECT o_custkey AS repo, max(o_orderkey) AS current FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1)
SELECT o_orderkey AS revision, CASE WHEN o_orderkey % 3 = 0 THEN 'unguarded' WHEN c.current IS NOT DISTINCT FROM o.o_orderkey THEN 'accepted' ELSE 'conflict' END AS outcome
FROM orders o LEFT JOIN c ON c.repo = o.o_custkey""")
def j08_k04_conditional_commit(spark, d):
    """A commit that expects a revision is accepted only if that one is current; one that expects none is unguarded."""
    orders = corpus.table(spark, d, "orders").select(F.col("o_custkey").alias("repo"), F.col("o_orderkey").alias("revision"))
    current = orders.filter("revision % 2 = 0").groupBy("repo").agg(F.max("revision").alias("current"))
    expected = F.when(F.col("revision") % 3 != 0, F.col("revision"))
    outcome = F.when(expected.isNull(), "unguarded").when(F.col("current").eqNullSafe(expected), "accepted").otherwise("conflict")
    return orders.join(current, "repo", "left").select("revision", outcome.alias("outcome"))


@query("""WITH r AS (SELECT o_custkey AS repo, count(*) AS revisions, max(CASE WHEN o_orderstatus = 'F' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END) AS pushed,
max(CASE WHEN o_orderpriority LIKE '1%' THEN strftime(o_orderdate, '%Y-%m') END) AS artifact FROM orders GROUP BY 1)
SELECT c_custkey AS repo, n_name AS project, coalesce(revisions, 0) AS revisions,
coalesce(nullif(artifact, ''), nullif(pushed, ''), nullif(c_mktsegment, ''), nullif(n_name, '')) AS updated, revisions IS NOT NULL AS found,
CASE c_custkey % 5 WHEN 0 THEN 'forbidden' WHEN 1 THEN 'missing' ELSE 'found' END AS lookup, CASE WHEN c_custkey % 5 > 1 THEN c_acctbal < 0 END AS private
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN r ON r.repo = c_custkey""")
def j09_s07_repo_info(spark, d):
    """Repository facts from artifact, repository, project and manifest. The first time that isn't empty counts, in this
    order; a project that can't be read (403) or isn't there (404) leaves it unknown whether the repository is private."""
    pushed = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    artifact = F.when(F.col("o_orderpriority").startswith("1"), F.date_format("o_orderdate", "yyyy-MM"))
    revisions = corpus.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("repo")).agg(F.count("*").alias("revisions"), F.max(pushed).alias("pushed"), F.max(artifact).alias("artifact"))
    project = corpus.table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("project"))
    rows = corpus.table(spark, d, "customer").withColumn("repo", F.col("c_custkey")).join(project, "c_nationkey", "left").join(revisions, "repo", "left")
    updated = F.coalesce(*[F.nullif(c, F.lit("")) for c in ("artifact", "pushed", "c_mktsegment", "project")])
    status = F.when(F.col("repo") % 5 == 0, 403).when(F.col("repo") % 5 == 1, 404).otherwise(200)
    rows = rows.withColumn("lookup", X.lookup_outcome(status))
    return rows.select("repo", "project", F.coalesce("revisions", F.lit(0)).alias("revisions"), updated.alias("updated"), F.col("revisions").isNotNull().alias("found"), "lookup", F.when(F.col("lookup") == "found", F.col("c_acctbal") < 0).alias("private"))


@query(f"""WITH {_LAYERS}, a AS (SELECT c_custkey, c_custkey * 2 AS repo, CASE WHEN c_custkey % 3 = 0 THEN 404 WHEN c_custkey % 3 = 1 THEN 403 ELSE 200 END AS tags, 'part/' || (c_custkey % 6) AS title FROM customer)
SELECT c_custkey, tags <> 404 AS repo_exists, EXISTS (SELECT 1 FROM l WHERE l.repo = a.repo) AS revision_exists, EXISTS (SELECT 1 FROM t WHERE t.repo = a.repo AND t.path = a.title) AS file_exists FROM a""")
def f09_existence(spark, d):
    """Is a repository there (one that needs a login is), a revision (it has a manifest), a file (its title is in that manifest)?"""
    asked = corpus.table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") * 2).alias("repo"), F.concat(F.lit("part/"), (F.col("c_custkey") % 6).cast("string")).alias("title"))
    status = F.when(F.col("c_custkey") % 3 == 0, 404).when(F.col("c_custkey") % 3 == 1, 403).otherwise(200)
    layers = corpus.layers(spark, d)
    files = manifest.group_files(layers).select("repo", "title").distinct().withColumn("file", F.lit(True))
    there = layers.select("repo").distinct().withColumn("there", F.lit(True))
    rows = asked.join(there, "repo", "left").join(files, ["repo", "title"], "left")
    return rows.select("c_custkey", (X.lookup_outcome(status) != "missing").alias("repo_exists"), F.col("there").isNotNull().alias("revision_exists"), F.col("file").isNotNull().alias("file_exists"))


@query(f"""WITH {_LAYERS} SELECT o_orderkey AS revision, count(layer_idx) AS n_layers, coalesce(sum(size), 0)::BIGINT AS bytes FROM orders LEFT JOIN l ON l.repo = o_orderkey GROUP BY 1""")
def j10_revision_manifests(spark, d):
    """Layers and bytes of each revision's manifest."""
    layers = corpus.layers(spark, d).groupBy(F.col("repo").alias("revision")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    rows = corpus.table(spark, d, "orders").select(F.col("o_orderkey").alias("revision")).distinct().join(layers, "revision", "left")
    return rows.select("revision", F.coalesce("n", F.lit(0)).alias("n_layers"), F.coalesce("size", F.lit(0)).alias("bytes"))


@query("""WITH a AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'x' WHEN 1 THEN '' WHEN 2 THEN '0' ELSE (event_id % 90)::VARCHAR END AS chunk_count, CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'sha256:' || sha256(user_id::VARCHAR) END AS digest FROM events)
SELECT event_id, try_cast(chunk_count AS BIGINT) AS n, CASE WHEN digest IS NULL THEN 'digest' WHEN try_cast(chunk_count AS BIGINT) IS NULL THEN 'integer' WHEN try_cast(chunk_count AS BIGINT) < 1 THEN 'count' ELSE 'ok' END AS verdict FROM a""")
def f02_pointer_annotations(spark, d):
    """Annotations hold integers as text: each row's count, and the first rule that it breaks."""
    k = F.col("event_id") % 5
    text = F.when(k == 0, "x").when(k == 1, "").when(k == 2, "0").otherwise((F.col("event_id") % 90).cast("string"))
    digest = F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("sha256:"), F.sha2(F.col("user_id").cast("string"), 256)))
    n = text.try_cast("long")
    verdict = F.when(digest.isNull(), "digest").when(n.isNull(), "integer").when(n < 1, "count").otherwise("ok")
    return corpus.table(spark, d, "events").select("event_id", n.alias("n"), verdict.alias("verdict"))


@query(f"WITH {_LAYERS} SELECT DISTINCT repo, path AS title FROM t WHERE path GLOB 'part/[12]'")
def f05_delete_patterns(spark, d):
    """The titles of each repository that delete patterns choose."""
    return manifest.glob_filter(manifest.group_files(corpus.layers(spark, d)), "title", ["part/[12]"], []).select("repo", "title").distinct()


@query(f"""WITH {_LAYERS} SELECT repo, layer_idx, size FROM (SELECT * FROM t WHERE path = 'part/2' QUALIFY row_number() OVER (PARTITION BY repo ORDER BY layer_idx) = 1) WHERE media_type = 'pointer' OR size > 10""")
def f08_file_lookup(spark, d):
    """The first layer of a title, if it is usable; a later one of that title does not stand in."""
    rows = manifest.first_titles(manifest.group_files(corpus.layers(spark, d))).filter("title = 'part/2'")
    return rows.filter("is_chunked or size > 10").select("repo", "layer_idx", "size")


@query("""SELECT event_id, s IN (408, 429, 500, 502, 503, 504) OR (s = 400 AND contains(event_type, 'c')) AS retry, k IS NULL OR k IN ('model', 'dataset', 'space') AS valid_type,
CASE WHEN p = 206 THEN a = 5 AND b = 17 WHEN p = 200 THEN a = 0 AND b = 41 ELSE false END AS range_ok
FROM (SELECT event_id, event_type, 400 + event_id % 200 AS s, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'model' WHEN 2 THEN 'space' ELSE 'models' END AS k,
CASE event_id % 3 WHEN 0 THEN 206 WHEN 1 THEN 200 ELSE 416 END AS p, CASE WHEN event_id % 2 = 0 THEN 5 ELSE 0 END AS a, CASE WHEN event_id % 5 < 3 THEN 17 ELSE 41 END AS b FROM events)""")
def f12_f13_f15_checks(spark, d):
    """Which replies to a manifest write are tried again, which kinds are valid, which replies answer the asked range."""
    e, status = F.col("event_id"), 400 + F.col("event_id") % 200
    retry = status.isin(408, 429, 500, 502, 503, 504) | ((status == 400) & F.contains("event_type", F.lit("c")))
    kind = F.when(e % 4 == 1, "model").when(e % 4 == 2, "space").when(e % 4 == 3, "models")
    code = F.when(e % 3 == 0, 206).when(e % 3 == 1, 200).otherwise(416)
    a, b = F.when(e % 2 == 0, 5).otherwise(0), F.when(e % 5 < 3, 17).otherwise(41)
    range_ok = F.when(code == 206, (a == 5) & (b == 17)).when(code == 200, (a == 0) & (b == 41)).otherwise(False)
    return corpus.table(spark, d, "events").select("event_id", retry.alias("retry"), (kind.isNull() | kind.isin("model", "dataset", "space")).alias("valid_type"), range_ok.alias("range_ok"))


@query(f"""WITH {_LAYERS}, p AS (SELECT repo, layer_idx, size, CASE WHEN layer_idx = 3 THEN 9223372036854775807 ELSE sum(size) OVER (PARTITION BY repo ORDER BY layer_idx) - size END::HUGEINT AS file_offset, sum(size) OVER (PARTITION BY repo) AS total FROM l)
SELECT repo, layer_idx, CASE WHEN size > 45 THEN 'pack too large' WHEN file_offset + size > 9223372036854775807 THEN 'overflow' WHEN file_offset + size > total THEN 'outside' ELSE 'ok' END AS verdict FROM p""")
def x13_f14_read_plan_bounds(spark, d):
    """Each target of a read plan: its pack within the ceiling, its end without overflow and within the file."""
    rows = corpus.layers(spark, d)
    rows = rows.select("repo", "layer_idx", "size", F.col("file_offset").alias("o"), F.sum("size").over(Window.partitionBy("repo")).alias("total"))
    end = F.try_add(F.when(F.col("layer_idx") == 3, F.lit(2**63 - 1)).otherwise(F.col("o")), F.col("size"))
    verdict = F.when(F.col("size") > 45, "pack too large").when(end.isNull(), "overflow").when(end > F.col("total"), "outside").otherwise("ok")
    return rows.select("repo", "layer_idx", verdict.alias("verdict"))


@query("""WITH n AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'main' WHEN 1 THEN 'smoke-later-1' ELSE 'smoke-' || strftime(o_orderdate, '%Y%m%d') || '-' || lpad((o_orderkey % 24)::VARCHAR, 2, '0') || '3015-' || o_orderkey END AS name FROM orders)
SELECT o_orderkey, name FROM n WHERE try_strptime(nullif(regexp_extract(name, '^smoke-([0-9]{8}-[0-9]{6})-', 1), ''), '%Y%m%d-%H%M%S') < TIMESTAMP '1998-04-25 12:00:00'""")
def f16_stale_revisions(spark, d):
    """Test revisions whose name holds a time before the cutoff; names without one are left alone."""
    k, day = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyyMMdd")
    name = F.when(k == 0, "main").when(k == 1, "smoke-later-1").otherwise(F.concat(F.lit("smoke-"), day, F.lit("-"), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit("3015-"), F.col("o_orderkey").cast("string")))
    rows = corpus.table(spark, d, "orders").select("o_orderkey", name.alias("name"))
    found = F.try_to_timestamp(F.nullif(F.regexp_extract("name", "^smoke-([0-9]{8}-[0-9]{6})-", 1), F.lit("")), F.lit("yyyyMMdd-HHmmss"))
    return rows.filter(found < F.lit("1998-04-25 12:00:00").cast("timestamp"))


@query("""SELECT a.s_suppkey AS asked, min(p.s_suppkey) AS plan FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey::VARCHAR ELSE upper(s_name) END AS q FROM supplier) a
JOIN (SELECT s_suppkey, s_name FROM supplier) p ON lower(p.s_name) = lower(a.q) OR p.s_suppkey::VARCHAR = a.q GROUP BY 1""")
def j12_plan_by_name_or_id(spark, d):
    """A plan asked for by its name in any case, or by its number; the lowest of several. Two equi-joins, no nested loop."""
    s = corpus.table(spark, d, "supplier")
    asked = s.select(F.col("s_suppkey").alias("asked"), F.lower(F.when(F.col("s_suppkey") % 3 == 0, F.col("s_suppkey").cast("string")).otherwise(F.upper("s_name"))).alias("key"))
    keys = s.select(F.col("s_suppkey").alias("plan"), F.explode(F.array(F.lower("s_name"), F.col("s_suppkey").cast("string"))).alias("key"))
    return asked.join(keys, "key").groupBy("asked").agg(F.min("plan").alias("plan"))
