"""Registered queries of pointers, manifests, stores and reading back, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunking, packing, pointers, sinks
from ..sources import corpus
from .reference import _CHUNKS, _FOLD, _INDEX, _PLAN, CHUNK, PACK, _chunks, _planned, _refs, query

#: bytes from which a file is stored by chunks
LARGE = 2048
CONFIG = "sha256:" + "0" * 64
_PACKS = """n AS (SELECT w.file_id, w.pack_idx, sum(w.size)::BIGINT AS size, count(*) AS n_chunks, sha256(unhex(string_agg(hex(h.payload), '' ORDER BY w.pack_offset))) AS digest
  FROM w JOIN h USING (file_id, chunk_idx) WHERE w.pack_idx IS NOT NULL GROUP BY w.file_id, w.pack_idx),
r AS (SELECT w.file_id, w.chunk_idx, w.digest, w.size, coalesce(w.pack_digest, 'sha256:' || n.digest) AS pack, w.pack_offset FROM w LEFT JOIN n USING (file_id, pack_idx)),
fd AS (SELECT file_id, repo, sha256(content) AS digest, octet_length(content)::BIGINT AS size, repo || '\\' || file_id AS title FROM f),
z AS (SELECT pack, max(size) AS size FROM (SELECT 'sha256:' || digest AS pack, size FROM n UNION ALL SELECT 'sha256:' || digest, size FROM fd WHERE file_id % 10 <> 0 AND file_id % 11 <> 0) GROUP BY 1)"""
_POINTERS = """p AS (SELECT file_id, '{"chunks":[' || string_agg('{"digest":"sha256:' || r.digest || '","offset":' || pack_offset || ',"pack":"' || pack || '","size":' || r.size || '}', ',' ORDER BY chunk_idx)
  || '],"file":{"digest":"sha256:' || any_value(fd.digest) || '","size":' || any_value(fd.size) || '},"version":"chunked-v2"}' AS pointer, count(*) AS n_chunks FROM r JOIN fd USING (file_id) GROUP BY file_id)"""
_ALL = f"{_PLAN}, {_PACKS}, {_POINTERS}"


def _files(spark: SparkSession, d: str) -> DataFrame:
    files = corpus.files(spark, d)
    return files.select("file_id", "repo", F.sha2("content", 256).alias("digest"), F.octet_length("content").cast("long").alias("size"), F.concat_ws("\\", "repo", F.col("file_id").cast("string")).alias("title"))


def _packs(spark: SparkSession, d: str, plan: DataFrame) -> DataFrame:
    return packing.pack_digests(plan, _chunks(spark, d))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    plan = _planned(spark, d)
    return pointers.resolve(plan, _packs(spark, d, plan))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of new packs and of those of the earlier revision, some of which no manifest lists."""
    name = F.concat(F.lit("sha256:"), "digest").alias("pack")
    new = _packs(spark, d, _planned(spark, d)).select(name, "size")
    return new.unionByName(_files(spark, d).filter("file_id % 10 <> 0 and file_id % 11 <> 0").select(name, "size"))


@query(f"WITH RECURSIVE {_ALL} SELECT file_id, chunk_idx, digest, size, pack, pack_offset FROM r")
def j04_x07_resolved_chunks(spark, d):
    """Each chunk with the digest of the pack that holds it, reused or new."""
    return _resolved(spark, d)


@query(f"WITH RECURSIVE {_ALL} SELECT file_id, pointer, n_chunks FROM p")
def n02_pointer_json(spark, d):
    """The canonical pointer of each file, byte by byte."""
    return pointers.write_pointers(_resolved(spark, d), _files(spark, d))


@query(f"""WITH RECURSIVE {_ALL}, b AS (SELECT file_id, CASE file_id % 7 WHEN 0 THEN replace(pointer, 'chunked-v2', 'chunked-v9') WHEN 1 THEN regexp_replace(pointer, '"offset":[0-9]+,', '') WHEN 2 THEN regexp_replace(pointer, '"size":([0-9]+)', '"size":"x"')
  WHEN 3 THEN regexp_replace(pointer, '"chunks":\\[.*\\],', '"chunks":[],') WHEN 4 THEN '{{' || pointer ELSE pointer END AS pointer FROM p)
SELECT file_id, CASE WHEN NOT json_valid(pointer) THEN 'not json' WHEN json_extract_string(pointer, '$.version') IS DISTINCT FROM 'chunked-v2' THEN 'version'
  WHEN len(list_filter(json_extract(pointer, '$.chunks[*]'), lambda c: try_cast(json_extract_string(c, '$.size') AS BIGINT) IS NULL OR try_cast(json_extract_string(c, '$.offset') AS BIGINT) IS NULL OR json_extract_string(c, '$.digest') IS NULL OR json_extract_string(c, '$.pack') IS NULL)) > 0 THEN 'chunk field'
  WHEN json_array_length(pointer, '$.chunks') = 0 THEN 'no chunks' END AS fault,
CASE WHEN file_id % 7 >= 5 THEN json_array_length(pointer, '$.chunks') END::BIGINT AS n_chunks FROM b""")
def n03_pointer_faults(spark, d):
    """Pointers, some of them spoilt, parsed: the first rule that each breaks, and the chunks of the sound ones."""
    k, text = F.col("file_id") % 7, F.col("pointer")
    spoilt = (
        F.when(k == 0, F.replace(text, F.lit("chunked-v2"), F.lit("chunked-v9")))
        .when(k == 1, F.concat(F.substring_index(text, '"offset":', 1), F.expr("substring(pointer, locate('\"pack\":', pointer))")))
        .when(k == 2, F.concat(F.substring_index(text, '"size":', 1), F.lit('"size":"x"'), F.expr("substring(pointer, locate('}', pointer))")))
        .when(k == 3, F.regexp_replace(text, r'"chunks":\[.*\],', '"chunks":[],'))
        .when(k == 4, F.concat(F.lit("{"), text))
        .otherwise(text)
    )
    rows = pointers.parse_pointers(n02_pointer_json(spark, d).select("file_id", spoilt.alias("pointer")))
    return rows.select("file_id", "fault", F.when(F.col("fault").isNull(), F.size("doc.chunks")).cast("long").alias("n_chunks"))


@query(f"""WITH RECURSIVE {_ALL} SELECT file_id, 'application/vnd.chunked.pointer.v2' AS media_type, octet_length(encode(pointer))::BIGINT AS size, 'sha256:' || sha256(pointer) AS digest, replace(title, '\\', '/') AS title,
fd.size::VARCHAR AS file_size, 'sha256:' || fd.digest AS file_digest, n_chunks::VARCHAR AS chunk_count FROM p JOIN fd USING (file_id)""")
def x09_pointer_layers(spark, d):
    """The layer of each pointer: its own size and digest, and the file's in the annotations, as text."""
    rows = pointers.pointer_layers(n02_pointer_json(spark, d), _files(spark, d))
    note = lambda k: F.try_element_at("annotations", F.lit(k))
    return rows.select("file_id", "media_type", "size", "digest", note(pointers.TITLE).alias("title"), note(pointers.FILE_SIZE).alias("file_size"), note(pointers.FILE_DIGEST).alias("file_digest"), note(pointers.CHUNK_COUNT).alias("chunk_count"))


@query(f"""WITH RECURSIVE {_ALL}, o AS (SELECT file_id, pack, min(chunk_idx) AS first FROM r GROUP BY ALL)
SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY first) AS appearance, o.pack, z.size, z.size IS NULL AS malformed FROM o LEFT JOIN z USING (pack)""")
def x10_pack_layers(spark, d):
    """The packs of each file, once, in the order of first use; one of unknown size makes it malformed."""
    return pointers.pack_layers(_resolved(spark, d), _sizes(spark, d))


def _manifest_layers(spark: SparkSession, d: str) -> DataFrame:
    """Layers of each repository by file: a small file is one plain layer, a large one its pointer and its packs."""
    files = _files(spark, d)
    resolved = _resolved(spark, d).join(files.filter(F.col("size") >= LARGE).select("file_id"), "file_id", "left_semi")
    made = pointers.write_pointers(resolved, files)
    kind = "map<string,string>"
    plain = files.filter(F.col("size") < LARGE).select("file_id", F.lit(0).cast("long").alias("k"), F.lit(pointers.PLAIN).alias("media_type"), "size", F.concat(F.lit("sha256:"), "digest").alias("digest"), F.create_map(F.lit(pointers.TITLE), F.replace("title", F.lit("\\"), F.lit("/"))).alias("annotations"))
    heads = pointers.pointer_layers(made, files).withColumn("k", F.lit(0).cast("long"))
    packs = pointers.pack_layers(resolved, _sizes(spark, d)).filter("not malformed").select("file_id", F.col("appearance").alias("k"), F.lit(pointers.PACK).alias("media_type"), "size", F.col("pack").alias("digest"), F.lit(None).cast(kind).alias("annotations"))
    layers = plain.unionByName(heads).unionByName(packs).join(files.select("file_id", "repo"), "file_id")
    return layers.select("repo", F.struct("file_id", "k").alias("layer_idx"), "media_type", "size", "digest", "annotations")


@query(f"""WITH RECURSIVE {_ALL}, o AS (SELECT file_id, pack, min(chunk_idx) AS first FROM r GROUP BY ALL),
ly AS (SELECT repo, file_id, 0::BIGINT AS k, false AS chunked, '{{"mediaType": "application/octet-stream", "size": ' || size || ', "digest": "sha256:' || digest || '", "annotations": {{"org.opencontainers.image.title": "' || replace(title, '\\', '/') || '"}}}}' AS j FROM fd WHERE size < {LARGE}
  UNION ALL SELECT repo, file_id, 0, true, '{{"mediaType": "application/vnd.chunked.pointer.v2", "size": ' || octet_length(encode(pointer)) || ', "digest": "sha256:' || sha256(pointer) || '", "annotations": {{"org.opencontainers.image.title": "' || replace(title, '\\', '/')
    || '", "chunked.file.size": "' || fd.size || '", "chunked.file.digest": "sha256:' || fd.digest || '", "chunked.chunk.count": "' || n_chunks || '"}}}}' FROM p JOIN fd USING (file_id) WHERE fd.size >= {LARGE}
  UNION ALL SELECT fd.repo, o.file_id, row_number() OVER (PARTITION BY o.file_id ORDER BY first), false, '{{"mediaType": "application/vnd.chunked.pack.v1", "size": ' || z.size || ', "digest": "' || o.pack || '"}}' AS j FROM o JOIN fd USING (file_id) LEFT JOIN z ON z.pack = o.pack WHERE fd.size >= {LARGE} QUALIFY j IS NOT NULL),
m AS (SELECT repo, '{{"schemaVersion": 2, "mediaType": "application/vnd.oci.image.manifest.v1+json", "config": {{"mediaType": "application/vnd.oci.empty.v1+json", "digest": "{CONFIG}", "size": 2}}, "layers": ['
  || string_agg(j, ', ' ORDER BY file_id, k) || '], "annotations": {{' || CASE WHEN bool_or(chunked) THEN '"chunked.layout": "chunked-v2"' ELSE '' END || '}}' || CASE WHEN bool_or(chunked) THEN ', "artifactType": "application/vnd.chunked.v2"' ELSE '' END || '}}' AS t, count(*) AS n_layers FROM ly GROUP BY repo)
SELECT repo, n_layers, octet_length(encode(t))::BIGINT AS bytes, octet_length(encode(t)) <= {pointers.MANIFEST_CAP} AS fits, sha256(regexp_replace(t, '([:,]) (["{{\\[0-9])', '\\1\\2', 'g')) AS digest FROM m""")
def x12_n07_f18_k06_manifests(spark, d):
    """The manifest of each repository: layers in order, typed as chunked if any pointer is among them, its size as sent, and whether a registry takes it."""
    made = pointers.assemble(_manifest_layers(spark, d), CONFIG, 2)
    return made.select("repo", "n_layers", "bytes", "fits", F.sha2(F.encode("manifest", "UTF-8"), 256).alias("digest"))


@query(f"""WITH RECURSIVE {_ALL}, o AS (SELECT *, sum(size) OVER (PARTITION BY file_id ORDER BY chunk_idx)::BIGINT - size AS file_offset FROM r),
g AS (SELECT file_id, pack, min(chunk_idx) AS first, string_agg(pack_offset || '+' || size || '@' || file_offset || '=' || digest, ',' ORDER BY chunk_idx) AS targets FROM o GROUP BY ALL)
SELECT file_id, g.pack, row_number() OVER (PARTITION BY file_id ORDER BY first) AS appearance, z.size AS pack_size, targets FROM g LEFT JOIN z USING (pack)""")
def x13_read_plan(spark, d):
    """What to fetch for each file: every pack once, in the order of first use, with the places of its chunks."""
    plan = pointers.read_plan(_resolved(spark, d), _sizes(spark, d))
    text = lambda t: F.concat(t["offset"].cast("string"), F.lit("+"), t["size"].cast("string"), F.lit("@"), t["file_offset"].cast("string"), F.lit("="), t["digest"])
    return plan.select("file_id", "pack", "appearance", "pack_size", F.array_join(F.transform("targets", text), ",").alias("targets"))


def _pack_contents(spark: SparkSession, d: str) -> DataFrame:
    """(pack, content) of new packs and of the earlier revision's, one a digest; some are lost, some spoilt."""
    plan = _planned(spark, d).filter("pack_idx is not null").join(_chunks(spark, d).select("file_id", "chunk_idx", "payload"), ["file_id", "chunk_idx"])
    new = packing.pack_contents(plan).select(F.concat(F.lit("sha256:"), "digest").alias("pack"), "content")
    old = corpus.files(spark, d).filter("file_id % 10 <> 0 and file_id % 17 <> 0").select(F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("pack"), F.when(F.col("file_id") % 19 == 0, F.reverse(F.hex("content")).cast("binary")).otherwise(F.col("content")).alias("content"))
    return new.unionByName(old).groupBy("pack").agg(F.min("content").alias("content"))


@query(f"""WITH RECURSIVE {_ALL}, y AS (SELECT pack, min(content) AS content FROM (
  SELECT 'sha256:' || n.digest AS pack, unhex(string_agg(hex(h.payload), '' ORDER BY w.pack_offset)) AS content FROM n JOIN w USING (file_id, pack_idx) JOIN h USING (file_id, chunk_idx) GROUP BY n.file_id, n.pack_idx, n.digest
  UNION ALL SELECT 'sha256:' || sha256(content), CASE WHEN file_id % 19 = 0 THEN encode(reverse(hex(content))) ELSE content END FROM f WHERE file_id % 10 <> 0 AND file_id % 17 <> 0) GROUP BY 1),
o AS (SELECT *, sum(size) OVER (PARTITION BY file_id ORDER BY chunk_idx)::BIGINT - size AS file_offset FROM r)
SELECT file_id, file_offset, size, CASE WHEN content IS NULL THEN 'no pack' WHEN pack_offset + size > octet_length(content) THEN 'out of range' WHEN sha256(array_slice(content, pack_offset + 1, pack_offset + size)) = digest THEN 'sound' ELSE 'differs' END AS status FROM o LEFT JOIN y USING (pack)""")
def s11_scattered_chunks(spark, d):
    """The chunks of each file cut out of the packs and held against their digests; some packs are lost, some spoilt."""
    plan = pointers.read_plan(_resolved(spark, d), _sizes(spark, d))
    return pointers.scatter(plan, _pack_contents(spark, d)).select("file_id", "file_offset", "size", "status")


@query(f"""WITH {_CHUNKS} SELECT file_id, CASE WHEN file_id % 4 = 0 THEN 'not checked' WHEN sha256(CASE WHEN file_id % 9 = 0 THEN encode(repo) || content ELSE content END) = lower(sha256(content)) THEN 'sound' ELSE 'differs' END AS status FROM f""")
def x16_plain_download(spark, d):
    """A file that came whole against the digest of its layer, with or without the algorithm before it, in any case; some are not checked."""
    files = corpus.files(spark, d)
    layer = F.when(F.col("file_id") % 2 == 0, F.upper(F.sha2("content", 256))).otherwise(F.concat(F.lit("sha256:"), F.sha2("content", 256)))
    came = F.when(F.col("file_id") % 9 == 0, F.concat(F.encode("repo", "UTF-8"), "content")).otherwise(F.col("content"))
    same = F.sha2(came, 256) == F.lower(F.substring_index(layer, ":", -1))
    return files.select("file_id", F.when(F.col("file_id") % 4 == 0, "not checked").when(same, "sound").otherwise("differs").alias("status"))


@query(f"""WITH RECURSIVE {_CHUNKS}, {_INDEX.format(prior="file_id % 10 <> 0 AND NOT (file_digest IN (SELECT sha256(content) FROM f WHERE file_id % 17 = 0 OR file_id % 19 = 0))")}, {_FOLD}
SELECT file_id, chunk_idx, digest, size, reused, pack_digest, pack_idx, pack_offset FROM w""")
def x17_j07_healed_plan(spark, d):
    """The plan after two attempts found packs lost: what they held is packed anew."""
    name = F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("pack_digest")
    lost = [corpus.files(spark, d).filter(f"file_id % {k} = 0").select(name) for k in (17, 19)]
    return packing.heal(_chunks(spark, d).drop("payload"), _refs(spark, d), lost, PACK)


@query(f"""WITH {_CHUNKS}, g AS (SELECT 'sha256:' || sha256(content) AS pack_digest, 1 AS attempt FROM f WHERE file_id % 17 = 0 UNION ALL SELECT 'sha256:' || sha256(content), 2 FROM f WHERE file_id % 19 = 0)
SELECT pack_digest, min(attempt)::INTEGER AS attempt FROM g GROUP BY 1""")
def u05_excluded_packs(spark, d):
    """Packs found lost so far, with the attempt that found each first."""
    files = corpus.files(spark, d).select("file_id", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("pack_digest"))
    every = files.filter("file_id % 17 = 0").withColumn("attempt", F.lit(1)).unionByName(files.filter("file_id % 19 = 0").withColumn("attempt", F.lit(2)))
    return every.groupBy("pack_digest").agg(F.min("attempt").alias("attempt"))


@query(f"""WITH {_CHUNKS}, v AS (SELECT 'sha256:' || sha256(content) AS pack_digest, octet_length(content)::BIGINT + file_id % 3 AS size, file_id AS layer_idx FROM f)
SELECT pack_digest, arg_max(size, layer_idx) AS size FROM v GROUP BY 1""")
def a06_pack_sizes(spark, d):
    """The size of each pack as the last layer of its digest says."""
    layers = corpus.files(spark, d).select(F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("pack_digest"), F.col("file_id").alias("layer_idx"), (F.octet_length("content") + F.col("file_id") % 3).cast("long").alias("size"))
    return packing.pack_sizes(layers)


@query(f"""WITH {_CHUNKS} SELECT file_id, chunk_idx // 64 AS batch, min(chunk_idx) AS first_chunk, count(*) AS n_chunks, min("offset") AS "offset", sum(size)::BIGINT AS size FROM h GROUP BY file_id, chunk_idx // 64""")
def x04_chunk_batches(spark, d):
    """The chunks of each file in contiguous batches of 64."""
    return chunking.chunk_batches(_chunks(spark, d).drop("payload"))


@query(f"""WITH {_CHUNKS}, g AS (SELECT file_id, content, octet_length(content) AS n FROM f)
SELECT file_id, sha256(array_slice(content, n // 3 + 1, n // 3 + 100) || array_slice(content, 1, 50)) AS digest, n // 3 + 100 > n OR n < 50 AS short FROM g""")
def s09_ordered_ranges(spark, d):
    """Two ranges of each file read in the order asked and joined; a range that ends past the file makes the read short."""
    n = F.expr("octet_length(content)")
    asked = F.array(F.struct(F.expr("octet_length(content) div 3").cast("int").alias("offset"), F.lit(100).alias("size")), F.struct(F.lit(0).alias("offset"), F.lit(50).alias("size")))
    rows = corpus.files(spark, d).withColumn("asked", asked)
    return rows.select("file_id", F.sha2(pointers.read_ranges(F.col("content"), F.col("asked")), 256).alias("digest"), F.exists("asked", lambda r: r["offset"] + r["size"] > n).alias("short"))


@query(f"WITH {_CHUNKS} SELECT sha256(content) AS digest, octet_length(content)::BIGINT AS size, 1::BIGINT AS copies, (count(*) FILTER (file_id % 10 <> 0)) = 0 AS written_last FROM f GROUP BY ALL")
def k01_blob_store(spark, d):
    """Blobs written twice over, some the first time and all the second: each lies there once, by its digest."""
    blobs = corpus.files(spark, d).select("file_id", F.sha2("content", 256).alias("digest"), "content")
    path = sinks.scratch(spark, "blobs")
    sinks.write_missing(blobs.filter("file_id % 10 <> 0").drop("file_id"), path, "first")
    sinks.write_missing(blobs.drop("file_id"), path, "second")
    return spark.read.parquet(path).groupBy("digest", F.octet_length("content").cast("long").alias("size")).agg(F.count("*").alias("copies"), (F.max("batch") == "second").alias("written_last"))


@query(f"WITH RECURSIVE {_ALL} SELECT digest, any_value(size) AS size, 1::BIGINT AS copies, true AS sound FROM n GROUP BY digest")
def k02_pack_store(spark, d):
    """New packs written by their digest, and read back against it."""
    plan = _planned(spark, d).filter("pack_idx is not null").join(_chunks(spark, d).select("file_id", "chunk_idx", "payload"), ["file_id", "chunk_idx"])
    path = sinks.scratch(spark, "packs")
    sinks.write_missing(packing.pack_contents(plan).select("digest", "content"), path, "first")
    return spark.read.parquet(path).groupBy("digest").agg(F.min(F.octet_length("content")).cast("long").alias("size"), F.count("*").alias("copies"), F.bool_and(F.sha2("content", 256) == F.col("digest")).alias("sound"))


@query(f"""WITH {_CHUNKS} SELECT repo, file_id % 12 AS asked, repo || '/' || file_id AS title, CASE WHEN file_id % 12 < 8 THEN sha256(content) END AS digest FROM f""")
def k05_s12_cache(spark, d):
    """A cache of snapshots over blobs stored by digest: written where the digest proves right, then looked up without any other store; what isn't there is null."""
    files = corpus.files(spark, d).select("repo", (F.col("file_id") % 12).alias("revision"), F.concat_ws("/", "repo", F.col("file_id").cast("string")).alias("title"), F.sha2("content", 256).alias("digest"), "content")
    path = sinks.scratch(spark, "cache")
    sinks.write_cache(files.filter("revision < 8"), path)
    return sinks.look_up(spark, path, files.select("repo", "revision", "title")).select("repo", F.col("revision").alias("asked"), "title", "digest")


@query(f"""WITH {_CHUNKS} SELECT file_id, CASE WHEN file_id % 3 < 2 THEN octet_length(content) END::BIGINT AS size FROM f""")
def s04_blob_lookup(spark, d):
    """Small blobs fetched by digest; an unknown digest gives none."""
    files = corpus.files(spark, d)
    blobs = files.groupBy(F.sha2("content", 256).alias("digest")).agg(F.min("content").alias("content"))
    asked = files.select("file_id", F.when(F.col("file_id") % 3 < 2, F.sha2("content", 256)).otherwise(F.lit("none")).alias("digest"))
    return asked.join(blobs, "digest", "left").select("file_id", F.octet_length("content").cast("long").alias("size"))


@query("""WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 4 > 0 THEN 'part' || chr(92) || (event_id % 50) WHEN event_id % 8 = 0 THEN '' END AS title, event_id % 3 = 1 AS is_pointer, 100 + event_id % 900 AS size,
  CASE event_id % 5 WHEN 0 THEN 'x' WHEN 1 THEN '0' ELSE (event_id % 90)::VARCHAR END AS n, CASE WHEN event_id % 7 > 0 THEN (event_id * 1000)::VARCHAR END AS fs FROM events),
t AS (SELECT *, nullif(replace(title, chr(92), '/'), '') AS path FROM e)
SELECT user_id AS repo, event_id AS layer_idx, path AS title, is_pointer AS is_chunked, CASE WHEN is_pointer THEN try_cast(fs AS BIGINT) ELSE size END AS size, CASE WHEN is_pointer THEN 'sha256:' || sha256(user_id::VARCHAR) ELSE 'sha256:' || sha256(event_id::VARCHAR) END AS digest,
CASE WHEN is_pointer THEN 'chunked-v2' END AS layout, CASE WHEN is_pointer THEN 'sha256:' || sha256(event_id::VARCHAR) END AS pointer_digest,
is_pointer AND (coalesce(try_cast(n AS BIGINT), 0) < 1 OR fs IS NULL) AS malformed FROM t WHERE path IS NOT NULL""")
def f01_n01_annotated_files(spark, d):
    """Files of manifests with annotations: a pointer's size and digest are those of its file, from the annotations; a
    missing or bad one makes it malformed. Untitled layers are no files."""
    e = F.col("event_id")
    text = lambda c: c.cast("string")
    title = F.when(e % 4 > 0, F.concat(F.lit("part\\"), text(e % 50))).when(e % 8 == 0, "")
    count = F.when(e % 5 == 0, "x").when(e % 5 == 1, "0").otherwise(text(e % 90))
    notes = F.map_filter(F.create_map(F.lit(pointers.TITLE), title, F.lit(pointers.FILE_SIZE), F.when(e % 7 > 0, text(e * 1000)), F.lit(pointers.FILE_DIGEST), F.concat(F.lit("sha256:"), F.sha2(text(F.col("user_id")), 256)), F.lit(pointers.CHUNK_COUNT), count), lambda k, v: v.isNotNull())
    layers = corpus.table(spark, d, "events").select(F.col("user_id").alias("repo"), e.alias("layer_idx"), F.when(e % 3 == 1, pointers.POINTER).otherwise(pointers.PLAIN).alias("media_type"), (100 + e % 900).alias("size"), F.concat(F.lit("sha256:"), F.sha2(text(e), 256)).alias("digest"), notes.alias("annotations"))
    return pointers.group_annotated(layers)


@query("""WITH a AS (SELECT o_custkey AS repo, o_orderkey AS revision, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey * 10 WHEN o_orderkey % 3 = 1 THEN 0 END AS expected FROM orders),
f AS (SELECT *, expected IS NULL OR expected = repo * 10 AS fits FROM a)
SELECT repo::VARCHAR AS repo, revision::VARCHAR AS revision, CASE WHEN fits AND row_number() OVER (PARTITION BY repo, fits ORDER BY revision::VARCHAR) = 1 THEN 'committed' ELSE 'conflict' END AS outcome FROM f""")
def k04_commits(spark, d):
    """Commits to a log in which every repository has a first revision: those that expect it, or nothing, are taken, one a repository."""
    orders = corpus.table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("repo"), F.col("o_orderkey").cast("string").alias("revision"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") * 10).when(F.col("o_orderkey") % 3 == 1, 0).cast("string").alias("expected"))
    path, none = sinks.scratch(spark, "commits"), F.lit(None).cast("string")
    first = orders.select("repo").distinct()
    sinks.commit(first.select("repo", none.alias("expected"), (F.col("repo").cast("long") * 10).cast("string").alias("revision"), F.lit("{}").alias("manifest")), path)
    return sinks.commit(orders.withColumn("manifest", F.lit("{}")), path)
