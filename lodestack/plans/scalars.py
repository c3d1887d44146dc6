"""Registered queries of scalar functions, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..sources import corpus
from .reference import query

_DIGESTS = """g AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN sha256(event_id::VARCHAR) WHEN 1 THEN 'sha256:' || upper(sha256(event_id::VARCHAR)) WHEN 2 THEN substr(sha256(event_id::VARCHAR), 2) WHEN 3 THEN 'g' || substr(sha256(event_id::VARCHAR), 2) ELSE '' END AS d FROM events)"""


@query(f"""WITH {_DIGESTS}, b AS (SELECT event_id, CASE WHEN contains(d, ':') THEN substr(d, strpos(d, ':') + 1) ELSE d END AS bare FROM g)
SELECT event_id, bare, regexp_full_match(bare, '[0-9a-fA-F]{{64}}') AS valid, CASE WHEN regexp_full_match(bare, '[0-9a-fA-F]{{64}}') THEN lower(hex(unhex(bare))) END AS digest FROM b""")
def c02_c03_digests(spark, d):
    """Digests with and without the algorithm before them: which are 64 hexadecimal digits, and their bytes."""
    e = F.col("event_id")
    full = F.sha2(e.cast("string"), 256)
    text = F.when(e % 5 == 0, full).when(e % 5 == 1, F.concat(F.lit("sha256:"), F.upper(full))).when(e % 5 == 2, F.substring(full, 2, 64)).when(e % 5 == 3, F.concat(F.lit("g"), F.substring(full, 2, 64))).otherwise("")
    rows = corpus.table(spark, d, "events").select("event_id", X.bare_digest(text).alias("bare"))
    return rows.select("event_id", "bare", X.is_digest(F.col("bare")).alias("valid"), F.lower(F.hex(X.digest_bytes(F.col("bare")))).alias("digest"))


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_quantity AS BIGINT) - 1 AS total, l_linenumber - 1 AS parts FROM lineitem),
s AS (SELECT *, CASE WHEN total > 0 AND parts > 0 THEN CAST(ceil(total / parts::DOUBLE) AS BIGINT) END AS size FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, coalesce(array_to_string(list_transform(range(0, CAST(ceil(total / size::DOUBLE) AS BIGINT)), lambda i: (i * size) || '-' || (least((i + 1) * size, total) - 1)), ','), '') AS ranges FROM s""")
def c06_split_ranges(spark, d):
    """At most as many inclusive ranges as asked that cover a size."""
    total = F.col("l_quantity").cast("long") - 1
    ranges = X.split_ranges(total, F.col("l_linenumber") - 1)
    text = F.array_join(F.transform(ranges, lambda r: F.concat_ws("-", r["first"].cast("string"), r["last"].cast("string"))), ",")
    return corpus.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", text.alias("ranges"))


@query("""WITH t AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_id % 6 WHEN 0 THEN 'Z' WHEN 1 THEN '.250+05:30' WHEN 2 THEN '.123456Z' WHEN 3 THEN '-11:00' WHEN 4 THEN ' bad' ELSE '' END AS x, event_id % 7 = 0 AS gone FROM events)
SELECT event_id, CASE WHEN NOT gone AND regexp_matches(x, '(Z|[+-][0-9]{2}:[0-9]{2})$') THEN strftime(CAST(replace(x, 'Z', '+00:00') AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%fZ') END AS utc FROM t""")
def c09_utc_times(spark, d):
    """ISO times with `Z` or an offset as UTC; others, and missing ones, have none."""
    k = F.col("event_id") % 6
    tail = F.when(k == 0, "Z").when(k == 1, ".250+05:30").when(k == 2, ".123456Z").when(k == 3, "-11:00").when(k == 4, " bad").otherwise("")
    text = F.when(F.col("event_id") % 7 != 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), tail))
    return corpus.table(spark, d, "events").select("event_id", X.utc_time(text).alias("utc"))


@query("""WITH v AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CASE event_id % 8 WHEN 0 THEN event_id WHEN 1 THEN event_id * 256 WHEN 2 THEN event_id * 26214 WHEN 3 THEN event_id * 1048576 WHEN 4 THEN event_id * 107374182 WHEN 5 THEN event_id * 1099511627776 // 4 WHEN 6 THEN (event_id % 8000) * 1125899906842624 ELSE event_id * 50000 END END::BIGINT AS n FROM events)
SELECT event_id, CASE WHEN n IS NULL THEN '—' WHEN n < 1024 THEN n || ' B' WHEN n < 1024^2 THEN printf('%.1f KB', n / 1024.0::DOUBLE) WHEN n < 1024^3 THEN printf('%.1f MB', n / (1024^2)) WHEN n < 1024^4 THEN printf('%.1f GB', n / (1024^3)) WHEN n < 1024^5 THEN printf('%.1f TB', n / (1024^4))
  WHEN n < 1024^6 THEN printf('%.1f PB', n / (1024^5)) ELSE printf('%.1f EB', n / (1024^6)) END AS cli,
CASE WHEN n IS NULL THEN '—' WHEN n < 1024 THEN n || ' B' WHEN n < 1024^2 THEN printf('%.1f KB', n / 1024.0::DOUBLE) WHEN n < 1024^3 THEN printf('%.1f MB', n / (1024^2)) WHEN n < 1024^4 THEN printf('%.1f GB', n / (1024^3)) WHEN n < 1024^5 THEN printf('%.1f TB', n / (1024^4)) ELSE printf('%.1f PB', n / (1024^5)) END AS report,
CASE WHEN coalesce(n, 0) = 0 THEN '—' WHEN m >= 1e9 THEN printf('%.1fB', m / 1e9::DOUBLE) WHEN m >= 1e6 THEN printf('%.1fM', m / 1e6::DOUBLE) ELSE format('{:,}', m) END AS params
FROM (SELECT *, coalesce(n, 0) % 1000000000000 AS m FROM v) WHERE n IS NULL OR n = 0 OR m > 0""")
def c10_c11_human_numbers(spark, d):
    """Sizes in two ranges of units, and counts of parameters, as people read them."""
    e = F.col("event_id")
    n = F.when(e % 8 == 0, e).when(e % 8 == 1, e * 256).when(e % 8 == 2, e * 26214).when(e % 8 == 3, e * 1048576).when(e % 8 == 4, e * 107374182).when(e % 8 == 5, F.expr("event_id * 1099511627776 div 4")).when(e % 8 == 6, (e % 8000) * 1125899906842624).otherwise(e * 50000)
    rows = corpus.table(spark, d, "events").select("event_id", F.when(e % 11 != 0, n).cast("long").alias("n"))
    rows = rows.withColumn("m", F.coalesce("n", F.lit(0)) % 10**12).filter("n is null or n = 0 or m > 0")
    params = F.when(F.coalesce("n", F.lit(0)) == 0, "—").otherwise(X.human_params(F.col("m")))
    return rows.select("event_id", X.human_bytes(F.col("n")).alias("cli"), X.human_bytes(F.col("n"), "PB").alias("report"), params.alias("params"))


@query("""WITH b AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN '{"exp":' || event_id || '}' WHEN 1 THEN '{"exp":' || event_id || '.5,"sub":"ü?>"}' WHEN 2 THEN '{"sub":"x"}' WHEN 3 THEN '[1]' WHEN 4 THEN '{"exp":true}' WHEN 5 THEN '{"exp":"7"}' ELSE 'no json' END AS body FROM events),
t AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'one.two' WHEN 1 THEN 'a.!!!.c' ELSE 'h.' || rtrim(translate(to_base64(encode(body)), '+/', '-_'), '=') || '.s' END AS token FROM b),
s AS (SELECT event_id, CASE WHEN len(string_split(token, '.')) = 3 THEN translate(string_split(token, '.')[2], '-_', '+/') END AS seg FROM t),
j AS (SELECT event_id, CASE WHEN regexp_full_match(seg, '[A-Za-z0-9+/]*') THEN TRY(decode(from_base64(seg || repeat('=', (4 - length(seg) % 4) % 4)))) END AS body FROM s)
SELECT event_id, CASE WHEN json_valid(body) AND json_type(body, '$.exp') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN json_extract(body, '$.exp')::DOUBLE END AS exp FROM j""")
def c17_token_expiry(spark, d):
    """When tokens expire; those of another form, or without a number there, don't say."""
    e = F.col("event_id")
    k, text = e % 7, e.cast("string")
    body = F.when(k == 0, F.concat(F.lit('{"exp":'), text, F.lit("}"))).when(k == 1, F.concat(F.lit('{"exp":'), text, F.lit('.5,"sub":"ü?>"}'))).when(k == 2, '{"sub":"x"}').when(k == 3, "[1]").when(k == 4, '{"exp":true}').when(k == 5, '{"exp":"7"}').otherwise("no json")
    part = F.rtrim(F.translate(F.base64(F.encode(body, "UTF-8")), "+/", "-_"), F.lit("="))
    token = F.when(e % 9 == 0, "one.two").when(e % 9 == 1, "a.!!!.c").otherwise(F.concat(F.lit("h."), part, F.lit(".s")))
    return corpus.table(spark, d, "events").select("event_id", X.token_expiry(token).alias("exp"))


@query("""WITH h AS (SELECT event_id, to_base64(encode(CASE WHEN event_id % 3 = 0 THEN 'robot$' || user_id || ':s:e:c' ELSE event_type || ':' END)) AS b FROM events)
SELECT event_id, split_part(decode(from_base64(b)), ':', 1) AS name FROM h""")
def c18_login_names(spark, d):
    """The name in a basic login: what stands before the first `:`."""
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("robot$"), F.col("user_id").cast("string"), F.lit(":s:e:c"))).otherwise(F.concat("event_type", F.lit(":")))
    return corpus.table(spark, d, "events").select("event_id", X.basic_user(F.base64(F.encode(text, "UTF-8"))).alias("name"))


@query("""WITH k AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN ['LocalEntryNotFoundError', 'EntryNotFoundError'] WHEN 1 THEN ['GatedRepoError', 'RepositoryNotFoundError', 'HfHubHTTPError'] WHEN 2 THEN ['ConcurrentManifestUpdateError', 'HfHubHTTPError'] WHEN 3 THEN ['HfHubHTTPError'] WHEN 4 THEN ['EntryNotFoundError'] ELSE ['ValueError'] END AS kinds FROM events),
c AS (SELECT * FROM (VALUES (1, 'LocalEntryNotFoundError', 13), (2, 'EntryNotFoundError', 10), (3, 'GatedRepoError', 14), (4, 'DisabledRepoError', 14), (5, 'RepositoryNotFoundError', 11), (6, 'RevisionNotFoundError', 12), (7, 'ConcurrentManifestUpdateError', 15), (8, 'HfHubHTTPError', 16)) v(place, kind, code))
SELECT event_id, coalesce(arg_min(code, place), 1)::INTEGER AS code FROM k LEFT JOIN c ON list_contains(kinds, kind) GROUP BY event_id""")
def c23_exit_codes(spark, d):
    """The exit code of an error by its own kind and those above it; the more special kind counts."""
    kinds = [["LocalEntryNotFoundError", "EntryNotFoundError"], ["GatedRepoError", "RepositoryNotFoundError", "HfHubHTTPError"], ["ConcurrentManifestUpdateError", "HfHubHTTPError"], ["HfHubHTTPError"], ["EntryNotFoundError"], ["ValueError"]]
    every = F.array(*[F.array(*[F.lit(k) for k in own]) for own in kinds])
    own = F.get(every, (F.col("event_id") % 6).cast("int"))
    return corpus.table(spark, d, "events").select("event_id", X.exit_code(own).alias("code"))


@query("""SELECT event_id, ts < (SELECT max(ts) FROM events) - to_seconds(30 + event_id % 4000000) AS stale_token, event_id % 3 = 0 OR ts < (SELECT max(ts) FROM events) - INTERVAL 24 HOUR AS check_due FROM events""")
def t06_time_to_live(spark, d):
    """What has run out: a token counts until 30 s before it expires, a check of versions for 24 hours. Now is the last time there is."""
    rows = corpus.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    now = rows.agg(F.max("ts").alias("now"))
    stale = F.unix_micros("ts") < F.unix_micros("now") - (30 + F.col("event_id") % 4_000_000) * 1_000_000
    due = (F.col("event_id") % 3 == 0) | (F.unix_micros("ts") < F.unix_micros("now") - 24 * 3_600_000_000)
    return rows.join(F.broadcast(now)).select("event_id", stale.alias("stale_token"), due.alias("check_due"))  # one row
