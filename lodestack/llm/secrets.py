"""Operator 9: secret scanning with multipart credential linking.

Three base kinds are found everywhere. Parts of credentials that alone would be weak evidence (identifiers, secret
values, endpoints) are found too, and an interval join reports an identifier or value only where complementary parts
lie within the same scope. All of it is SQL functions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import fold
from .common import cut, free_name, table

#: base patterns and their least lengths: fixed values
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the run after AKIA is taken whole, so this finds the same as AKIA[A-Z0-9]+ of 20 or more
HEX = r"[0-9a-f]{24,}"  # runs are taken whole, so this finds the same as [0-9a-f]+ of 24 or more
KINDS = ("assign", "access", "hex", "ident", "value")
#: weak parts: they count only beside others
IDENT = r"(?i:access_?id|client_?id|account|username|user|login)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._+-]{3,}"
#: a value is a whole run of its characters, of any length; a run before `=` and more of them is a name
VALUE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}(?!=*[A-Za-z0-9+/_-])"
ENDPOINT = r"(?:https?://[A-Za-z0-9.-]+|\b(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?\b)"
SCOPE = 200
SPAN = "struct<start:int,end:int,kind:string>"
SPANS = f"array<{SPAN}>"


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Array of (start, end, kind) of the pattern's leftmost non-overlapping matches, in code points.

    The pieces between matches and the matches themselves alternate, so their running lengths are the places. Each
    regular expression runs over a text once, and the running lengths are summed in blocks, so a text of very many
    matches takes time in proportion.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    lengths = F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), part.alias("part")), lambda z: F.struct(F.length(z["gap"]).alias("gap"), F.length(z["whole"]).alias("size"), F.length(z["part"]).alias("part")))

    def step(at: Column, z: Column) -> tuple[Column, Column]:
        start = at + z["gap"]
        end = start + F.coalesce(z["size"], F.lit(0))  # after the last gap there is no match
        own = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind")))
        return end, F.when(z["part"] >= least, own).otherwise(F.array().cast(SPANS))

    return F.when(F.regexp_like(text, F.lit(pattern)), fold(lengths, F.lit(0), "int", step, SPAN)).otherwise(F.array().cast(SPANS)).cast(SPANS)


def order(found: Column) -> Column:
    """By start, then kind as listed, then end."""
    rank = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def listing(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, key (of its text), base spans, parts (weak spans, endpoints among them). Written once."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    base = F.concat(spans(F.col("text"), ASSIGN, "assign", 2, ASSIGN_LEAST), spans(F.col("text"), ACCESS, "access"), spans(F.col("text"), HEX, "hex"))
    parts = F.concat(spans(F.col("text"), IDENT, "ident"), spans(F.col("text"), VALUE, "value"), spans(F.col("text"), ENDPOINT, "endpoint"))
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("hash"), F.length("text").alias("length"))
    return cut(rows.select("doc_id", F.to_json(key).alias("key"), base.alias("base"), parts.alias("parts")), "parts")


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(key, weak): the weak spans of each text with complementary parts in scope. The join runs over (text, stretch of
    `scope` code points): a span asks in every stretch that it touches, and is found in every stretch within `scope` of it.

    An identifier needs a secret value or a base span in scope; a value needs an identifier, an endpoint or an access
    key. Parts inside a base span are part of that span.
    """
    rows = cut(scanned.select("key", "base", "parts").filter(F.size("parts") > 0).dropDuplicates(["key"]), "linking")
    weak = rows.select("key", F.explode("parts").alias("p")).select("key", "p.*")
    strong = rows.select("key", F.explode("base").alias("p")).select("key", "p.*")
    cells = lambda start, end: F.explode(F.sequence(F.floor(start / scope), F.floor(end / scope)))
    over = strong.withColumn("cell", cells(F.col("start"), F.col("end") - 1)).select("key", "cell", F.col("start").alias("_start"), F.col("end").alias("_end"))
    inside = weak.withColumn("cell", cells(F.col("start"), F.col("end") - 1)).join(over, ["key", "cell"]).filter("_start < end and start < _end")
    weak = weak.join(inside.select("key", "start", "end", "kind").distinct(), ["key", "start", "end", "kind"], "left_anti").select("key", "start", "end", "kind")
    every = weak.unionByName(strong)
    near = every.withColumn("cell", cells(F.col("start") - scope, F.col("end") + scope))
    near = near.select("key", "cell", *[F.col(c).alias(f"o_{c}") for c in ("start", "end", "kind")])
    close = (F.col("o_start") <= F.col("end") + scope) & (F.col("start") <= F.col("o_end") + scope)
    needs = ((F.col("kind") == "ident") & F.col("o_kind").isin("value", "assign", "access", "hex")) | ((F.col("kind") == "value") & F.col("o_kind").isin("ident", "endpoint", "access"))
    asked = every.filter(F.col("kind").isin("ident", "value")).withColumn("cell", cells(F.col("start"), F.col("end")))
    linked = asked.join(near, ["key", "cell"]).filter(close & needs).select("key", "start", "end", "kind").distinct()
    return linked.groupBy("key").agg(F.collect_list(F.struct("start", "end", "kind")).alias("weak"))


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, key, base and all (arrays of start, end, kind; in order)."""
    scanned = scan(docs)
    found = scanned.select("doc_id", "key", "base").join(link(scanned, scope), "key", "left")
    return found.select("doc_id", "key", order(F.col("base")).alias("base"), order(F.concat("base", F.coalesce("weak", F.array().cast(SPANS)))).alias("all"))


def secret_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    A null text counts as empty; a text without secrets has the SHA-256 of nothing and an empty listing. Repeated
    rows are each reported; a null doc_id stays null; other columns are ignored; an empty table gives an empty result.
    """
    found = secret_spans(docs, scope)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(listing(F.col("base")), 256).alias("base_sha256"), listing(F.col("all")).alias("spans"), (F.size("all") - F.size("base")).cast("long").alias("n_linked"))


def redact(text: Column, found: Column) -> Column:
    """The text with each found span, overlapping ones as one, replaced by [kind]."""

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        gap = F.when(s["start"] > at, F.substring(text, at + 1, s["start"] - at)).otherwise("")
        mark = F.when(s["start"] >= at, F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.greatest(at, s["end"]), F.array(gap, mark)

    pieces = fold(found, F.lit(0), "int", step, "string")
    clean = F.concat(F.array_join(pieces, ""), F.substring(text, F.array_max(F.transform(found, lambda s: s["end"])) + 1, F.length(text)))
    return F.when(F.size(found) > 0, clean).otherwise(text)


def redact_documents(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The documents with secrets replaced and n_chars recounted where a text changed; no row is lost.

    Only texts with a finding meet the spans in a join; the others pass by, null and empty ones among them. Rows that
    repeat are each redacted, and rows with a null doc_id as any other; an empty table stays empty. All other columns
    are kept as they are, whatever their names.
    """
    spotted = secret_spans(docs, scope)
    found = cut(spotted.filter(F.size("all") > 0).select("key", "all").dropDuplicates(["key"]), "found")
    text, cols = F.col("text"), docs.columns
    name, spans_of = free_name(cols, "key"), free_name(cols, "spans")
    key = F.to_json(F.struct(F.col("doc_id"), F.xxhash64("text").alias("hash"), F.length("text").alias("length")))
    joined = docs.withColumn(name, F.when(text.isNotNull(), key)).join(found.withColumnsRenamed({"key": name, "all": spans_of}), name, "left")
    changed = F.col(spans_of).isNotNull()
    joined = joined.withColumn("text", F.when(changed, redact(text, F.col(spans_of))).otherwise(text))
    if "n_chars" in cols:
        joined = joined.withColumn("n_chars", F.when(changed, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return joined.select(*cols)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))
