"""Pointers of chunked files, manifests with their layers, and plans for reading files back.

A pointer is the canonical JSON that says in which pack, and where in it, each chunk of a file lies. A manifest lists the
layers of a repository: plain files, pointers, and the packs that pointers refer to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: names in the formats, which another deployment replaces by its own: fixed values of a deployment
LAYOUT = "chunked-v2"
POINTER, PACK, PLAIN = "application/vnd.chunked.pointer.v2", "application/vnd.chunked.pack.v1", "application/octet-stream"
ARTIFACT = "application/vnd.chunked.v2"
TITLE, FILE_SIZE, FILE_DIGEST, CHUNK_COUNT, LAYOUT_KEY = "org.opencontainers.image.title", "chunked.file.size", "chunked.file.digest", "chunked.chunk.count", "chunked.layout"
#: bytes that a registry takes as one manifest
MANIFEST_CAP = 4 << 20

POINTER_TYPE = "struct<chunks:array<struct<digest:string,offset:bigint,pack:string,size:bigint>>,file:struct<digest:string,size:bigint>,version:string>"


def resolve(planned: DataFrame, packs: DataFrame) -> DataFrame:
    """Each planned chunk with the pack that holds it: the index's for a reused one, the new pack's digest for the rest.

    `packs` has (file_id, pack_idx, digest). A chunk whose pack is not among them has a null pack.
    """
    new = packs.select("file_id", F.col("pack_idx"), F.concat(F.lit("sha256:"), "digest").alias("_new"))
    joined = planned.join(new, ["file_id", "pack_idx"], "left")
    return joined.select("file_id", "chunk_idx", "digest", "size", F.coalesce("pack_digest", "_new").alias("pack"), "pack_offset")


def pointer_json(chunks: Column, size: Column, digest: Column) -> Column:
    """Canonical JSON: keys in order, no white space. `chunks` is an array of (digest, offset, pack, size) in file order."""
    file = F.struct(F.concat(F.lit("sha256:"), digest).alias("digest"), size.alias("size"))
    return F.to_json(F.struct(chunks.alias("chunks"), file.alias("file"), F.lit(LAYOUT).alias("version")))


def write_pointers(resolved: DataFrame, files: DataFrame) -> DataFrame:
    """(file_id, pointer, n_chunks) of the files (file_id, size, digest) that have chunks.

    The chunks of one file come together, as they do in its pointer.
    """
    item = F.struct("chunk_idx", F.struct(F.concat(F.lit("sha256:"), "digest").alias("digest"), F.col("pack_offset").alias("offset"), "pack", "size").alias("c"))
    own = resolved.groupBy("file_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["c"]).alias("chunks"))
    return own.join(files.select("file_id", "size", "digest"), "file_id").select("file_id", pointer_json(F.col("chunks"), F.col("size"), F.col("digest")).alias("pointer"), F.size("chunks").cast("long").alias("n_chunks"))


def parse_pointers(pointers: DataFrame) -> DataFrame:
    """Adds doc (POINTER_TYPE) and fault: null for a sound pointer, else the first rule it breaks.

    Rules: it is JSON, has this version, every chunk has all its fields (integers as integers or digits), at least one chunk.
    """
    loose = "struct<chunks:array<struct<digest:string,offset:string,pack:string,size:string>>,file:struct<digest:string,size:string>,version:string>"
    rows = pointers.withColumn("_loose", F.from_json("pointer", loose))
    text = F.col("_loose")
    whole = lambda c: c["digest"].isNotNull() & c["pack"].isNotNull() & c["offset"].try_cast("bigint").isNotNull() & c["size"].try_cast("bigint").isNotNull()
    fault = (
        F.when(F.try_parse_json("pointer").isNull(), "not json")
        .when(~F.coalesce(text["version"] == LAYOUT, F.lit(False)), "version")
        .when(text["chunks"].isNull() | ~F.coalesce(F.forall(text["chunks"], lambda c: F.coalesce(whole(c), F.lit(False))), F.lit(True)), "chunk field")
        .when(F.size(text["chunks"]) == 0, "no chunks")
    )
    return rows.withColumn("doc", F.from_json("pointer", POINTER_TYPE)).withColumn("fault", fault).drop("_loose")


def pointer_layers(pointers: DataFrame, files: DataFrame) -> DataFrame:
    """(file_id, media_type, size, digest, annotations) of each pointer; integers in annotations are text."""
    f = files.select("file_id", "title", F.col("size").alias("_size"), F.col("digest").alias("_digest"))
    notes = F.create_map(
        F.lit(TITLE), F.replace("title", F.lit("\\"), F.lit("/")), F.lit(FILE_SIZE), F.col("_size").cast("string"),
        F.lit(FILE_DIGEST), F.concat(F.lit("sha256:"), "_digest"), F.lit(CHUNK_COUNT), F.col("n_chunks").cast("string"),
    )
    raw = F.encode("pointer", "UTF-8")
    return pointers.join(f, "file_id").select("file_id", F.lit(POINTER).alias("media_type"), F.octet_length(raw).cast("long").alias("size"), F.concat(F.lit("sha256:"), F.sha2(raw, 256)).alias("digest"), notes.alias("annotations"))


def pack_layers(resolved: DataFrame, sizes: DataFrame) -> DataFrame:
    """(file_id, appearance, pack, size, malformed): the packs that each file refers to, once, in the order of their
    first chunk; one without a known size makes the file malformed. `sizes` has (pack, size)."""
    packs = resolved.groupBy("file_id", "pack").agg(F.min("chunk_idx").alias("first"))
    order = Window.partitionBy("file_id").orderBy("first")
    known = sizes.groupBy("pack").agg(F.max("size").alias("size"))
    packs = packs.withColumn("appearance", F.row_number().over(order).cast("long")).join(known, "pack", "left")
    return packs.select("file_id", "appearance", "pack", "size", F.col("size").isNull().alias("malformed"))


def assemble(layers: DataFrame, config_digest: str, config_size: int) -> DataFrame:
    """(repo, manifest, n_layers, bytes, fits) from layers (repo, layer_idx, media_type, size, digest, annotations).

    A manifest with a pointer among its layers has an artifactType and the layout annotation; any other has neither.
    `bytes` is the size of the body as it is sent, with a space after each comma and colon and other than ASCII
    characters escaped; only what a registry takes as one body fits. The layers of one repository come together, as they
    do in its manifest.
    """
    notes = F.when(F.size("annotations") > 0, F.col("annotations"))
    layer = F.struct(F.col("media_type").alias("mediaType"), "size", "digest", notes.alias("annotations"))
    entries = F.when(F.size("annotations") > 0, F.size("annotations")).otherwise(0)
    rows = layers.select("repo", "layer_idx", "media_type", F.to_json(layer).alias("json"), (5 + F.when(entries > 0, 1 + 2 * entries).otherwise(0)).alias("spaces"))
    own = rows.groupBy("repo").agg(F.array_sort(F.collect_list(F.struct("layer_idx", "json"))).alias("layers"), F.bool_or(F.col("media_type") == POINTER).alias("chunked"), F.sum("spaces").alias("spaces"))
    kind = F.when(F.col("chunked"), F.lit(f',"artifactType":"{ARTIFACT}"')).otherwise("")
    extra = F.when(F.col("chunked"), F.lit(f'"{LAYOUT_KEY}":"{LAYOUT}"')).otherwise("")
    head = f'{{"schemaVersion":2,"mediaType":"application/vnd.oci.image.manifest.v1+json","config":{{"mediaType":"application/vnd.oci.empty.v1+json","digest":"{config_digest}","size":{config_size}}},"layers":['
    text = F.concat(F.lit(head), F.array_join("layers.json", ","), F.lit('],"annotations":{'), extra, F.lit("}"), kind, F.lit("}"))
    escaped = F.regexp_replace(F.regexp_replace("manifest", r"[\x{10000}-\x{10FFFF}]", "x" * 12), r"[^\x00-\x7F]", "x" * 6)
    n, spaces = F.size("layers"), F.col("spaces") + F.when(F.col("chunked"), 12).otherwise(9) + 5
    made = own.select("repo", text.alias("manifest"), n.cast("long").alias("n_layers"), (spaces + n - 1).alias("_spaces"))
    made = made.withColumn("bytes", F.length(escaped) + F.col("_spaces")).drop("_spaces")
    return made.withColumn("fits", F.col("bytes") <= MANIFEST_CAP)


def read_plan(resolved: DataFrame, sizes: DataFrame) -> DataFrame:
    """(file_id, pack, appearance, pack_size, targets): what to fetch for each file, each pack once, in the order of
    first use. A target is (offset in the pack, size, offset in the file, digest); a pack without a size has a null one."""
    own = Window.partitionBy("file_id").orderBy("chunk_idx").rowsBetween(Window.unboundedPreceding, 0)
    placed = resolved.withColumn("file_offset", F.sum("size").over(own) - F.col("size"))
    target = F.struct("chunk_idx", F.struct(F.col("pack_offset").alias("offset"), "size", "file_offset", "digest").alias("t"))
    plan = placed.groupBy("file_id", "pack").agg(F.min("chunk_idx").alias("_first"), F.transform(F.array_sort(F.collect_list(target)), lambda x: x["t"]).alias("targets"))
    plan = plan.withColumn("appearance", F.row_number().over(Window.partitionBy("file_id").orderBy("_first")).cast("long"))
    return plan.join(sizes.groupBy("pack").agg(F.max("size").alias("pack_size")), "pack", "left").select("file_id", "pack", "appearance", "pack_size", "targets")


def scatter(plan: DataFrame, packs: DataFrame) -> DataFrame:
    """(file_id, file_offset, size, payload, status): the chunks cut out of their packs (pack, content).

    A pack meets the files that need it, not their chunks: its bytes are joined once for each file. Status is `sound`,
    `differs` from the digest, `out of range` or `no pack`.
    """
    rows = plan.join(packs.select("pack", "content"), "pack", "left")

    def cut_out(t: Column) -> Column:
        part = F.substring(F.col("content"), t["offset"].cast("int") + 1, t["size"].cast("int"))
        inside = (t["offset"] >= 0) & (t["offset"] + t["size"] <= F.octet_length("content"))
        status = F.when(F.col("content").isNull(), "no pack").when(~inside, "out of range").when(F.sha2(part, 256) == t["digest"], "sound").otherwise("differs")
        return F.struct(t["file_offset"].alias("file_offset"), t["size"].alias("size"), F.when(status == "sound", part).alias("payload"), status.alias("status"))

    return rows.select("file_id", F.explode(F.transform("targets", cut_out)).alias("c")).select("file_id", "c.*")


def read_ranges(content: Column, ranges: Column) -> Column:
    """The bytes of (offset, size) ranges in the order of the array, joined; a range past the end gives what is there."""
    part = F.transform(ranges, lambda r: F.hex(F.substring(content, r["offset"].cast("int") + 1, r["size"].cast("int"))))
    return F.unhex(F.array_join(part, ""))


def group_annotated(layers: DataFrame) -> DataFrame:
    """(repo, layer_idx, title, is_chunked, size, digest, layout, pointer_digest, malformed) of layers with annotations.

    Only titled layers are files. A pointer stands for its file: size and digest are those in its annotations, where
    integers are text; it is malformed without them or with a chunk count below 1.
    """
    note = lambda k: F.try_element_at("annotations", F.lit(k))
    chunked = F.col("media_type") == POINTER
    size, count = note(FILE_SIZE).try_cast("long"), note(CHUNK_COUNT).try_cast("long")
    bad = size.isNull() | note(FILE_DIGEST).isNull() | F.coalesce(count < 1, F.lit(True))
    title = F.nullif(F.replace(note(TITLE), F.lit("\\"), F.lit("/")), F.lit(""))
    return layers.withColumn("title", title).filter("title is not null").select(
        "repo", "layer_idx", "title", chunked.alias("is_chunked"),
        F.when(chunked, size).otherwise(F.col("size")).alias("size"),
        F.when(chunked, note(FILE_DIGEST)).otherwise(F.col("digest")).alias("digest"),
        F.when(chunked, LAYOUT).alias("layout"), F.when(chunked, F.col("digest")).alias("pointer_digest"), (chunked & bad).alias("malformed"),
    )
