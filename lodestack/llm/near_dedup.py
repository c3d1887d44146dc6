"""Operator 1: near-duplicate removal by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batches, cut, free_name, remove, table
from .components import components
from .kernels import mix, text_buffer
from .weighted import BATCH_BYTES, Sampler, Weights, learn_weights, shingle_sets, weighted_jaccard

WIDTH, SIMILARITY = 5, 0.8
#: samples a document; bands of so many samples each (a sample serves in several bands)
SAMPLES, BANDS, BAND_SIZE = 48, 32, 6
#: what is left is compared pair by pair with weights in this many units of 1; an occurrence of a shingle weighs 1.5 at most, so 16 bits hold it
UNITS = 1 << 15
#: rounds of comparing buckets with one member each, before what is left is compared pairwise; shingles remembered by a verifying task
STAR_ROUNDS, MEMORY = 6, 1 << 20
#: members of an open bucket that one task compares with all of that bucket
BLOCK = 1024


def band_members(samples: int = SAMPLES, bands: int = BANDS, size: int = BAND_SIZE) -> np.ndarray:
    """Which samples make up each band: every sample in as many bands as any other, no two bands alike."""
    pick, rows = np.random.default_rng(3), []
    while len(rows) < bands:
        rows += [r for r in pick.permutation(samples).reshape(-1, size)]
    return np.array(rows[:bands])


def features(docs: DataFrame, weights: Weights, width: int = WIDTH) -> DataFrame:
    """Per document with an id and a text: doc_id, digest (of the text), mass (sum of weights), bands (keys; none without shingles)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, members, weigh = Sampler(SAMPLES), band_members(), shared.value
        steps = mix(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32))
        for batch in batches(it, BATCH_BYTES):
            data, offsets = text_buffer(batch.column("text"))
            sets = [(h, weigh(h, tf)) for h, tf in shingle_sets(data, offsets, width)]
            samples = sampler(sets)
            keys = np.broadcast_to(steps, (len(sets), BANDS)).copy()
            for j in range(BAND_SIZE):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + samples[:, members[:, j]])
            raw, at = data.tobytes(), offsets.tolist()
            digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            some = [len(h) > 0 for h, _ in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(digests, pa.binary()),
                    pa.array([float(w.sum()) for _, w in sets]),
                    pa.array([k if s else k[:0] for k, s in zip(keys.view(np.int64), some, strict=True)], pa.list_(pa.int64())),
                ],
                ["doc_id", "digest", "mass", "bands"],
            )

    return docs.filter("doc_id is not null").mapInArrow(run, "doc_id long, digest binary, mass double, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, weights: Weights, width: int = WIDTH, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose texts' exact weighted Jaccard similarity is at least `least`."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh, known, held = shared.value, {}, 0

        def weighted(node: int, text: str) -> tuple[np.ndarray, np.ndarray]:
            nonlocal held
            if node not in known:
                if held > MEMORY:  # a text met again is then weighed again
                    known.clear()
                    held = 0
                raw = np.frombuffer(text.encode(), np.uint8)
                h, tf = shingle_sets(raw, np.array([0, len(raw)]), width)[0]
                known[node] = h, weigh(h, tf)
                held += len(h)
            return known[node]

        for batch in it:
            cols = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            keep = [weighted_jaccard(weighted(a, one), weighted(b, two)) >= least for a, b, one, two in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def text_digest(text: Column) -> Column:
    """SHA-256 of a text that is in lower case already, as features() has it."""
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def classes_of_texts(docs: DataFrame, width: int = WIDTH, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """((doc_id, digest) of every row with an id and a text, (digest, first, class_id, chosen) of every distinct text in lower case).

    `first` is the smallest doc_id with that text, class_id the smallest of its class, and one text of each class is
    chosen: one that class_id has. A distinct text is a node of its own, whatever ids have it.

    In each band's bucket all are first compared with its smallest member; buckets that still hold several classes are
    compared with another member, while that links classes; and what they hold of several classes in the end is compared
    pairwise across those classes. So no link among texts that share a bucket is lost, and no pair within a class is made.
    """
    lowered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")).filter("text is not null")
    weights = learn_weights(lowered, width)
    made = cut(features(lowered, weights, width), "features")
    nodes = made.groupBy("digest").agg(F.min("doc_id").alias("first"), F.any_value("mass").alias("mass"), F.any_value("bands").alias("bands"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # fixed once written
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = cut(members.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "buckets")
    members = cut(members.join(shared, "bucket"), "members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(F.col("first").alias("doc_id"), "digest", "node")
    texts = lowered.withColumn("digest", text_digest(F.col("text"))).join(wanted, ["doc_id", "digest"]).groupBy("doc_id", "digest", "node").agg(F.min("text").alias("text"))
    texts = cut(texts.select("node", "text"), "texts")

    stars = members.filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    links = cut(verify(stars, texts, weights, width, least), "links")
    classes = cut(components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "classes")
    remove(links, shared)
    for round_ in range(1, STAR_ROUNDS):
        more = cut(verify(other_stars(members, classes, round_), texts, weights, width, least), "links")
        if more.isEmpty():
            break
        classes = merge_classes(classes, more)
    more = cut(verify(across_classes(members, classes, nodes, texts, weights, width, least), texts, weights, width, least), "links")
    if not more.isEmpty():
        classes = merge_classes(classes, more)
    remove(more, members, texts)

    named = nodes.select("node", "digest", "first").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = cut(named, "named")
    chosen = named.groupBy("component").agg(F.min(F.struct("first", "digest")).alias("least"))
    by_text = named.join(chosen, "component").select("digest", "first", F.col("least.first").alias("class_id"), (F.col("least.digest") == F.col("digest")).alias("chosen"))
    by_text, rows = cut(by_text, "by_text"), cut(made.select("doc_id", "digest"), "rows")
    remove(made, nodes, named, classes)
    return rows, by_text


def near_duplicates(docs: DataFrame, width: int = WIDTH, least: float = SIMILARITY) -> DataFrame:
    """Per row: doc_id, class_id (smallest doc_id of its class), kept (doc_id = class_id), exact_id (smallest doc_id with the same text but for case).

    Documents are linked if their texts are equal but for case or their weighted shingle sets (words of letters and
    digits, in lower case) have similarity `least` or more; classes are the connected components. Copies stand in for
    each other: each distinct text is sampled into bands once.

    Rows with a null doc_id or null text link with nothing: class_id = doc_id, kept = true. Texts without a word
    link with equal texts only; texts of fewer words than `width` have one shingle of all their words. Repeated rows
    are each returned, with one class; several texts under one doc_id are documents of their own. An empty table gives
    an empty result; other columns are ignored.
    """
    rows, by_text = classes_of_texts(docs, width, least)
    found = rows.join(by_text, "digest").select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"), F.col("first").alias("exact_id"))
    own = F.col("doc_id").cast("long")
    alone = docs.filter("doc_id is null or text is null").select(own.alias("doc_id"), own.alias("class_id"), F.lit(True).alias("kept"), own.alias("exact_id"))
    return found.unionByName(alone)


def merge_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links (a, b), which only tie classes together."""
    a, b = (classes.select(F.col("node").alias(c), F.col("component").alias(f"class_{c}")) for c in ("a", "b"))
    ties = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("class_a", "a").alias("src"), F.coalesce("class_b", "b").alias("dst"))
    joined = cut(components(ties).select(F.col("node").alias("component"), F.col("component").alias("new")), "joined")
    fresh = joined.join(classes.select("component").distinct(), "component", "left_anti").select(F.col("component").alias("node"), "new")
    moved = classes.join(joined, "component", "left").select("node", F.coalesce("new", "component").alias("new"))
    return cut(moved.unionByName(fresh).select("node", F.col("new").alias("component")), "classes")


def open_buckets(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(bucket, node, first, class) of the buckets that hold more than one class."""
    placed = members.join(classes, "node", "left").select("bucket", "node", "first", F.coalesce("component", "node").alias("class"))
    placed = cut(placed, "placed")
    mixed = placed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high").select("bucket")
    return cut(placed.join(cut(mixed, "mixed"), "bucket", "left_semi"), "open")


def other_stars(members: DataFrame, classes: DataFrame, round_: int) -> DataFrame:
    """Pairs (a, b): in each open bucket, b is one member (another one each round) and a those of other classes."""
    open_ = open_buckets(members, classes)
    centre = open_.groupBy("bucket").agg(F.min(F.struct(F.xxhash64(F.lit(round_), "node").alias("h"), F.col("node").alias("b"), F.col("class").alias("class_b"))).alias("c"))
    return open_.join(cut(centre.select("bucket", "c.b", "c.class_b"), "centres"), "bucket").filter("class <> class_b").select(F.col("node").alias("a"), "b").distinct()


def weighted_items(texts: DataFrame, weights: Weights, width: int) -> DataFrame:
    """(node, items): each text's weighted shingle set as plain 64-bit items, so that SQL functions can intersect it.

    A shingle that occurs tf times gives one item for each of its first tf occurrences: a hash of shingle and occurrence
    in the high 48 bits, and in the low 16 what that occurrence adds to the weight, in units of 1 / UNITS, rounded up.
    The shared items of two sets then sum to at least the sum of their lesser weights.
    """
    shared = texts.sparkSession.sparkContext.broadcast(weights)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = shared.value
        for batch in batches(it, BATCH_BYTES):
            items = []
            for h, tf in shingle_sets(*text_buffer(batch.column("text")), width):
                level = np.arange(1, int(tf.sum()) + 1) - np.repeat(np.cumsum(tf) - tf, tf)
                every = np.repeat(h, tf)
                added = weigh(every, level) - np.where(level > 1, weigh(every, np.maximum(level - 1, 1)), 0)
                name = mix(every + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(0xFFFF)
                items.append((name | np.ceil(added * UNITS).astype(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(items, pa.list_(pa.int64()))], ["node", "items"])

    return texts.select("node", "text").mapInArrow(run, "node long, items array<long>")


def across_classes(members: DataFrame, classes: DataFrame, nodes: DataFrame, texts: DataFrame, weights: Weights, width: int, least: float) -> DataFrame:
    """Pairs (a, b) that share a bucket but not a class and are similar but for rounding (see weighted_items). A pair is
    made in the first bucket that it shares. A bucket of many members is compared in parts of BLOCK of them with all, so
    no task has the whole of it."""
    open_ = open_buckets(members, classes)
    asked = open_.select("node").distinct()
    items = cut(weighted_items(texts.join(asked, "node", "left_semi"), weights, width), "items")
    parts = open_.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"))
    open_ = open_.select("bucket", "node", "class").join(parts, "bucket").join(nodes.select("node", "mass", "bands").join(items, "node"), "node")
    open_ = cut(open_, "open")
    columns = ("bucket", "node", "class", "mass", "bands", "items")
    a = open_.select(*[F.col(c).alias(f"{c}_a") for c in columns], F.pmod(F.xxhash64(F.lit("part"), "node"), "parts").alias("part_a"))
    b = open_.select(*[F.col(c).alias(f"{c}_b") for c in columns], F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part_b"))
    same = lambda one, two: F.zip_with(one, two, lambda x, y: x == y)
    first = F.array_position(same("bands_a", "bands_b"), True) == F.array_position("bands_a", F.col("bucket_a"))
    fits = (F.col("bucket_a") == F.col("bucket_b")) & (F.col("part_a") == F.col("part_b")) & (F.col("node_a") < F.col("node_b")) & (F.col("class_a") != F.col("class_b"))
    fits &= (F.least("mass_a", "mass_b") >= least * F.greatest("mass_a", "mass_b") - 1e-6) & first
    both = F.aggregate(F.array_intersect("items_a", "items_b"), F.lit(0).cast("long"), lambda total, x: total + x.bitwiseAND(F.lit(0xFFFF)))
    fits &= both * ((1 + least) / UNITS) >= least * (F.col("mass_a") + F.col("mass_b")) - 1e-6
    return a.join(b, fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class of near duplicates, with all its columns: one that has the smallest doc_id of the class.

    Rows with a null doc_id or null text stay, as they link with nothing; of rows that repeat a doc_id and text (but for
    case) one stays; other texts under that doc_id are documents of their own. An empty table stays empty, and columns
    of any name are kept as they are.
    """
    rows, by_text = classes_of_texts(docs)
    remove(rows)
    digest, place = free_name(docs.columns, "digest"), free_name(docs.columns, "place")
    winners = by_text.filter("chosen").select(F.col("class_id").alias("_id"), F.col("digest").alias("_winner"))
    some = docs.filter("doc_id is not null and text is not null").withColumn(digest, text_digest(F.lower("text")))
    some = some.join(winners, (F.col("doc_id").cast("long") == winners["_id"]) & (some[digest] == winners["_winner"]), "left_semi")
    again = Window.partitionBy("doc_id", digest).orderBy("text", F.xxhash64(*docs.columns))
    some = some.withColumn(place, F.row_number().over(again)).filter(F.col(place) == 1).select(*docs.columns)
    return some.unionByName(docs.filter("doc_id is null or text is null"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
