import random
import zlib

import numpy as np
import pytest
from lodestack.llm import token_store as S
from lodestack.llm.bpe import default_tokenizer
from lodestack.llm.common import new_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PICK = random.Random(5)
LONG = " ".join("".join(PICK.choice("theandsr") for _ in range(PICK.randint(1, 8))) for _ in range(6000))


def rows():
    return [(7, LONG), (3, "short text"), (3, "short text"), (None, "no id"), (9, None), (10, ""), (-4, LONG[:9000] + " new words here " + LONG[9000:]), (11, "<|endoftext|> x")]


def test_store_reads_back(spark):
    tok, path = Tokenizer.from_file(default_tokenizer()), new_path(spark, "t")
    docs = spark.createDataFrame([(i, t, "c", "c") for i, t in rows()], "doc_id long, text string, start string, digest string")
    got = S.token_store(docs, path).orderBy("start").collect()
    want = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in want]
    start = 0
    for r, (_, text) in zip(got, want, strict=True):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32, r.verified) == (start, len(ids), zlib.crc32(ids.tobytes()), True)
        start += len(ids)
    whole = {r.position: bytes(r.ids) for r in S.reconstruct(spark, path).collect()}
    for k, (_, text) in enumerate(want):
        assert whole[k] == np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
    digests = S.objects(spark, path, "chunk").count(), S.objects(spark, path, "chunk").select("key").distinct().count()
    assert digests[0] == digests[1] < sum(r.n_chunks for r in got) - 15  # the two long texts share chunks
    assert S.verify_manifest(spark, path).count() == 0


@pytest.fixture(scope="module")
def sound(spark):
    """A store of 600 documents: three lowest nodes and a root."""
    docs = spark.createDataFrame([(i, LONG[: 20 * i] if i % 9 == 0 else f"text number {i}") for i in range(600)], "doc_id long, text string")
    return S.write_store(docs, new_path(spark, "t"))


def tampered(spark, path, name, change):
    """A copy of the store with one table changed."""
    own = new_path(spark, "t")
    for table in ("objects", "recipes", "manifest"):
        df = spark.read.parquet(f"{path}/{table}")
        df = change(df) if table == name else df
        (df.write.partitionBy("kind") if table == "objects" else df.write).parquet(f"{own}/{table}")
    return own


def unverified(spark, path):
    return {r.doc_id for r in S.store_digests(spark, path).filter("not verified").collect()}


def test_sound(spark, sound):
    assert unverified(spark, sound) == set() and S.verify_manifest(spark, sound).count() == 0
    assert {(r.level, r.node) for r in spark.read.parquet(f"{sound}/manifest").collect()} == {(0, 0), (0, 1), (0, 2), (1, 0)}


def test_altered_chunk(spark, sound):
    key = S.recipe_parts(spark, sound).filter("position = 5").first().digest
    other = S.objects(spark, sound, "chunk").filter(F.col("key") != F.lit(key)).first()
    change = lambda df: df.withColumn("payload", F.when(F.col("key") == F.lit(key), F.lit(other.payload)).otherwise(F.col("payload")))
    assert unverified(spark, tampered(spark, sound, "objects", change)) == {5}


def test_missing_chunk(spark, sound):
    key = S.recipe_parts(spark, sound).filter("position = 7").first().digest
    assert unverified(spark, tampered(spark, sound, "objects", lambda df: df.filter(F.col("key") != F.lit(key)))) == {7}


def test_altered_recipes(spark, sound):
    """A recipe whose digests don't lead to its root; one whose root and digests agree, but not with the manifest."""
    longer = S.recipe_parts(spark, sound).filter("idx = 1").agg(F.min("position")).first()[0]
    own = tampered(spark, sound, "recipes", lambda df: df.withColumn("digests", F.when(F.col("position") == longer, F.reverse("digests")).otherwise(F.col("digests"))))
    assert unverified(spark, own) == {longer}
    first = spark.read.parquet(f"{sound}/recipes").filter("position = 1").first()
    forge = lambda df: df.select(*[(F.when(F.col("position") == 300, F.array(F.lit(first.digests[0])) if c == "digests" else F.array(F.lit(first.lengths[0])) if c == "lengths" else F.lit(first[c])).otherwise(F.col(c)) if c in ("digests", "lengths", "root", "n_tokens") else F.col(c)).alias(c) for c in df.columns])
    assert unverified(spark, tampered(spark, sound, "recipes", forge)) == set(range(256, 512))


@pytest.mark.parametrize(("gone", "want"), [("level = 0 and node = 2", set(range(600))), ("level = 1", set(range(600)))])
def test_missing_nodes(spark, sound, gone, want):
    own = tampered(spark, sound, "manifest", lambda df: df.filter(f"not ({gone})"))
    assert S.verify_manifest(spark, own).count() > 0 and unverified(spark, own) == want


def test_superfluous_node(spark, sound):
    own = tampered(spark, sound, "manifest", lambda df: df.unionByName(df.filter("level = 0 and node = 0").withColumn("node", F.lit(9).cast("long"))))
    assert {(0, 9)} <= {(r.level, r.node) for r in S.verify_manifest(spark, own).collect()}


def test_empty(spark):
    assert S.token_store(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_chunk_ends(n):
    ids = np.random.default_rng(n).integers(0, 50000, n).astype(np.uint32)
    ends = S.chunk_ends(0, n, S.chunk_marks(ids))
    moved = np.r_[np.arange(77, dtype=np.uint32), ids]
    assert [e - 77 for e in S.chunk_ends(77, 77 + n, S.chunk_marks(moved))] == ends
    sizes = np.diff([0, *ends])
    assert (ends[-1] if n else 0) == n and all(S.MIN_IDS <= s <= S.MAX_IDS for s in sizes[:-1])
    assert len(S.chunk_ends(0, n, S.chunk_marks(np.zeros(n, np.uint32)))) <= -(-n // S.MIN_IDS)


def test_shift_crc():
    a, b = b"some bytes", b"others, 17 of them"
    assert zlib.crc32(a + b) == int(S.shift_crc(np.array([zlib.crc32(a)]), np.array([len(b)]))[0]) ^ zlib.crc32(b)
