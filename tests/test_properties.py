"""Properties of chunking, packing, grouping and globbing over made-up inputs."""

import fnmatch
import hashlib
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lodestack.functions import expressions as X
from lodestack.functions.arrays import fold
from lodestack.operators import chunking, manifest, packing
from pyspark.sql import functions as F


def packs(sizes, size):
    """Plain loop: which pack each chunk goes to, and where in it."""
    out, pack, held = [], 0, 0
    for s in sizes:
        out.append((pack, held))
        held += s
        if held >= size:
            pack, held = pack + 1, 0
    return out


@pytest.mark.parametrize("sizes", [[70] * 5, [100], [99, 1, 1], [250, 10, 90, 1], [0, 0, 100]])
def test_pack_plan(spark, sizes):
    rows = [(1, k, f"d{k}", s) for k, s in enumerate(sizes)] + [(1, 100, "r", 50), (2, 0, "d0", 100), (2, 1, "d0", 1)]
    chunks = spark.createDataFrame(rows, "file_id long, chunk_idx long, digest string, size long")
    index = spark.createDataFrame([("r", "old", 7)], "digest string, pack_digest string, index_offset long")
    got = packing.plan_packs(packing.classify(chunks, index), 100).collect()
    own = sorted((r.chunk_idx, r.pack_idx, r.pack_offset) for r in got if r.file_id == 1 and not r.reused)
    assert [(p, o) for _, p, o in own] == packs(sizes, 100)
    assert [(r.pack_digest, r.pack_idx, r.pack_offset) for r in got if r.reused] == [("old", None, 7)]
    assert all((r.pack_digest is None) != (r.pack_idx is None) for r in got)
    assert sorted(r.pack_idx for r in got if r.file_id == 2) == [0, 1]  # a digest that occurs twice is packed twice


def test_a_long_file_is_planned_in_time(spark):
    n = 30_000
    chunks = spark.range(n).select(F.lit(1).cast("long").alias("file_id"), F.col("id").alias("chunk_idx"), F.concat(F.lit("d"), "id").alias("digest"), (F.col("id") % 90 + 10).alias("size"))
    empty = spark.createDataFrame([], "digest string, pack_digest string, index_offset long")
    began = time.time()
    got = sorted((r.chunk_idx, r.pack_idx, r.pack_offset) for r in packing.plan_packs(packing.classify(chunks, empty), 1000).collect())
    assert [(p, o) for _, p, o in got] == packs([k % 90 + 10 for k in range(n)], 1000) and time.time() - began < 60


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.integers(1, 50))
def test_fold_is_a_plain_fold(spark, values, least):
    """Running sums that start anew at a bound, against a loop; longer than a block."""
    step = lambda at, x: (F.when(at + x >= least, 0).otherwise(at + x), F.array(at + x, x))
    got = spark.createDataFrame([(values,)], "v array<int>").select(fold(F.col("v"), F.lit(0), "int", step, "int").alias("out")).first().out
    want, at = [], 0
    for x in values:
        want += [at + x, x]
        at = 0 if at + x >= least else at + x
    assert got == want


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000, 60_000])
def test_content_chunks(n):
    raw = random.Random(n).randbytes(n)
    ends = chunking.cut_points(raw, 1024)
    sizes = [b - a for a, b in zip([0, *ends], ends)]  # noqa: B905
    assert sum(sizes) == n and all(256 <= s <= 4096 for s in sizes[:-1]) and ends == chunking.cut_points(raw, 1024)
    if n > 50_000:
        other = chunking.cut_points(raw[:20_000] + b"edit" + raw[20_000:], 1024)
        kept = {raw[a:b] for a, b in zip([0, *ends], ends)}  # noqa: B905
        new = raw[:20_000] + b"edit" + raw[20_000:]
        assert sum(new[a:b] not in kept for a, b in zip([0, *other], other)) <= 4  # noqa: B905
        assert 500 < n / len(ends) < 2500


def test_normal_sizes():
    """Two masks draw chunk sizes to the average; constant bytes are cut at the largest size."""
    raw = random.Random(3).randbytes(2_000_000)
    ends = chunking.cut_points(raw, 1024)
    sizes = [b - a for a, b in zip([0, *ends], ends)][:-1]  # noqa: B905
    mean = sum(sizes) / len(sizes)
    assert 900 < mean < 1400 and sum(s == 4096 for s in sizes) < 0.01 * len(sizes)
    assert sum((s - mean) ** 2 for s in sizes) / len(sizes) < (0.55 * mean) ** 2  # a single mask has about the mean itself
    flat = chunking.cut_points(b"a" * 20_000, 1024)
    assert flat in ([4096, 8192, 12288, 16384, 20_000], list(range(256, 20_000, 256)) + [20_000])


def test_chunks_do_not_depend_on_the_batch(spark):
    pick = random.Random(5)
    files = [(k, bytearray(pick.randbytes(pick.choice([0, 1, 40, 3000, 90_000])))) for k in range(60)]
    table = spark.createDataFrame(files, "file_id long, content binary").repartition(3)
    got = {}
    for r in chunking.content_chunks(table, 1024).collect():
        got.setdefault(r.file_id, []).append((r.chunk_idx, r.offset, r.size, r.digest, r.file_digest, r.file_size))
    for k, raw in files:
        ends = chunking.cut_points(bytes(raw), 1024)
        want = [(i, a, b - a, hashlib.sha256(raw[a:b]).hexdigest(), hashlib.sha256(raw).hexdigest(), len(raw)) for i, (a, b) in enumerate(zip([0, *ends], ends))]  # noqa: B905
        assert sorted(got.get(k, [])) == want


def test_empty_file_has_no_chunks(spark):
    rows = spark.createDataFrame([(1, bytearray(b"")), (2, bytearray(b"x" * 1024)), (3, bytearray(b"x" * 1025))], "file_id long, content binary")
    assert sorted((r.file_id, r.size) for r in chunking.fixed_chunks(rows, 1024).collect()) == [(2, 1024), (3, 1), (3, 1024)]


LAYER = "repo long, layer_idx long, media_type string, title string, size long, digest string, is_new boolean"


def test_untitled_layers_stay_in_a_merge(spark):
    old = [(1, 0, "blob", None, 1, "a", False), (1, 1, "blob", "x", 1, "b", False), (1, 2, "blob", "", 1, "c", False), (1, 3, "blob", "y", 1, "d", False), (1, 4, "blob", "z", 1, "e", False)]
    rows = spark.createDataFrame([*old, (1, 9, "blob", "x", 2, "n", True), (2, 0, "blob", "x", 1, "o", False)], LAYER)
    assert sorted(r.digest for r in manifest.merge_flagged(rows, ["z"]).collect()) == ["a", "d", "n", "o"]


TITLES = st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=6)


@settings(max_examples=15, deadline=None)
@given(TITLES, st.sets(st.sampled_from("abc")), st.sets(st.sampled_from("abcd")))
def test_merge_keeps_whole_groups(spark, old, new, deleted):
    rows = [(1, k, "blob", t, 1, f"o{k}", False) for k, t in enumerate(old)] + [(1, 50 + k, "blob", t, 1, f"n{k}", True) for k, t in enumerate(sorted(new))]
    got = {r.digest for r in manifest.merge_flagged(spark.createDataFrame(rows, LAYER), sorted(deleted)).collect()}
    want, title = {f"n{k}" for k in range(len(new))}, None
    for k, t in enumerate(old):
        title = t or title
        want |= {f"o{k}"} if title not in new | deleted else set()
    assert got == want


@pytest.mark.parametrize("pattern", ["*.txt", "a?c*", "[ab]*", "[!ab]*", "dir/", "*", "a.b"])
def test_globs(spark, pattern):
    names = ["a.txt", "dir/a.txt", "abc", "b", "c\n.txt", "dir/", "a.b", "axb", "A.TXT"]
    rows = spark.createDataFrame([(n,) for n in names], "title string")
    own = pattern + "*" if pattern.endswith("/") else pattern
    assert {r.title for r in manifest.glob_filter(rows, "title", [pattern]).collect()} == {n for n in names if fnmatch.fnmatchcase(n, own)}
    assert manifest.glob_filter(rows, "title", None, [pattern]).count() == sum(not fnmatch.fnmatchcase(n, own) for n in names)


def test_functions(spark):
    row = spark.range(1).select(
        X.leading_version(F.lit("1.2.0rc1.5")).alias("v"), X.leading_version(F.lit("1.x.3")).alias("w"),
        X.human_bytes(F.lit(1536)).alias("b"), X.human_bytes(F.lit(12)).alias("c"), X.human_bytes(F.lit(None).cast("long")).alias("n"),
        X.committed_bytes(F.lit("0-41")).alias("r"), X.committed_bytes(F.lit("0-0")).alias("z"), X.committed_bytes(F.lit("junk")).alias("j"),
        X.bare_digest(F.lit("sha256:ab")).alias("d"), X.is_digest(F.lit("ab" * 32)).alias("i"),
    ).first()
    assert (row.v, row.w) == ([1, 2, 0, 5], [1]) and (row.b, row.c, row.n) == ("1.5 KB", "12 B", "—")
    assert (row.r, row.z, row.j, row.d, row.i) == (42, 0, 0, "ab", True)
