"""Pointers, manifests, stores, pages and streams over small fixtures."""

import io
import json

import pytest
from lodestack.operators import packing, pointers, sinks
from lodestack.sources import documents
from lodestack.streaming import stateful
from pyspark.sql import functions as F

CHUNKS = "file_id long, chunk_idx long, digest string, size long, pack_digest string, pack_idx long, pack_offset long"


def test_a_pointer_is_canonical_and_comes_back(spark):
    plan = spark.createDataFrame([(1, 1, "b", 20, "sha256:old", None, 5), (1, 0, "a", 10, None, 0, 0), (2, 0, "c", 1, None, 0, 0)], CHUNKS)
    packs = spark.createDataFrame([(1, 0, "p")], "file_id long, pack_idx long, digest string")
    resolved = pointers.resolve(plan, packs)
    assert {(r.file_id, r.pack) for r in resolved.collect()} == {(1, "sha256:p"), (1, "sha256:old"), (2, None)}  # a pack without a digest
    files = spark.createDataFrame([(1, 30, "f", "d\\x"), (3, 0, "e", "y")], "file_id long, size long, digest string, title string")
    made = pointers.write_pointers(resolved, files)
    doc = {"version": pointers.LAYOUT, "file": {"size": 30, "digest": "sha256:f"}, "chunks": [{"digest": "sha256:a", "size": 10, "pack": "sha256:p", "offset": 0}, {"digest": "sha256:b", "size": 20, "pack": "sha256:old", "offset": 5}]}
    row = made.collect()
    assert [(r.file_id, r.pointer, r.n_chunks) for r in row] == [(1, json.dumps(doc, sort_keys=True, separators=(",", ":")), 2)]
    back = pointers.parse_pointers(made).first()
    assert back.fault is None and [c.pack for c in back.doc.chunks] == ["sha256:p", "sha256:old"]
    layer = pointers.pointer_layers(made, files).first()
    assert layer.annotations == {pointers.TITLE: "d/x", pointers.FILE_SIZE: "30", pointers.FILE_DIGEST: "sha256:f", pointers.CHUNK_COUNT: "2"}


@pytest.mark.parametrize(("text", "fault"), [
    ("{", "not json"), ("[]", "version"), ('{"version":"chunked-v2"}', "chunk field"), ('{"version":"chunked-v2","chunks":[]}', "no chunks"),
    ('{"version":"chunked-v2","chunks":[{"digest":"a","offset":1,"pack":"p"}]}', "chunk field"), ('{"version":"chunked-v2","chunks":[{"digest":"a","offset":1,"pack":"p","size":"x"}]}', "chunk field"),
    ('{"version":"chunked-v2","chunks":[{"digest":"a","offset":"1","pack":"p","size":2}]}', None), ('{"version":"v1","chunks":[]}', "version"), (None, "not json"),
])
def test_faulty_pointers(spark, text, fault):
    assert pointers.parse_pointers(spark.createDataFrame([(text,)], "pointer string")).first().fault == fault


def test_manifests(spark):
    kind = "repo string, layer_idx long, media_type string, size long, digest string, annotations map<string,string>"
    rows = [("a", 1, pointers.PACK, 9, "sha256:q", None), ("a", 0, pointers.POINTER, 3, "sha256:p", {pointers.TITLE: "x é"}), ("b", 0, pointers.PLAIN, 5, "sha256:r", {pointers.TITLE: "y"})]
    got = {r.repo: r for r in pointers.assemble(spark.createDataFrame(rows, kind), "sha256:c", 2).collect()}
    a, b = json.loads(got["a"].manifest), json.loads(got["b"].manifest)
    assert [x["digest"] for x in a["layers"]] == ["sha256:p", "sha256:q"] and "annotations" not in a["layers"][1]
    assert a["artifactType"] == pointers.ARTIFACT and a["annotations"] == {pointers.LAYOUT_KEY: pointers.LAYOUT} and "artifactType" not in b and b["annotations"] == {}
    assert all(got[k].bytes == len(json.dumps(m)) and got[k].fits for k, m in (("a", a), ("b", b)))


def test_chunks_are_cut_out_of_packs(spark):
    plan = spark.createDataFrame([(1, "p", [(0, 2, 0, "x"), (2, 9, 2, "y")]), (1, "gone", [(0, 1, 11, "z")])], "file_id long, pack string, targets array<struct<offset:long,size:long,file_offset:long,digest:string>>")
    packs = spark.createDataFrame([("p", bytearray(b"hello"))], "pack string, content binary")
    plan = plan.withColumn("targets", F.transform("targets", lambda t: t.withField("digest", F.when(t["digest"] == "x", F.sha2(F.lit("he"), 256)).otherwise(t["digest"]))))
    assert [(r.file_offset, r.payload and bytes(r.payload), r.status) for r in pointers.scatter(plan, packs).orderBy("file_offset").collect()] == [(0, b"he", "sound"), (2, None, "out of range"), (11, None, "no pack")]


def test_a_blob_is_written_once(spark):
    path = sinks.scratch(spark, "t")
    blobs = lambda *names: spark.createDataFrame([(n, bytearray(n.encode())) for n in names], "digest string, content binary")
    sinks.write_missing(blobs("a", "b", "b"), path, "1")
    sinks.write_missing(blobs("b", "c"), path, "2")
    sinks.write_missing(blobs("b", "c"), path, "2")  # tried again
    assert sorted((r.digest, str(r.batch)) for r in spark.read.parquet(path).collect()) == [("a", "1"), ("b", "1"), ("c", "2")]


def test_spoilt_content_is_not_cached(spark):
    path = sinks.scratch(spark, "t")
    files = spark.createDataFrame([("r", 1, "x", "d", bytearray(b"x")), ("r", 1, "y", "", bytearray(b"y"))], "repo string, revision int, title string, digest string, content binary")
    files = files.withColumn("digest", F.when(F.col("title") == "y", F.sha2("content", 256)).otherwise(F.col("digest")))
    sinks.write_cache(files, path)
    assert {r.title: r.digest is not None for r in sinks.look_up(spark, path, files.select("repo", "revision", "title")).collect()} == {"x": False, "y": True}


def test_walk_lists_without_reading(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x y.txt").write_bytes(b"12345")
    (tmp_path / "b").write_bytes(b"1")
    (tmp_path / "empty").write_bytes(b"")
    assert {(r.path, r["size"]) for r in documents.walk(spark, str(tmp_path)).select("path", "size").collect()} == {("a/x y.txt", 5), ("b", 1)}


def test_pages_end_where_links_repeat(spark):
    link = lambda x: f'<{x}>; rel="next"' if x else None
    pages = spark.createDataFrame([(1, 1, link("p2")), (1, 2, link("p2")), (1, 3, None), (2, 1, None), (2, 2, link("x"))], "repo long, page long, link string")
    assert sorted((r.repo, r.page) for r in documents.follow_pages(pages).collect()) == [(1, 1), (1, 2), (2, 1)]


def test_streamed_packs_are_a_prefix_of_the_plan(spark):
    sizes = [60, 60, 60, 10, 500, 1]
    source, out, checkpoint = (sinks.scratch(spark, n) for n in ("s", "o", "c"))
    rows = [(1, k, s, k == len(sizes) - 1) for k, s in enumerate(sizes)] + [(2, 0, 5, True)]
    table = spark.createDataFrame(rows, "file_id long, chunk_idx long, size long, last boolean")
    plan = packing.plan_packs(packing.classify(table.withColumn("digest", F.col("chunk_idx").cast("string")), spark.createDataFrame([], "digest string, pack_digest string, index_offset long")), 100)
    want = sorted(tuple(r) for r in plan.groupBy("file_id", "pack_idx").agg(F.sum("size"), F.count("*")).collect())
    for part in ("chunk_idx in (0, 1, 5)", "chunk_idx = 4", "chunk_idx in (2, 3)"):
        table.filter(part).write.mode("append").parquet(source)
        got = sorted(tuple(r) for r in stateful.run_all(stateful.stream_packs(spark.readStream.schema(table.schema).parquet(source), 100), out, checkpoint).collect())
        assert set(got) <= set(want)
    assert got == want


def test_packs_of_files_of_neighbouring_ids(spark):
    source, out, checkpoint = (sinks.scratch(spark, n) for n in ("s", "o", "c"))
    ids = [None, -1, -129, *range(300)]
    table = spark.createDataFrame([(i, k, 60, k == 2 and i != 5) for i in ids for k in range(3)], "file_id long, chunk_idx long, size long, last boolean")
    for k in (2, 0, 1):
        table.filter(f"chunk_idx = {k}").write.mode("append").parquet(source)
        got = stateful.run_all(stateful.stream_packs(spark.readStream.schema(table.schema).parquet(source), 100), out, checkpoint)
        if k == 2:
            assert spark.read.format("statestore").load(checkpoint).count() == 6  # a group has 128 ids, not one
    want = [(-7 if i is None else i, p, s, n) for i in ids for p, s, n in ((0, 120, 2), (1, 60, 1)) if (i, p) != (5, 1)]
    assert sorted(tuple(r) for r in got.fillna(-7).collect()) == sorted(want)
    assert spark.read.format("statestore").load(checkpoint).count() == 1  # the others are whole


def test_watermarks_of_files_of_neighbouring_ids(spark):
    source, out, checkpoint = (sinks.scratch(spark, n) for n in ("s", "o", "c"))
    ids = [None, -1, -129, *range(300)]
    table = spark.createDataFrame([(i, k * 60, 60, 180) for i in ids for k in range(3)], "file_id long, offset long, size long, total long")
    for k in (0, 120, 60):
        table.filter(f"offset = {k} and (file_id is null or offset <> 60 or file_id % 2 = 0)").write.mode("append").parquet(source)
        got = stateful.run_all(stateful.stream_watermark(spark.readStream.schema(table.schema).parquet(source)), out, checkpoint, "update")
    want = [(i, *r) for i in ids for r in [(0, 60, 0, False), (1, 60, 1, False), *([(2, 180, 0, True)] if i is None or i % 2 == 0 else [])]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.file_id, r.batch, r.watermark, r.waiting, r.whole) for r in got.collect()), key=key) == sorted(want, key=key)
    assert spark.read.format("statestore").load(checkpoint).count() == 6  # a group has 128 ids, not one


def test_a_failed_stream_stays_failed(spark):
    source = sinks.scratch(spark, "s")
    spark.range(10).repartition(2).write.parquet(source)
    stream = stateful.Bounded(spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source), sinks.scratch(spark, "c"))

    def each(rows):
        if len(stream.said) == 1:
            raise ValueError("second batch")

    with pytest.raises(Exception, match="second batch"):
        stream.run(each)
    assert [k for k, _ in stream.said] == ["batch", "fail"]
    with pytest.raises(RuntimeError):
        stream.run(each)


def test_things_in_memory(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"\x00\xff")
    items = [("a", "é"), ("b", b"\x01"), ("c", io.BytesIO(b"xyz")), ("d", tmp_path / "f"), ("e", io.StringIO("ü"))]
    assert {r.title: bytes(r.content) for r in documents.in_memory(spark, items).collect()} == {"a": "é".encode(), "b": b"\x01", "c": b"xyz", "d": b"\x00\xff", "e": "ü".encode()}


def test_a_commit_needs_the_revision_it_expects(spark):
    path = sinks.scratch(spark, "t")
    rows = lambda *r: spark.createDataFrame(r, "repo string, expected string, revision string, manifest string")
    out = lambda df: {r.revision: r.outcome for r in df.collect()}
    assert out(sinks.commit(rows(("a", None, "1", "m1"), ("b", "0", "9", "x")), path)) == {"1": "committed", "9": "conflict"}
    assert out(sinks.commit(rows(("a", "1", "2", "m2"), ("a", "1", "3", "m3"), ("b", None, "4", "m4")), path)) == {"2": "committed", "3": "conflict", "4": "committed"}
    assert {r.repo: (r.revision, r.manifest) for r in sinks.current(spark, path).collect()} == {"a": ("2", "m2"), "b": ("4", "m4")}
