import zlib

import numpy as np
import pyarrow as pa
from lodestack.llm import quality as Q
from lodestack.llm.kernels import text_buffer

SF = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = Q.score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    out = [(r.score, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    score, label = np.array([s for s, _ in out]), np.array([q for _, q in out])
    assert auc(score, label) > 0.97
    assert (score[label == 1] >= 0.7).mean() > 0.97
    edges = np.array([0, 0.25, 0.5, 0.75, 0.9, 1.01])
    for a, b in zip(edges[:-1], edges[1:], strict=True):  # calibrated: where many rows fall, their share of label 1 is near their score
        own = (score >= a) & (score < b)
        assert own.sum() < 60 or abs(label[own].mean() - score[own].mean()) < 0.15


def test_edges(spark):
    good = [(k, f"the quiet house number {k} stands by the old river.", "c") for k in range(200)]
    bad = [(k, f"BUY {k}!! NOW!! " * 5, "c") for k in range(200, 400)]
    odd = [(400, None, "c"), (401, "", "c"), (402, "BUY!! NOW!! " * 60_000, None), (None, "the old house stands.", "c"), (0, "the quiet house number 0 stands by the old river.", "c")]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, int(k < 200), None) for k in range(400)] + [(None, 1, None), (5, None, None), (401, 7, 1)], "doc_id long, quality int, toxic int")
    got = Q.score_documents(docs, labels).collect()
    assert len(got) == len(good) + len(bad) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all(by[k].predicted == (k < 200) for k in range(400)) and by[402].predicted == 0 and by[None].predicted == 1
    assert by[400].score == by[401].score
    assert {r.doc_id for r in Q.accepted_documents(docs, labels).collect()} >= set(range(200))
    assert Q.score_documents(docs.limit(0), labels).count() == 0
    assert {r.score for r in Q.score_documents(docs, labels.filter("quality = 1")).collect()} == {0.5}


def test_long_text_pools_alike():
    vectors = np.random.default_rng(0).normal(size=(Q.WORDS + Q.SHAPES, Q.DIM)).astype(np.float32)
    text = " ".join(f"word{k % 977}" for k in range(5 * Q.WORDS))
    data, offsets = text_buffer(pa.array([text, "", "a"]))
    word, shape, first = Q.tokens(data, offsets)
    got = Q.document_vectors(vectors, data, offsets)
    assert np.allclose(got[0, : Q.DIM], vectors[word[: first[1]]].mean(axis=0), atol=1e-4)
    assert not got[1, :-1].any()


def plain_vectors(texts):
    """Random indexing by loops: each word and each shape takes the index vectors of its neighbours' word and shape."""
    plus, minus = Q.index_vectors()
    total = np.zeros((Q.WORDS + Q.SHAPES, Q.DIM))
    for text in texts:
        word, shape, _ = Q.tokens(*text_buffer(pa.array([text])))
        for k in range(len(word)):
            for j in (k - 1, k + 1):
                if 0 <= j < len(word):
                    for row in (word[k], shape[k]):
                        for other in (word[j], shape[j]):
                            total[row, plus[other]] += 1
                            total[row, minus[other]] -= 1
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)


def test_vectors_against_loops(spark):
    texts = ["one two three one", "", None, "one", "BUY now!! BUY now!! 12", "été—une  fois\tune", "a b " * 300, "one two three one"]
    got = Q.context_vectors(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3))
    assert np.allclose(got, plain_vectors([t for t in texts if t]), atol=1e-5) and np.abs(got).sum() > 10
    pooled = Q.document_vectors(got, *text_buffer(pa.array(texts)))
    word, shape, _ = Q.tokens(*text_buffer(pa.array([texts[0]])))
    assert np.allclose(pooled[0], np.r_[got[word].mean(axis=0), got[shape].mean(axis=0), np.log1p(4)], atol=1e-5)


def test_gradients_against_differences():
    pick = np.random.default_rng(1)
    x, y, weight = pick.normal(size=(60, 5)), pick.integers(0, 2, 60), pick.uniform(0.5, 2, 60)
    net = Q.Network(x, y, weight)
    z = net._standard(x)

    def loss():
        logit = net._logit(z)
        return (weight * np.logaddexp(0, np.where(y == 1, -1, 1) * logit)).sum() / len(y) + 0.5e-4 * ((net.p[0] ** 2).sum() + (net.p[2] ** 2).sum())

    for p, g in zip(net.p, net._gradients(z, y, weight), strict=True):
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 9)]:
            old, p[at] = p[at], p[at] + 1e-5
            up = loss()
            p[at] = old - 1e-5
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5


def test_temperature_is_the_best_of_those_tried():
    """On the rows apart, no other temperature tried gives a smaller loss."""
    pick = np.random.default_rng(2)
    x = pick.normal(size=(1000, 4))
    y = (x[:, 0] + pick.normal(size=1000) > 0).astype(int)
    net = Q.Network(x, y, np.ones(1000))
    apart = np.random.default_rng(5).permutation(1000)[:200]
    logit = net._logit(net._standard(x[apart]))
    losses = {t: np.logaddexp(0, np.where(y[apart] == 1, -1, 1) * logit / t).sum() for t in np.geomspace(0.25, 8, 61)}
    assert min(losses, key=losses.get) == net.temperature


def test_a_repeated_labelled_id_teaches_once(spark):
    good = [(k, f"the quiet house number {k} stands by the old river.") for k in range(60)]
    bad = [(k, f"BUY {k}!! NOW!! " * 5) for k in range(60, 120)]
    labels = spark.createDataFrame([(k, int(k < 60)) for k in range(120)], "doc_id long, quality int")
    docs = spark.createDataFrame(good + bad + [good[1]] * 500, "doc_id long, text string")
    by = {r.doc_id: r.predicted for r in Q.score_documents(docs, labels).collect()}
    assert all(by[k] == (k < 60) for k in range(120))
