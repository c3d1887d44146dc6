import numpy as np
from lodestack.llm import embedding_dedup as E

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int, node long, leaf string"


def brute(rows):
    ids = [i for i, *_ in rows]
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = np.argwhere(np.triu(x @ x.T >= E.COSINE, 1))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links.tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
    return np.bincount(links.ravel(), minlength=len(rows)), [ids[find(k)] for k in range(len(rows))]


def clustered(n, seed=0, near=0.3):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(n // 3, 48))
    x = centres[pick.integers(0, len(centres), n)] + near * pick.normal(size=(n, 48)) * pick.uniform(0, 1, (n, 1))
    return x.astype(np.float32)


def recall(spark, rows, **kw):
    got = {r.vec_id: r for r in E.embedding_links(spark.createDataFrame(rows, SCHEMA), **kw).collect()}
    assert len(got) == len(rows)
    links, classes = brute(rows)
    found = np.array([got[i].n_links for i, *_ in rows])
    assert (found <= links).all()  # none below the threshold, none twice
    for (i, *_), c in zip(rows, classes, strict=True):
        assert got[i].kept == (got[i].component_id == i) and got[i].component_id >= c
    if (found == links).all():
        assert all(got[i].component_id == c for (i, *_), c in zip(rows, classes, strict=True))
    return found.sum() / links.sum() if links.any() else 1.0


def test_recall_against_brute_force(spark):
    rows = [(k * 3 + 1, v.tolist(), 0, 5, "c") for k, v in enumerate(clustered(2500))]
    rows += [(10_000 + k, rows[4][1], 1, 5, "c") for k in range(300)]  # a large group of copies
    assert recall(spark, rows) >= 0.97


def test_large_leaves_are_split(spark, monkeypatch):
    monkeypatch.setattr(E, "SAMPLE", 64)
    monkeypatch.setattr(E, "PLACED", 100)
    rows = [(k, v.tolist(), 0, 5, "c") for k, v in enumerate(clustered(1500, 1))]
    assert recall(spark, rows, leaf=16) >= 0.9


def test_near_group(spark):
    pick = np.random.default_rng(4)
    centre = pick.normal(size=48)
    x = np.r_[centre + 0.05 * pick.normal(size=(900, 48)), pick.normal(size=(900, 48))].astype(np.float32)
    assert recall(spark, [(k, v.tolist(), 0, 5, "c") for k, v in enumerate(x)]) >= 0.98


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, float("nan"), 3.0]), (6, [1.0, None, 3.0]), (7, []), (8, [1.0, 2.0]), (9, [float("inf"), 1.0, 1.0])]
    rows += [(None, v), (10, [2.0, 4.0]), (11, [-1.0, -2.0, -3.0]), (12, [3e38, 0.0, 0.0]), (13, [1e-38, 0.0, 0.0]), (1, v)]
    table = spark.createDataFrame([(i, e, 0, 1, "c") for i, e in rows], SCHEMA)
    got = E.embedding_links(table).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None}
    assert by[1] == (2, 1, True) and by[2] == (2, 1, False)  # the repeated row is one more vector
    assert by[8] == (1, 8, True) and by[10] == (1, 8, False) and by[13] == (1, 12, False)
    assert all(by[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 9, 11))
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert E.embedding_links(table.limit(0)).count() == 0


def test_any_number_of_lengths(spark):
    pick = np.random.default_rng(9)
    rows = [(k, pick.normal(size=2 + k // 3).tolist()) for k in range(120)]
    rows += [(1000 + k, [2 * x for x in rows[k][1]]) for k in range(120)] + [(2000 + k, pick.normal(size=50).tolist()) for k in range(1200)]
    got = {r.vec_id: r for r in E.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(got[1000 + k].n_links >= 1 and got[1000 + k].component_id == got[k].component_id for k in range(120))


def test_several_vectors_under_one_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (0, [-1.0, 0.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding, 0, 5, "c") for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert recall(spark, rows) >= 0.99


def counted(x):
    """Links of each vector, in blocks."""
    x = np.array(x, np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([(x[a : a + 1000] @ x.T >= E.COSINE).sum(axis=1) - 1 for a in range(0, len(x), 1000)])


def test_large_near_group(spark):
    pick = np.random.default_rng(5)
    centre = pick.normal(size=48)
    x = np.r_[centre + 0.24 * pick.normal(size=(20_000, 48)), centre + 0.5 * pick.normal(size=(500, 48)), clustered(900, 6)].astype(np.float32)
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in E.embedding_links(rows).collect()}
    found, links = np.array([got[k].n_links for k in range(len(x))]), counted(x)
    assert len(got) == len(x) and (found <= links).all()
    assert found[:20_000].sum() == links[:20_000].sum() and found.sum() >= 0.99 * links.sum()
    assert all(got[k].component_id == 0 for k in range(20_000))


def test_dense_places_that_only_a_leaf_shows(spark, monkeypatch):
    monkeypatch.setattr(E, "SAMPLE", 400)
    monkeypatch.setattr(E, "BLOCK", 100)
    monkeypatch.setattr(E, "LEAST_BLOCK", 50)
    pick = np.random.default_rng(7)
    x = np.r_[pick.normal(size=48) + 0.05 * pick.normal(size=(300, 48)), clustered(3300, 8)]
    rows = [(k * 2, v.tolist(), 0, 5, "c") for k, v in enumerate(x.astype(np.float32))]
    rows += [(20_000 + k, rows[k][1], 0, 5, "c") for k in range(40)]
    assert recall(spark, rows, leaf=16) >= 0.9


def test_large_leaves_under_the_sample_as_set(spark):
    pick = np.random.default_rng(11)
    near, apart = pick.normal(size=48) + 0.05 * pick.normal(size=(200, 48)), pick.normal(size=(200, 48))
    rows = [(k, 1, v.tolist(), [5, 6] if k % 2 else [5]) for k, v in enumerate(np.r_[near, apart])]
    placed = spark.createDataFrame(rows, "node long, copies long, embedding array<float>, leaves array<long>")
    assert len(E.crowded_centres(placed, 8, E.COSINE)) == 1
    got = {r.node: r for r in E.split_large(placed, 8, 1).collect()}
    assert [(r.node, r.copies, r.embedding) for _, r in sorted(got.items())] == [(r.node, r.copies, r.embedding) for r in placed.orderBy("node").collect()]
    sizes = np.unique([i for r in got.values() for i in r.leaves], return_counts=True)[1]
    assert all(r.leaves for r in got.values()) and sizes.max() <= 32
