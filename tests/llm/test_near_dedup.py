import random
import re
from collections import Counter

import numpy as np
from lodestack.llm import near_dedup as N
from lodestack.llm import weighted
from lodestack.llm.components import components
from lodestack.llm.weighted import CELLS, RARE, RARITY, Sampler, learn_weights, weighted_jaccard
from lodestack.llm.kernels import shingles, text_buffer
import pyarrow as pa
from pyspark.sql import functions as F


def corpus(seed=1):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 7)))
    vocabulary = [word() for _ in range(900)]
    texts = []
    for _ in range(70):
        base = [pick.choice(vocabulary) for _ in range(pick.randint(60, 160))]
        texts.append(" ".join(base))
        for _ in range(pick.choice([0, 0, 1, 3])):
            near = list(base)
            for _ in range(pick.choice([1, 1, 2, 4, 9])):
                near[pick.randrange(len(near))] = pick.choice(vocabulary)
            texts.append(" ".join(near))
    hot = [pick.choice(vocabulary) for _ in range(120)]
    for _ in range(100):  # a large group of near copies
        near = list(hot)
        for _ in range(pick.choice([0, 1, 2])):
            near[pick.randrange(len(near))] = pick.choice(vocabulary)
        texts.append(" ".join(near))
    passage = " ".join(pick.choice(vocabulary) for _ in range(40))
    texts += [passage + " " + " ".join(pick.choice(vocabulary) for _ in range(60)) for _ in range(60)]
    texts += texts[:10] + [texts[3].upper(), "", "", None, None, "one two", "one  two!", "one two three", "...", "...", "w " * 30_000, ("w " * 30_000) + "w"]
    return texts


def weigh(texts):
    """Exact document counts in place of hashed cells, with the same least count."""
    sets = [Counter(tuple(w[i : i + 5]) if len(w) >= 5 else tuple(w) for i in range(max(1, len(w) - 4)) if w) for w in (re.findall(r"[^\W_]+", (t or "").lower()) for t in texts)]
    df, n = Counter(s for own in sets for s in own), max(2, sum(t is not None for t in texts))
    least = max(RARE * n, 4 * np.sqrt(sum(df.values()) / CELLS), 1)
    idf = lambda s: min(1, np.log(n / df[s]) / np.log(1 / RARE)) if df[s] > least else 1
    return [{s: (1 + np.log(c)) * (1 + RARITY * idf(s)) for s, c in own.items()} for own in sets]


def similarity(a, b):
    both = sum(min(w, b[s]) for s, w in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def closure(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_against_brute_force(spark):
    texts = corpus()
    weights, pairs = weigh(texts), {}
    for i in range(len(texts)):
        for j in range(i):
            s = similarity(weights[i], weights[j])
            if s > 0.6:
                pairs[i, j] = s
    same = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i] is not None and texts[j] is not None and texts[i].lower() == texts[j].lower()]
    rows = [(i, t, "c", 0) for i, t in enumerate(texts)] + [(None, texts[0], None, None), (None, None, None, None), (4, texts[4], "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string, kept int")
    got = N.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    # hashed document counts move weights a little: pairs clearly above must be together, pairs clearly below apart
    sure = closure(len(texts), same + [p for p, s in pairs.items() if s >= 0.83])
    wide = closure(len(texts), same + [p for p, s in pairs.items() if s >= 0.77])
    lost = sum(of[i] != of[j] for i in range(len(texts)) for j in [sure[i]])
    assert lost <= 1
    assert all(wide[i] == wide[of[i]] for i in range(len(texts)))
    assert all(r.kept == (r.doc_id == r.class_id) for r in got if r.doc_id is not None)
    assert all(r.kept and r.class_id is None for r in got if r.doc_id is None)
    kept = N.keep_one(docs).collect()
    assert Counter(r.doc_id for r in kept if r.doc_id is not None) == Counter({i: 1 for i in range(len(texts)) if of[i] == i})
    assert sum(r.doc_id is None for r in kept) == 2 and kept[0].__fields__ == ["doc_id", "text", "class_id", "kept"]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(docs).count() == 0 and N.keep_one(docs).count() == 0


def test_samples_agree_as_often_as_similar():
    pick = np.random.default_rng(2)
    h, w = np.unique(pick.integers(0, 2**63, 9000, dtype=np.uint64)), np.exp(pick.normal(size=9000))
    a, b = (h[:8000], w[:8000]), (h[1000:], w[1000:] * pick.choice([1, 1.4], 8000))  # more shingles than one block
    s = Sampler(3000)([a, b, (h[:0], w[:0])])
    assert abs((s[0] == s[1]).mean() - weighted_jaccard(a, b)) < 0.03 and not s[2].any()


def test_weights(spark):
    texts = ["a b c d e f g"] * 40 + [f"x{k} y{k} z{k} u{k} v{k} w{k}" for k in range(400)]
    weights = learn_weights(spark.createDataFrame([(t,) for t in texts], "text string"))
    common, rare = (shingles(*text_buffer(pa.array([t])))[0] for t in (texts[0], texts[-1]))
    assert np.allclose(weights(common, np.ones(3)), 1 + RARITY * np.log(len(texts) / 40) / np.log(1 / RARE), atol=0.02)
    assert np.allclose(weights(rare, np.ones(2)), 1 + RARITY, atol=0.001)


def test_weights_do_not_drift_with_size():
    """A shingle that one document in fifty has weighs the same in a small and a large table."""
    pick, seen = np.random.default_rng(3), []
    hashes = pick.integers(0, 2**63, 50, dtype=np.uint64) * np.uint64(2)
    for documents in (50_000, 5_000_000, 500_000_000):
        counts = pick.poisson(documents * 300 / CELLS, 2 * CELLS).astype(float)
        for cells in weighted._cells(hashes):
            counts[cells] += documents / 50
        seen.append(weighted.Weights(counts, documents)(hashes, np.ones(50)))
    assert np.ptp(seen, axis=0).max() < 0.01 and np.allclose(seen[-1], 1 + RARITY * np.log(50) / np.log(1 / RARE), atol=0.01)


def test_several_texts_under_one_id(spark):
    pick = random.Random(4)
    a, b = (" ".join("".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(120)) for _ in range(2))
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (1, a), (4, a.upper()), (5, None), (5, None), (None, a)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _digest int")
    got = Counter((r.doc_id, r.class_id) for r in N.near_duplicates(docs).collect())
    assert got == {(1, 1): 3, (2, 1): 1, (3, 1): 1, (4, 1): 1, (5, 5): 2, (None, None): 1}
    kept = sorted(r["_digest"] for r in N.keep_one(docs).collect())
    assert kept in ([0, 1, 6, 7, 8], [1, 4, 6, 7, 8])


def test_recall_at_the_threshold(spark):
    """All pairs of the table by exact weights: what share of those at 0.8 and more ends in one class, near copies alone."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    weights = learn_weights(docs.select(F.lower("text").alias("text")))
    sets = [(h, weights(h, tf)) for h, tf in N.shingle_sets(*text_buffer(pa.array([t.lower() for _, t in rows])), 5)]
    of = {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()}
    meet = {}
    for k, (h, _) in enumerate(sets):  # similar texts share one of the few shingles that are least by another hash
        for x in h[np.argsort(h * np.uint64(0x9E3779B97F4A7C15))[:40]].tolist():
            meet.setdefault(x, []).append(k)
    pairs = Counter((a, b) for own in meet.values() if len(own) < 60 for n, a in enumerate(own) for b in own[n + 1 :])
    near = [(a, b) for (a, b), n in pairs.items() if n > 8 and weighted_jaccard(sets[a], sets[b]) >= 0.8 and rows[a][1].lower() != rows[b][1].lower()]
    together = sum(of[rows[a][0]] == of[rows[b][0]] for a, b in near)
    assert len(near) > 100 and together >= 0.99 * len(near)


def test_components(spark):
    pick = random.Random(6)
    links = [(pick.randrange(400), pick.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(500, 620)] + [(700, k) for k in range(701, 900)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "src long, dst long")).collect()}
    want = closure(1000, links)
    assert all(got.get(k, k) == want[k] for k in range(1000))
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_items_bound_the_shared_weight(spark):
    texts = ["a b c d e f g h a b c d e f g h a b c d e", "a b c d e f g h i j k a b c d e x", "", "one two"]
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    weights = learn_weights(rows)
    items = {r.node: set(r["items"]) for r in N.weighted_items(rows, weights, 5).collect()}
    sets = [(h, weights(h, tf)) for h, tf in N.shingle_sets(*text_buffer(pa.array(texts)), 5)]
    for i in range(len(texts)):
        for j in range(len(texts)):
            _, p, q = np.intersect1d(sets[i][0], sets[j][0], return_indices=True)
            true = np.minimum(sets[i][1][p], sets[j][1][q]).sum()
            got = sum(x & 0xFFFF for x in items[i] & items[j]) / N.UNITS
            assert true <= got + 1e-9 and got <= true + len(items[i]) / N.UNITS
