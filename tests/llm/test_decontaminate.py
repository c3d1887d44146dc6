import random
import re
from functools import lru_cache

from lodestack.llm import decontaminate as D


@lru_cache(None)
def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@lru_cache(None)
def grams(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def found(item, text):
    """(shared, of) of the item's shingles; an item of fewer words is one run of them all."""
    w, own = words(item), words(text)
    if 0 < len(w) < 5:
        return int(f" {' '.join(w)} " in f" {' '.join(own)} "), 1
    s = grams(item)
    return len(s & grams(text)), len(s)


def corpus():
    pick = random.Random(3)
    words = ["".join(pick.choice("abcdefghé") for _ in range(pick.randint(1, 7))) for _ in range(500)]
    say = lambda n: [pick.choice(words) for _ in range(n)]
    items = [say(pick.choice([2, 3, 4, 5, 6, 12, 30, 40, 70, 300])) for _ in range(120)]
    docs = []
    for k in range(500):
        doc = say(pick.choice([0, 3, 50, 200, 3000]) if k % 50 else 20_000)
        for _ in range(pick.choice([0, 0, 1, 2])):
            item = list(pick.choice(items))
            if pick.random() < 0.5:
                for _ in range(pick.randint(1, 3)):
                    item[pick.randrange(len(item))] = pick.choice(words)
            at = pick.randint(0, len(doc))
            doc[at:at] = [w.upper() for w in item] if pick.random() < 0.3 else item
        docs.append(" ".join(doc) if pick.random() < 0.9 else ",\n".join(doc))
    docs += [docs[7], docs[7], None, ""] + [" ".join(items[3])] * 150 + ["so there are too few words", "too few", "too “few” words", "one　two"]  # a passage that many documents share
    return docs, [" ".join(i) for i in items]


def test_against_brute_force(spark, monkeypatch):
    docs, items = corpus()
    rows = [(k, t, "c", 1.0) for k, t in enumerate(docs)] + [(5, docs[5], "c", 1.0), (None, " ".join(items[9].split()), None, None), (None, None, None, None)]
    bench = [(k, t, "c") for k, t in enumerate(items)] + [(900, None, "c"), (901, "Too few—words", "c"), (903, "éa", "c"), (None, docs[8], None), (902, "", "c"), (2, items[2], "c")]
    table = spark.createDataFrame(rows, "doc_id long, text string, item_id string, containment double")
    asked = spark.createDataFrame(bench, "item_id long, text string, doc_id string")
    known, want = {k: t for k, t, _ in bench if k is not None and k < 1000}, set()
    known |= dict(enumerate(items))
    for i, t, *_ in rows:
        for k, item in known.items():
            shared, of = found(item, t)
            want |= {(i, k)} if of and shared >= 0.8 * of else set()
    got = D.contamination_report(table, asked).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 300
    share = lambda r: found(known[r.item_id], docs[r.doc_id])
    assert all(abs(r.containment - share(r)[0] / share(r)[1]) < 1e-12 for r in got if r.doc_id is not None)
    few = D.contaminated(table, asked, most=400)  # many passes give the same
    assert {(r.doc_id, h.item_id) for r in few.collect() for h in r.hits} == want
    monkeypatch.setattr(D, "PASS_SHINGLES", 3000)
    clean = D.clean_documents(table, asked)
    dirty = {i for i, _ in want}
    assert clean.columns == table.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t, *_ in rows if i not in dirty or (i is None and t is None))


def test_signatures_fit_their_class():
    sizes = [D.signature(1 << k, 0.8) for k in range(6, 14)]
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(sizes, sizes[1:])) and all(n // 3 < need < n for n, need in sizes)


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contamination_report(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert D.contamination_report(some, items.limit(0)).count() == 0
    assert D.clean_documents(some, items.limit(0)).count() == 1 and D.clean_documents(some, items).count() == 0
