import math
import random
import zlib

import numpy as np
from lodestack.llm import language as L

SF = "/root/testdata/sf0.01"


def slow_bits(texts: list[bytes], text: bytes) -> float:
    """The same code length by dictionaries, byte by byte."""
    tree: dict[bytes, dict[int, int]] = {}
    for t in texts:
        t = bytes([L.EDGE]) * L.ORDER + t
        for i in range(L.ORDER, len(t)):
            for k in range(L.ORDER + 1):
                node = tree.setdefault(t[i - k : i], {})
                node[t[i]] = node.get(t[i], 0) + 1
    total, text = 0.0, bytes([L.EDGE]) * L.ORDER + text
    for i in range(L.ORDER, len(text)):
        for k in range(L.ORDER, -1, -1):
            node = tree.get(text[i - k : i], {})
            n, d = sum(node.values()), len(node)
            if n < 2 and k or not n:
                continue
            if text[i] in node:
                total += math.log2((n + d) / node[text[i]])
                break
            total += math.log2((n + d) / d)
        else:
            total += 8
    return total


def test_code_lengths_are_exact():
    pick = random.Random(4)
    word = lambda a: bytes(pick.choice(a) for _ in range(pick.randint(0, 60)))
    texts = {"x": [word(b"abcde ") for _ in range(20)], "y": [word(b"defgh\xc3\xa9 ") for _ in range(15)]}
    ppm = L.PPM(texts)
    ask = [word(b"abcdefgh \xc3\xa9z") for _ in range(30)] + [b"", b"q"]
    raw, offsets = np.frombuffer(b"".join(ask), np.uint8), np.r_[0, np.cumsum([len(a) for a in ask])]
    got = ppm.code_lengths(raw, offsets)
    assert np.allclose(got, ppm.code_lengths(raw, offsets, block=7))
    for i, name in enumerate(ppm.names):
        assert np.allclose(got[:, i], [slow_bits(texts[name], a) for a in ask], atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = L.identify(docs).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) / len(out) > 0.97


def test_edges(spark):
    base = [(k, "the house and the tree " * 3, "en", "c") for k in range(40)] + [(k, "das Haus und der Baum " * 3, "de", "c") for k in range(40, 80)]
    odd = [(80, None, "en", "c"), (81, "", "de", "c"), (82, "123 ...", None, "c"), (83, "der Baum", None, None), (None, "the tree", "fr", "c"), (0, "the house", "en", "c"), (84, "und der Baum " * 20_000, None, "c")]
    docs = spark.createDataFrame(base + odd, "doc_id long, text string, lang string, score string")
    got = L.identify(docs).collect()
    assert len(got) == len(base) + len(odd)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (80, 81, 82, 83, None, 84)] == ["und", "und", "und", "de", "en", "de"]
    assert by[None].held_out and by[80].score == 0
    assert L.identify(docs.limit(0)).count() == 0
