import hashlib
import random

import numpy as np
import pytest
from lodestack.llm.bpe import ByteBPE, bpe_round_trip, default_tokenizer
from lodestack.llm.transducer import Transducer, compile_words
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, n_tokens string, word string"
PARTS = ["a", "b", "é", "'", "s", "t", "re", "ll", " ", "  ", "\n", "1", "½", "!", "--", "<|endoftext|>", "日本", "\x1c", "\x85", "'s", "'ve", " '", "I'm", "\r\n", "🙂", "́", "²", "<|endof"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def texts():
    pick = random.Random(3)
    own = ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 30))) for _ in range(300)]
    return [*own, "", None, "x" * 3000, "word " * 5000, "same", "same", "<|endoftext|>", "<|endoftext|><|endoftext|> a"]


def test_as_the_library(spark, library):
    rows = [(k, x, "clash", "clash") for k, x in enumerate(texts())] + [(None, "no id", None, None)]
    got = {r.doc_id: r for r in bpe_round_trip(spark.createDataFrame(rows, SCHEMA), lexicon_words=20, ids=True).collect()}
    assert len(got) == len(rows)
    for k, x, _, _ in rows:
        ids = library.encode(x or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert got[k].n_tokens == len(ids) and bytes(got[k].ids) == raw
        assert got[k].ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert got[k].decoded == library.decode(ids, skip_special_tokens=False) == (x or "")


def test_empty_table(spark):
    assert bpe_round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_all_merges_agree():
    bpe = ByteBPE(open(default_tokenizer(), encoding="utf-8").read())
    pick = random.Random(1)
    words = [bytes(pick.choice(b"theandrsing \xc3\xa9") for _ in range(pick.randint(0, 90))) for _ in range(200)] + [b"aaaa", b"a" * 64, b"a" * 65]
    for word, ids in zip(words, bpe.merge_all(words), strict=True):
        assert bpe.merge(word) == bpe.merge_long(word) == list(ids)
    assert bpe.merge_all([]) == []


def test_transducer_shares_suffixes(tmp_path):
    words = {w.encode(): [k, k + 1] for k, w in enumerate(["", "stating", "stat", "rating", "rat", "hating", "éting"])}
    (tmp_path / "x.fst").write_bytes(compile_words(words))
    t = Transducer(str(tmp_path / "x.fst"))
    assert [x.tolist() for x in t.get_all(list(words))] == list(words.values())
    assert t.get_all([b"hat", b"x", b"statingx", b"statin"]) == [None] * 4
    assert len(t.final) < sum(map(len, words)) and t.words == len(words)


def test_transducer_without_words(tmp_path):
    (tmp_path / "x.fst").write_bytes(compile_words({}))
    assert Transducer(str(tmp_path / "x.fst")).get_all([b"a", b""]) == [None, None]


def test_no_worker_keeps_an_encoder(spark):
    docs = spark.createDataFrame([(n, f"word number {n} " * 3) for n in range(40)], "doc_id long, text string").repartition(4)
    assert len(bpe_round_trip(docs).collect()) == 40

    def held(it):
        import gc

        import pyarrow as pa
        from lodestack.llm.pretokens import Encoder

        gc.collect()
        for _ in it:
            yield pa.RecordBatch.from_pydict({"n": [sum(isinstance(x, Encoder) for x in gc.get_objects())]})

    assert {r.n for r in spark.range(8).repartition(4).mapInArrow(held, "n long").collect()} == {0}
