"""Operator 8: quality classification by random-indexing word vectors and a two-layer network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, held_out, table
from .kernels import span_hashes, text_buffer
from .tables import sum_tables

#: rows of the vector table: hashed words, then shapes; length of a vector; the sample's bound, in documents of a label
WORDS, SHAPES, DIM, SAMPLE_DOCS = 1 << 13, 1 << 12, 64, 4000
ACCEPT = 0.7
BATCH_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CLASS = np.full(256, 3, np.uint8)  # other
for _lo, _hi, _c in ((97, 123, 0), (65, 91, 1), (48, 58, 2), (128, 256, 0)):
    _CLASS[_lo:_hi] = _c


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the word, row of the shape, index of each document's first token with the end) of the runs between white space.

    A shape tells the classes of the first, second and last byte, the length, how many bytes are neither letter nor digit,
    and whether the word is one of the two before it.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = False
    before[1:], after[:-1] = solid[:-1], solid[1:]
    before[offsets[offsets < n]] = False
    after[offsets[offsets > 0] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    words = span_hashes(data, starts, ends)
    kind = _CLASS[data]
    signs = np.r_[0, np.cumsum(kind == 3)]
    signs = np.minimum(signs[ends] - signs[starts], 3)
    length = np.minimum((ends - starts) // 3, 7)
    second = kind[np.minimum(starts + 1, ends - 1)]
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[2:] |= words[2:] == words[:-2]
    shape = ((((kind[starts].astype(np.int64) * 4 + second) * 4 + kind[ends - 1]) * 8 + length) * 4 + signs) * 2 + same
    return (words >> np.uint64(51)).astype(np.int64), WORDS + shape, np.searchsorted(starts, offsets)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places of the one +1 and the one -1 in the index vector of each row."""
    pick = np.random.default_rng(11)
    plus = pick.integers(0, DIM, WORDS + SHAPES)
    return plus, (plus + pick.integers(1, DIM, WORDS + SHAPES)) % DIM


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Random indexing over all texts: each row's vector is the sum of the index vectors of the words and shapes next to it, scaled to length 1."""

    def count(it: Iterator[pa.RecordBatch]) -> np.ndarray:
        plus, minus = index_vectors()
        size = (WORDS + SHAPES) * DIM
        total = np.zeros(size, np.int64)
        for batch in batches(it, 4 * BATCH_BYTES):
            word, shape, first = tokens(*text_buffer(batch.column("text")))
            if len(word) < 2:
                continue
            together = np.ones(len(word) - 1, bool)  # neighbours in one document
            together[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(word))] - 1] = False
            left, right = np.flatnonzero(together), np.flatnonzero(together) + 1
            at = [own[a] * DIM for a in (left, right) for own in (word, shape)]
            for signs, add in ((plus, 1), (minus, -1)):
                near = [signs[own[b]] for b in (right, left) for own in (word, shape)]
                for k in (0, 1):
                    for j in (0, 1):
                        places = np.concatenate([at[k] + near[j], at[2 + k] + near[2 + j]])
                        total += add * np.bincount(places, minlength=size)
        return total

    total = sum_tables(docs.select("text"), count, (WORDS + SHAPES) * DIM).reshape(-1, DIM).astype(np.float64)
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def document_vectors(vectors: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean word vector, mean shape vector and log length of each text; zeros for a text without words."""
    word, shape, first = tokens(data, offsets)
    n = len(offsets) - 1
    out = np.zeros((n, 2 * DIM + 1), np.float32)
    counts = np.diff(first)
    for k in np.flatnonzero(counts):
        a, b = first[k], first[k + 1]
        for part, own in ((0, word), (1, shape)):
            seen = np.bincount(own[a:b], minlength=0) if b - a > 4 * WORDS else None
            rows = vectors[own[a:b]] if seen is None else None
            out[k, part * DIM : (part + 1) * DIM] = rows.mean(axis=0) if seen is None else (seen @ vectors[: len(seen)]) / (b - a)
    out[:, -1] = np.log1p(counts)
    return out


class Network:
    """Two layers, trained by Adam on weighted cross entropy; a temperature fitted on rows kept apart divides the logit."""

    HIDDEN, EPOCHS, BATCH, RATE = 32, 40, 128, 3e-3

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        pick = np.random.default_rng(5)
        order = pick.permutation(len(x))
        apart, own = order[: len(x) // 5], order[len(x) // 5 :]
        self.mean, self.scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-3
        z = self._standard(x)
        self.p = [pick.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], self.HIDDEN)), np.zeros(self.HIDDEN), pick.normal(0, 1 / np.sqrt(self.HIDDEN), self.HIDDEN), np.zeros(1)]
        first, second, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(self.EPOCHS):
            pick.shuffle(own)
            for a in range(0, len(own), self.BATCH):
                rows = own[a : a + self.BATCH]
                step += 1
                for k, g in enumerate(self._gradients(z[rows], y[rows], weight[rows])):
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.p[k] -= self.RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        logit = self._logit(z[apart])
        loss = lambda t: float((weight[apart] * np.logaddexp(0, np.where(y[apart] == 1, -1, 1) * logit / t)).sum())
        self.temperature = min(np.geomspace(0.25, 8, 61), key=loss) if len(apart) else 1.0

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def _gradients(self, z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        h = np.tanh(z @ self.p[0] + self.p[1])
        d = weight * (1 / (1 + np.exp(-(h @ self.p[2] + self.p[3][0]))) - y) / len(y)
        back = np.outer(d, self.p[2]) * (1 - h * h)
        return [z.T @ back + 1e-4 * self.p[0], back.sum(axis=0), h.T @ d + 1e-4 * self.p[2], np.array([d.sum()])]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._logit(self._standard(x)) / self.temperature, -30, 30)))


def labelled_ids(labels: DataFrame, per_label: int) -> tuple[list[tuple], dict[int, int]]:
    """At most `per_label` (doc_id, quality) of each label among the rows that may be learnt from, and all their counts. Conflicting labels of an id: the lower one."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r.quality: r["count"] for r in rows.groupBy("quality").count().collect()}
    share = F.lit(0)
    for label, n in counts.items():
        share = F.when(F.col("quality") == label, min(1 << 30, (per_label << 30) // n + 1)).otherwise(share)
    few = rows.filter(F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 30)) < share)
    return [tuple(r) for r in few.orderBy("doc_id").collect()], counts


class Model:
    def __init__(self, vectors: np.ndarray, network: Network | None):
        self.vectors, self.network = vectors, network

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(offsets) - 1, 0.5)
        return self.network.score(document_vectors(self.vectors, data, offsets))


def learn(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_DOCS) -> Model:
    """Vectors from all texts; the network from the texts of a bounded sample of labelled rows, each weighted for the rows of its label that it stands for."""
    spark = docs.sparkSession
    vectors = context_vectors(docs)
    ids, counts = labelled_ids(labels, per_label)
    if len({q for _, q in ids}) < 2:
        return Model(vectors, None)
    shared = spark.sparkContext.broadcast(vectors)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, BATCH_BYTES):
            x = document_vectors(shared.value, *text_buffer(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array([r.tobytes() for r in x])], ["doc_id", "quality", "x"])

    wanted = spark.createDataFrame(ids, "doc_id long, quality int")  # bounded: 2 * per_label rows or so
    seen = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(wanted), "doc_id").select("doc_id", "quality", "text")
    seen = seen.mapInArrow(run, "doc_id long, quality int, x binary").groupBy("doc_id", "quality").agg(F.min("x").alias("x"))  # an id that repeats teaches once
    rows = sorted((r.doc_id, r.quality, bytes(r.x)) for r in seen.collect())
    if len({q for _, q, _ in rows}) < 2:
        return Model(vectors, None)
    x = np.array([np.frombuffer(r[2], np.float32) for r in rows], np.float64)
    y = np.array([r[1] for r in rows])
    weight = np.array([counts[q] / max(1, int((y == q).sum())) for q in y])
    return Model(vectors, Network(x, y, weight / weight.mean()))


def score_documents(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, per_label: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 where score >= accept).

    A null text scores as an empty one. A null doc_id is held out. Labels that are null or neither 0 nor 1 teach
    nothing; if only one label is left, every score is 0.5. Repeated rows are each scored; an empty table gives an
    empty result; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, per_label))  # a table of fixed size and the network

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, BATCH_BYTES):
            score = model.value.scores(*text_buffer(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= accept).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def accepted_documents(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, per_label: int = SAMPLE_DOCS) -> DataFrame:
    """The documents whose score reaches `accept`, with all their columns as they are.

    A null text is judged as an empty one; rows with a null doc_id and repeated rows are judged as any other; columns of
    any name are kept; an empty table stays empty.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, per_label))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, BATCH_BYTES):
            yield batch.filter(pa.array(model.value.scores(*text_buffer(batch.column("text"))) >= accept))

    return docs.mapInArrow(run, docs.schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
