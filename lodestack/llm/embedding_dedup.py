"""Operator 4: embedding near-duplicates by a random-projection tree forest, and exactly around dense places.

Where more vectors lie within the cosine of each other than a leaf holds, no split can part near from far. Such places
become balls: every vector in one is compared with all that can link to it, block by block; the trees hold the rest.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, remove, table
from .components import components
from .kernels import mix

COSINE = 0.9
#: trees; share of a node's vectors that go to both sides, on either side of the split; vectors a leaf aims at
TREES, SPILL, LEAF = 12, 0.07, 256
#: a tree, and later each part of it that is still too large, is fitted on so many of its vectors; every vector is placed
SAMPLE = 8192
MOST_ROUNDS = 40
#: vectors of a large leaf that one task puts into its smaller ones
PLACED = 50_000
#: a place is dense if a sampled vector has so many sampled ones within the cosine, standing for more than a large leaf
DENSE_SEEN = 16
#: vectors of a ball that one task compares with as many others, and the least that it is cut to
BLOCK, LEAST_BLOCK = 4096, 512


class Tree:
    """Recursive random splits: each node projects on a random direction and cuts near the median; vectors within the
    spill go to both sides."""

    def __init__(self, x: np.ndarray, seed: int, leaf: float, spill: float = SPILL):
        self.pick, self.leaf, self.spill, self.leaves = np.random.default_rng(seed), max(8.0, leaf), spill, 0
        self.root = self._fit(x, 0)
        del self.pick

    def _fit(self, x: np.ndarray, depth: int):
        if len(x) <= self.leaf or depth > 40:
            self.leaves += 1
            return self.leaves - 1
        direction = self.pick.normal(size=x.shape[1])
        p, middle = x @ direction, self.pick.uniform(0.45, 0.55)
        low, high = np.quantile(p, [middle - self.spill, middle + self.spill])
        if low == p.min() == p.max():
            self.leaves += 1
            return self.leaves - 1
        return direction, low, high, self._fit(x[p <= high], depth + 1), self._fit(x[p >= low], depth + 1)

    def place(self, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, rows in it) of all rows; a row can be in several leaves."""
        out, stack = [], [(self.root, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                out.append((node, rows))
                continue
            direction, low, high, left, right = node
            p = x[rows] @ direction
            stack += [(left, rows[p <= high]), (right, rows[p >= low])]
        return out


def unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one length, in double precision and scaled to length 1, and which rows have one (not null, not zero, all finite)."""
    rows = column.to_pylist() if column.null_count or (len(column) and column.values.null_count) else None
    if rows is None and len(column) and len(set(np.diff(column.offsets.to_numpy()))) == 1:
        x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    else:
        rows = column.to_pylist() if rows is None else rows
        width = max((len(r) for r in rows if r is not None), default=0)
        x = np.full((len(rows), width), np.nan)
        for k, r in enumerate(rows):
            if r is not None and len(r) == width and None not in r:
                x[k] = r
    if not x.shape[1]:
        return x, np.zeros(len(x), bool)
    top = np.abs(x).max(axis=1, initial=0)
    good = np.isfinite(x).all(axis=1) & (top > 0)
    with np.errstate(all="ignore"):
        x = x / np.where(good, top, 1)[:, None]
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x, good


def _leaf_id(parent: int, seed: int, leaf: int) -> int:
    both = np.array([parent, seed, leaf], np.int64).view(np.uint64)
    return int(mix(mix(both[:1]) * np.uint64(0x9E3779B97F4A7C15) + mix(both[1:2] + np.uint64(7)) + both[2:] * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)[0])


def fingerprints(vectors: DataFrame) -> DataFrame:
    """vec_id, digest of the vector, width and embedding; vectors that cannot link have a null digest and no embedding."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            digests, widths, keep = [], [], []
            for row in batch.column("embedding").to_pylist():
                own = np.array(row, np.float64) if row and None not in row else np.zeros(0)
                usable = len(own) and np.isfinite(own).all() and own.any()
                digests.append(hashlib.sha256(own.tobytes()).digest()[:20] if usable else None)
                widths.append(len(own))
                keep.append(row if usable else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(digests, pa.binary()), pa.array(widths, pa.int32()), pa.array(keep, batch.column("embedding").type)], ["vec_id", "digest", "width", "embedding"])

    kind = dict(vectors.dtypes)["embedding"]
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, f"vec_id long, digest binary, width int, embedding {kind}")


def _sampled(rows: DataFrame, count: int) -> DataFrame:
    """About SAMPLE of `count` rows by a hash of the node."""
    return rows.filter(F.pmod(F.xxhash64(F.lit("forest"), "node"), F.lit(1 << 30)) < min(1 << 30, (SAMPLE << 30) // max(1, count) + 1))


def plant(nodes: DataFrame, count: int, trees: int, leaf: int) -> DataFrame:
    """Adds `leaves`, the ids of the leaves of all trees that a vector is in. The trees are fitted on one bounded sample."""
    rows = [r.embedding for r in _sampled(nodes, count).select("embedding", "node").orderBy("node").collect()]
    x, good = unit(pa.array(rows, pa.list_(pa.float64())))
    forest = [Tree(x[good], seed, leaf * len(rows) / max(1, count)) for seed in range(trees)] if len(rows) else []
    shared = nodes.sparkSession.sparkContext.broadcast(forest)  # SAMPLE vectors' worth of splits a tree at most

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x, _ = unit(batch.column("embedding"))
            leaves: list[list[int]] = [[] for _ in range(len(x))]
            for seed, tree in enumerate(shared.value):
                for k, own in tree.place(x):
                    i = _leaf_id(0, seed, k)
                    for row in own.tolist():
                        leaves[row].append(i)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "copies", "embedding")), pa.array(leaves, pa.list_(pa.int64()))], ["node", "copies", "embedding", "leaves"])

    kind = dict(nodes.dtypes)["embedding"]
    return nodes.select("node", "copies", "embedding").mapInArrow(run, f"node long, copies long, embedding {kind}, leaves array<long>")


def dense(x: np.ndarray, share: float, cosine: float, leaf: int) -> list[int]:
    """Rows of the sample x that cover its dense ones: each of these is within the cosine of one. The sample is `share` of all."""
    hits = np.concatenate([(x[a : a + 512] @ x.T >= cosine).sum(axis=1) for a in range(0, len(x), 512)] or [np.zeros(0, int)])
    rows, picked = np.flatnonzero((hits >= DENSE_SEEN) & (hits > 4 * leaf * share)), []
    while len(rows):
        picked.append(int(rows[0]))
        rows = rows[1:][x[rows[1:]] @ x[rows[0]] < cosine]
    return picked


def sampled_centres(nodes: DataFrame, count: int, cosine: float, leaf: int) -> np.ndarray:
    """Centres of the places that are dense in one bounded sample of all vectors."""
    rows = [r.embedding for r in _sampled(nodes, count).select("embedding", "node").orderBy("node").collect()]
    x, good = unit(pa.array(rows, pa.list_(pa.float64())))
    x = x[good]
    return x[dense(x, len(x) / max(1, count), cosine, leaf)]


def _large(placed: DataFrame, leaf: int) -> DataFrame:
    return cut(placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n")).filter(F.col("n") > 4 * leaf), "large")


def crowded_centres(placed: DataFrame, leaf: int, cosine: float) -> np.ndarray | None:
    """Centres of the places that are dense in a bounded sample of a large leaf, none within the cosine of another; None if there is none."""
    sizes = _large(placed, leaf)
    if sizes.isEmpty():
        return None
    inside = placed.select("node", "embedding", F.explode("leaves").alias("leaf")).join(sizes, "leaf")
    # leaves of one size sample the same nodes, in the same order: they mostly find the same centres
    few = inside.withColumn("at", F.pmod(F.xxhash64(F.lit("dense"), "node"), F.lit(1 << 30))).filter(F.col("at") < F.lit((SAMPLE // 2) << 30) / F.col("n"))

    def find(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("at", "ascending"), ("node", "ascending")])
        x, good = unit(rows["embedding"].combine_chunks())
        picked = np.flatnonzero(good)[dense(x[good], int(good.sum()) / rows["n"][0].as_py(), cosine, leaf)]
        return pa.table({"node": rows["node"].combine_chunks().take(pa.array(picked, pa.int64())), "centre": pa.array(list(x[picked]), pa.list_(pa.float64()))})

    centres = few.groupBy("leaf").applyInArrow(find, "node long, centre array<double>").dropDuplicates(["node"])
    kept: list[np.ndarray] = []
    for row in centres.orderBy("node").collect():  # one for more than 4 * leaf vectors each
        own = np.array(row.centre)
        if not kept or (np.array(kept) @ own).max() < cosine:
            kept.append(own)
    return np.array(kept) if kept else None


def deal(nodes: DataFrame, centres: np.ndarray, cosine: float) -> DataFrame:
    """Adds `ball`, the nearest centre within the cosine or -1, and `halo`, all balls with vectors that can link to it:
    at most the angle of the cosine lies between a vector and its centre, and as much again to a linked one."""
    wide = 2 * cosine * cosine - 1 if cosine > 0 else -1.0
    shared = nodes.sparkSession.sparkContext.broadcast(centres)
    cols = nodes.columns

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x, _ = unit(batch.column("embedding"))
            balls, halos = [], []
            for a in range(0, len(x), 256):
                near = x[a : a + 256] @ shared.value.T
                best = near.argmax(axis=1)
                balls += np.where(near.max(axis=1) >= cosine, best, -1).tolist()
                halos += [np.flatnonzero(r).tolist() for r in near >= wide - 1e-9]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(balls, pa.int32()), pa.array(halos, pa.list_(pa.int32()))], [*cols, "ball", "halo"])

    return nodes.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in nodes.dtypes) + ", ball int, halo array<int>")


def together(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the rows and columns that a table of links connects; -1 for a column without any."""
    rows, cols, turned = np.full(len(hit), -1), np.full(hit.shape[1], -1), np.ascontiguousarray(hit.T)
    for k in range(len(hit)):
        if rows[k] >= 0:
            continue
        rows[k], new = k, np.array([k])
        while len(new):
            other = np.flatnonzero(hit[new].any(axis=0) & (cols < 0))
            cols[other] = k
            new = np.flatnonzero(turned[other].any(axis=0) & (rows < 0))
            rows[new] = k
    return rows, cols


def link_balls(dealt: DataFrame, cosine: float) -> DataFrame:
    """(node, root, links) as of link_leaves, for all pairs with a vector in a ball. Ball and halo are cut to blocks, and
    each pair of blocks is a group of its own. A pair of vectors in balls counts for each in its own ball, another pair
    in the one ball that it meets."""
    every = dealt.select("node", "copies", "embedding", "ball", F.explode("halo").alias("of"))
    core = F.col("ball") == F.col("of")
    sizes = every.groupBy("of").agg(F.sum(core.cast("long")).alias("n"), F.count("*").alias("m")).filter("n > 0")
    parts = lambda n: F.ceil(n / F.least(F.lit(BLOCK), F.greatest(F.lit(LEAST_BLOCK), n / 8)))
    sizes = cut(sizes.select("of", parts(F.col("n")).alias("across"), parts(F.col("m")).alias("down")), "balls")
    every = every.join(sizes, "of")
    own = lambda n: F.pmod(F.xxhash64(F.lit("block"), "node"), F.col(n))
    cols = ["of", "node", "copies", "embedding", (F.col("ball") >= 0).alias("inside")]
    asked = every.filter(core).select(*cols, F.lit(True).alias("asks"), own("across").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("j"))
    there = every.select(*cols, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("i"), own("down").alias("j"))

    def run(rows: pa.Table) -> pa.Table:
        x, _ = unit(rows["embedding"].combine_chunks())
        nodes, copies, inside, asks = (rows[c].to_numpy() for c in ("node", "copies", "inside", "asks"))
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        hit = np.zeros((len(a), len(b)), bool)
        links = np.zeros(len(x), np.int64)
        for k in range(0, len(a), 512):
            hit[k : k + 512] = (x[a[k : k + 512]] @ x[b].T >= cosine) & (nodes[a[k : k + 512], None] != nodes[b])
            links[a[k : k + 512]] = [copies[b[r]].sum() for r in hit[k : k + 512]]
            links[b] += np.array([copies[a[k : k + 512]][c].sum() for c in hit[k : k + 512].T], np.int64)
        links[b[inside[b]]] = 0
        at, to = together(hit)
        least = np.full(len(a), np.iinfo(np.int64).max)
        np.minimum.at(least, at, nodes[a])
        np.minimum.at(least, to[to >= 0], nodes[b[to >= 0]])
        root = nodes.copy()
        root[a], root[b[to >= 0]] = least[at], least[to[to >= 0]]
        said = (links > 0) | (root != nodes)
        return pa.table({"node": nodes[said], "root": root[said], "links": links[said]})

    return asked.unionByName(there).groupBy("of", "i", "j").applyInArrow(run, "node long, root long, links long")


def split_large(placed: DataFrame, leaf: int, round_: int) -> DataFrame | None:
    """Leaves of more than four times `leaf` vectors get trees of their own, each fitted in one task on a bounded sample; None if there is none."""
    sizes = _large(placed, leaf)
    if sizes.isEmpty():
        return None
    kind = dict(placed.dtypes)["embedding"]
    inside = cut(placed.select("node", "embedding", F.explode("leaves").alias("leaf")).join(sizes, "leaf"), "inside")
    deal = F.ceil(F.col("n") / PLACED).cast("long")
    few = inside.filter(F.pmod(F.xxhash64(F.lit("forest"), "node", "leaf"), F.lit(1 << 20)) < F.greatest(F.lit(1), (F.lit((SAMPLE // 2) << 20) / F.col("n")).cast("long")))

    def fit(rows: pa.Table) -> pa.Table:
        x, good = unit(rows["embedding"].combine_chunks())
        n, parent = rows["n"][0].as_py(), rows["leaf"][0].as_py()
        tree = Tree(x[good], (parent ^ round_) & 0x7FFFFFFF, leaf * len(x) / n)
        return pa.table({"leaf": [parent], "tree": [pickle.dumps(tree)]})

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None  # a tree comes before the vectors of its leaf
        for batch in it:
            out = []
            parents, trees = np.array(batch.column("leaf").to_pylist(), np.int64), batch.column("tree")
            nodes, a = batch.column("node").to_pylist(), 0
            while a < len(parents):
                if trees[a].is_valid:
                    tree, a = pickle.loads(trees[a].as_py()), a + 1
                    continue
                b = a + 1
                while b < len(parents) and parents[b] == parents[a] and not trees[b].is_valid:
                    b += 1
                x, _ = unit(batch.column("embedding").slice(a, b - a))
                for k, rows in tree.place(x):
                    leaf_id = _leaf_id(int(parents[a]), round_, k)
                    out += [(nodes[a + r], leaf_id) for r in rows.tolist()]
                a = b
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], ["node", "leaf"])

    trees = cut(few.select("leaf", "n", "embedding").groupBy("leaf").applyInArrow(fit, "leaf long, tree binary"), "trees")
    # each tree goes once to every part of its leaf, ahead of that part's vectors
    heads = trees.join(sizes, "leaf").select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), deal - 1)).alias("part"), F.lit(None).cast("long").alias("node"), F.lit(None).cast(kind).alias("embedding"), "tree")
    rows = inside.select("leaf", F.pmod(F.xxhash64(F.lit("part"), "node"), deal).alias("part"), "node", "embedding", F.lit(None).cast("binary").alias("tree"))
    new = heads.unionByName(rows).repartition("leaf", "part").sortWithinPartitions("leaf", "part", F.col("tree").isNull(), "node").mapInArrow(place, "node long, leaf long")
    old = placed.select("node", F.explode("leaves").alias("leaf")).join(sizes.select("leaf"), "leaf", "left_anti").select("node", "leaf")
    leaves = old.unionByName(new).groupBy("node").agg(F.collect_set("leaf").alias("leaves"))  # leaves of one vector: a small multiple of the trees
    return placed.drop("leaves").join(leaves, "node").select("node", "copies", F.col("embedding").cast(kind), "leaves")


def classes(hit: np.ndarray) -> np.ndarray:
    """The smallest row that each row of a symmetric table of links is connected to."""
    root = np.full(len(hit), -1)
    for k in np.flatnonzero(hit.any(axis=1)):
        if root[k] >= 0:
            continue
        root[k], new = k, np.array([k])
        while len(new):
            new = np.flatnonzero(hit[new].any(axis=0) & (root < 0))
            root[new] = k
    return np.where(root < 0, np.arange(len(hit)), root)


def link_leaves(placed: DataFrame, cosine: float) -> DataFrame:
    """(node, root, links): by leaf, each linked vector with the smallest one it is connected to inside, and how many
    linked vectors, copies included, it has in pairs that no leaf of smaller id holds too.

    A row in a leaf carries the vector and the smaller ids among its leaves, nothing else.
    """

    def run(rows: pa.Table) -> pa.Table:
        x, good = unit(rows["embedding"].combine_chunks())
        order = np.argsort(rows["node"].to_numpy(), kind="stable")
        order = order[good[order]]
        x, nodes, copies = x[order], rows["node"].to_numpy()[order], rows["copies"].to_numpy()[order]
        hit = x @ x.T >= cosine
        np.fill_diagonal(hit, False)
        linked = np.flatnonzero(hit.any(axis=1))
        if not len(linked):
            return pa.table({"node": nodes[:0], "root": nodes[:0], "links": copies[:0]})
        nodes, copies, hit = nodes[linked], copies[linked], hit[np.ix_(linked, linked)]
        earlier = rows["earlier"].take(pa.array(order[linked])).combine_chunks()
        fresh = hit.copy()
        every, where = np.unique(earlier.flatten().to_numpy(), return_inverse=True)
        if len(every):
            own = np.repeat(np.arange(len(linked)), np.diff(earlier.offsets.to_numpy()))
            for a in range(0, len(every), 1024):  # memberships in earlier leaves, some leaves at a time
                inside = np.zeros((len(linked), min(1024, len(every) - a)), np.float32)
                mine = (where >= a) & (where < a + 1024)
                inside[own[mine], where[mine] - a] = 1
                fresh &= ~(inside @ inside.T > 0)
        return pa.table({"node": nodes, "root": nodes[classes(hit)], "links": fresh @ copies})

    rows = placed.select("node", "copies", "embedding", F.array_sort("leaves").alias("leaves")).select("node", "copies", "embedding", "leaves", F.posexplode("leaves").alias("at", "leaf"))
    rows = rows.select("leaf", "node", "copies", "embedding", F.slice("leaves", F.lit(1), F.col("at")).alias("earlier"))
    return rows.groupBy("leaf").applyInArrow(run, "node long, root long, links long")


def link_width(nodes: DataFrame, count: int, cosine: float, trees: int, leaf: int) -> DataFrame:
    """(node, root, links) of vectors (node, copies, embedding) of one length."""
    centres, rest = sampled_centres(nodes, count, cosine, leaf), nodes
    if len(centres):
        rest = cut(deal(nodes, centres, cosine).filter("ball < 0").select("node", "copies", "embedding"), "rest")
        count = rest.count()
    placed = cut(plant(rest, count, trees, leaf), "placed")
    for round_ in range(1, MOST_ROUNDS):
        while (more := crowded_centres(placed, leaf, cosine)) is not None and len(more):
            centres = np.concatenate([centres, more]) if len(centres) else more
            fewer = cut(deal(placed, more, cosine).filter("ball < 0").drop("ball", "halo"), "placed")
            remove(placed)
            placed = fewer
        smaller = split_large(placed, leaf, round_)
        if smaller is None:
            break
        smaller = cut(smaller, "placed")
        remove(placed)
        placed = smaller
    else:
        raise RuntimeError(f"leaves of more than {4 * leaf} vectors are left after {MOST_ROUNDS} rounds of splitting")
    found = cut(link_leaves(placed, cosine), "links")
    remove(placed)
    if len(centres):
        found = found.unionByName(cut(link_balls(cut(deal(nodes, centres, cosine), "dealt"), cosine), "links"))
    return found


def embedding_links(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept (vec_id = component_id), n_copies (rows with the same vector).

    Equal vectors are one point with its count, so a large group of copies costs one row in a leaf. Two points are
    compared if one lies in a dense place, or some leaf holds both; a pair held by several leaves is counted in the one
    of smallest id. Vectors of a length that fits into one leaf are compared all with all. Links have a cosine of at
    least `cosine` in double precision; a link whose points no tree puts together is missed (the tests and README say
    how many). Vectors that are null, zero or hold null or non-finite components, and those without a vec_id, link with
    nothing: n_links 0, component_id = vec_id, kept = true. Vectors of different lengths do not link. Rows that repeat a
    vec_id count as vectors of their own, whether their vectors are equal or not. Labels and other columns are ignored;
    an empty table gives an empty result.
    """
    made = cut(fingerprints(vectors), "vectors")
    usable = made.filter("vec_id is not null and digest is not null")
    points = usable.groupBy("digest").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("width").alias("width"), F.any_value("embedding").alias("embedding"))
    points = cut(points.withColumn("node", F.monotonically_increasing_id()), "points")  # fixed once written
    widths = points.groupBy("width").agg(F.count("*").alias("n"))
    large = {r.width: r.n for r in widths.filter(F.col("n") > 4 * leaf).collect()}  # lengths too common for one leaf
    columns = ["node", "copies", "embedding"]
    alone = points.filter(~F.col("width").isin(list(large))) if large else points
    found = cut(link_leaves(alone.select(*columns, F.array(F.col("width").cast("long")).alias("leaves")), cosine), "links")
    for width, n in sorted(large.items()):
        found = found.unionByName(link_width(points.filter(F.col("width") == width).select(*columns), n, cosine, trees, leaf))
    joined = cut(components(found.filter("node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst"))), "components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    points = points.select("digest", "first", "copies", "node").join(links, "node", "left").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    points = cut(points, "found")
    least = points.groupBy("component").agg(F.min("first").alias("component_id"))
    points = points.join(least, "component").select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", F.col("copies").alias("n_copies"))
    linked = usable.select("vec_id", "digest").join(points, "digest").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"), "n_copies")
    rest = made.filter("vec_id is null or digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"), F.lit(1).cast("long").alias("n_copies"))
    return linked.unionByName(rest)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))
