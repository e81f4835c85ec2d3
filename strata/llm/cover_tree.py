"""Near-duplicate vectors by dual traversal of cover trees.

Vectors of one label are dealt into blocks of about ``BLOCK``: by the nearest
of fixed random directions, and by hash where many are near one. For each block
a cover tree is built: nested levels of centres with halving radii, every
centre below one that covers it. Two trees are traversed together. A pair of
nodes is dropped when their centres are further apart than both covering radii
and the threshold together, taken whole when all their vectors must be near
enough, and opened otherwise; pairs of vectors that remain are decided by their
cosine in double precision. Block pairs are dropped by the same bound before
anything is sent. So each link is found exactly once, and groups of near copies
count links by node sizes, without a row for each pair.

A label of n vectors costs (n / BLOCK) ** 2 pairs of blocks at most, each of
bounded size and a task's work; how many the bound drops depends on the data.

Defined cases: a vector that is null, empty, all zero or holds a null or a
component that is not finite links with nothing, and so does one without label
or id; vectors of different lengths do not link; rows that repeat an id are one
vector (the least, if they differ) and as many rows in the result; equal
vectors link; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import components, group_rows, map_rows, materialize

COSINE = 0.93
BLOCK = 2048
DIRECTIONS = 1024
#: Radii of the levels below the root, which covers everything.
RADII = [1.0 / 2**k for k in range(7)]
#: Taken off and added to bounds, against rounding.
SLACK = 1e-9


def chord(cosine: float) -> float:
    """Distance of unit vectors that have this cosine."""
    return float(np.sqrt(2 - 2 * cosine))


def distances(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (many @ one), 0))


def build(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, born, parent): vectors in the order in which they become
    centres, the level of each (``len(RADII) + 1``: none), and the place in
    ``order`` of the centre above it."""
    n = len(unit)
    order, born, parent = [0], np.full(n, len(RADII) + 1), np.zeros(n, np.int64)
    owner = np.zeros(n, np.int64)  # place in `order` of the nearest centre so far
    gap = distances(unit[0], unit)
    born[0] = 0
    for level, radius in enumerate(RADII, 1):
        above = owner.copy()  # each is within the last radius of this one
        while True:
            far = int(gap.argmax())
            if gap[far] <= radius:
                break
            born[far], parent[far] = level, above[far]
            near = distances(unit[far], unit)
            near[far] = 0
            closer = near < gap
            gap[closer], owner[closer] = near[closer], len(order)
            order.append(far)
    rest = np.flatnonzero(born > len(RADII))
    parent[rest] = owner[rest]
    order = np.concatenate([np.array(order, np.int64), rest])
    return order, born[order], parent[order]


@dataclass
class Tree:
    """Vectors in tree order; at level k the nodes are those born by then, and
    at the last level every vector is one."""

    ids: np.ndarray
    raw: np.ndarray
    born: np.ndarray
    parent: np.ndarray

    def __post_init__(self):
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.raw, self.raw))
        self.unit = self.raw / self.norm[:, None]
        self.levels = len(RADII) + 2
        self.nodes = [int((self.born <= k).sum()) for k in range(self.levels)]
        n = len(self.ids)
        self.above, self.radius, self.size = [], [], []
        at = np.arange(n)
        for level in range(self.levels - 1, -1, -1):
            if level < self.levels - 1:
                at = np.where(self.born[at] > level, self.parent[at], at)
            apart = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", self.unit, self.unit[at]), 0))
            apart[at == np.arange(n)] = 0
            radius = np.zeros(self.nodes[level])
            np.maximum.at(radius, at, apart)
            self.above.insert(0, at)
            self.radius.insert(0, radius)
            self.size.insert(0, np.bincount(at, minlength=self.nodes[level]))

    def children(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes of the next level by their node at this one, with the first
        and the number of each."""
        n = self.nodes[level + 1]
        up = np.where(self.born[:n] > level, self.parent[:n], np.arange(n))
        counts = np.bincount(up, minlength=self.nodes[level])
        return np.argsort(up, kind="stable"), np.cumsum(counts) - counts, counts


def _opened(a: np.ndarray, b: np.ndarray, one: tuple, two: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children of the pairs (a, b)."""
    counts = one[2][a] * two[2][b]
    pair = np.repeat(np.arange(len(a)), counts)
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts)
    wide = two[2][b][pair]
    return one[0][one[1][a][pair] + nth // wide], two[0][two[1][b][pair] + nth % wide]


def _apart(one: Tree, two: Tree, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    n, m = one.nodes[level], two.nodes[level]
    if 8 * len(a) > n * m:  # most pairs: one product of all
        dots = (one.unit[:n] @ two.unit[:m].T)[a, b]
    else:
        dots = np.concatenate(
            [np.einsum("ij,ij->i", one.unit[a[k : k + 65536]], two.unit[b[k : k + 65536]]) for k in range(0, len(a), 65536)]
            or [np.zeros(0)]
        )
    return np.sqrt(np.maximum(2 - 2 * dots, 0))


def traverse(one: Tree, two: Tree | None, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray, list]:
    """Links of each vector of both trees (``two`` null: within ``one``), and
    edges between places (of ``two`` after ``one``) that connect the same."""
    reach, same = chord(cosine), two is None
    two = one if same else two
    n = len(one.ids)
    links = [np.zeros(n, np.int64), np.zeros(len(two.ids), np.int64)]
    edges = []
    a = b = np.zeros(1, np.int64)
    for level in range(one.levels):
        if level:
            a, b = _opened(a, b, one.children(level - 1), two.children(level - 1))
        if not len(a):
            break
        last = level == one.levels - 1
        if last:
            cosines = np.concatenate(
                [
                    np.einsum("ij,ij->i", one.raw[a[k : k + 65536]], two.raw[b[k : k + 65536]])
                    / (one.norm[a[k : k + 65536]] * two.norm[b[k : k + 65536]])
                    for k in range(0, len(a), 65536)
                ]
            )
            whole = cosines >= cosine
        else:
            apart = _apart(one, two, a, b, level)
            bound = one.radius[level][a] + two.radius[level][b]
            near = apart <= bound + reach + SLACK
            whole = near & (apart + bound <= reach - SLACK)
        x, y = a[whole], b[whole]
        if len(x):
            gained = np.zeros(one.nodes[level], np.int64)
            np.add.at(gained, x, two.size[level][y] - (x == y if same else 0))
            links[0] += gained[one.above[level]]
            if not same:
                gained = np.zeros(two.nodes[level], np.int64)
                np.add.at(gained, y, one.size[level][x])
                links[1] += gained[two.above[level]]
            edges += [(x, y + (0 if same else n))]
            for tree, nodes, shift in ((one, x, 0), (two, y, 0 if same else n)):
                taken = np.zeros(tree.nodes[level], bool)
                taken[nodes] = True
                below = np.flatnonzero(taken[tree.above[level]])
                edges += [(tree.above[level][below] + shift, below + shift)]
        if not last:
            a, b = a[near & ~whole], b[near & ~whole]
    return links[0], links[1], edges


def _roots(n: int, edges: list) -> np.ndarray:
    """Smallest place connected to each."""
    root = np.arange(n)
    if not edges:
        return root
    a, b = (np.concatenate([e[k] for e in edges]) for k in range(2))
    while True:
        old = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == old).all():
            return root


def _vectors(embeddings: DataFrame) -> DataFrame:
    """Vectors that can link: (vec_id, label, dim, vec), an id once."""
    vec = F.col("embedding").cast("array<double>")
    good = F.coalesce(
        F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vec, lambda x: x != 0),
        F.lit(False),
    )
    return (
        embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), vec.alias("vec"))
        .where(good & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "vec")).alias("v"))
        .select("vec_id", "v.label", F.size("v.vec").alias("dim"), "v.vec")
    )


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def blocks(spark: SparkSession, embeddings: DataFrame, block: int) -> DataFrame:
    """Vectors in tree order within their blocks."""
    vectors = _vectors(embeddings)
    sizes = vectors.groupBy("label", "dim").agg(F.count("*").alias("n"))
    wide = F.least(F.ceil(F.col("n") / block), F.lit(DIRECTIONS)).cast("int").alias("wide")
    vectors = vectors.join(sizes.select("label", "dim", wide), ["label", "dim"])

    def cells(batch: pa.RecordBatch) -> dict:
        label, dim, vec_id, vec, wide = (batch.column(k) for k in range(5))
        out = np.zeros(batch.num_rows, np.int64)
        rows = [np.asarray(v, np.float64) for v in vec.to_pylist()]
        dims, counts = dim.to_numpy(), wide.to_numpy()
        for d, w in {*zip(dims.tolist(), counts.tolist(), strict=True)}:
            some = np.flatnonzero((dims == d) & (counts == w))
            if w > 1:
                ways = np.random.default_rng([2, d]).normal(size=(w, d))
                ways /= np.linalg.norm(ways, axis=1, keepdims=True)
                out[some] = (np.stack([rows[i] for i in some]) @ ways.T).argmax(axis=1)
        return {
            "label": label, "dim": dim, "cell": out, "vec_id": vec_id, "vec": [r.tobytes() for r in rows],
        }

    dealt = materialize(
        spark,
        map_rows(
            vectors.select("label", "dim", "vec_id", "vec", "wide"),
            cells,
            "label string, dim int, cell long, vec_id long, vec binary",
        ),
        "cover-vectors",
    )
    key = ["label", "dim", "cell"]
    split = dealt.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("long").alias("parts"))
    dealt = dealt.join(split, key).select(
        "label",
        "dim",
        (F.shiftleft("cell", 40) + F.pmod(F.xxhash64("vec_id"), "parts")).alias("block"),
        "vec_id",
        "vec",
    )
    key = ["label", "dim", "block"]

    def tree(key: tuple, rows: pa.Table) -> dict:
        raw = _matrix(rows["vec"], key[1])
        order, born, parent = build(raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None])
        n = len(order)
        return {
            "label": [key[0]] * n, "dim": [key[1]] * n, "block": [key[2]] * n, "seq": np.arange(n),
            "vec_id": rows["vec_id"].to_numpy()[order], "vec": [raw[i].tobytes() for i in order],
            "born": born, "parent": parent,
        }

    built = group_rows(
        dealt.repartition(*key).sortWithinPartitions(*key, "vec_id"),
        key,
        tree,
        "label string, dim int, block long, seq long, vec_id long, vec binary, born long, parent long",
    )
    return materialize(spark, built, "cover-trees")


def _near_blocks(trees: DataFrame, cosine: float) -> DataFrame:
    """Pairs (i <= j) of blocks whose covering radii leave room for a link."""
    key = ["label", "dim", "block"]

    def node(key: tuple, rows: pa.Table) -> dict:
        raw = _matrix(rows["vec"], key[1])
        unit = raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]
        centre = unit.mean(axis=0)
        length = np.linalg.norm(centre)
        centre = centre / length if length > 1e-9 else unit[0]
        return {
            "label": [key[0]], "dim": [key[1]], "block": [key[2]], "centre": [centre],
            "radius": [float(distances(centre, unit).max())],
        }

    nodes = group_rows(
        trees.select(*key, "vec").repartition(*key).sortWithinPartitions(*key),
        key,
        node,
        "label string, dim int, block long, centre array<double>, radius double",
    )
    nodes = materialize(trees.sparkSession, nodes, "cover-blocks")
    other = nodes.select(
        "label", "dim", F.col("block").alias("j"), F.col("centre").alias("centre_j"), F.col("radius").alias("radius_j")
    )
    dot = F.aggregate(
        F.zip_with("centre", "centre_j", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x
    )
    apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot))
    return (
        nodes.withColumnRenamed("block", "i")
        .join(other, ["label", "dim"])
        .where("i <= j")
        .where((F.col("i") == F.col("j")) | (apart <= F.col("radius") + F.col("radius_j") + chord(cosine) + SLACK))
        .select("label", "dim", "i", "j")
    )


def near_duplicates(
    spark: SparkSession, embeddings: DataFrame, *, cosine: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings``."""
    trees = blocks(spark, embeddings, block)
    pairs = materialize(spark, _near_blocks(trees, cosine), "cover-pairs")
    sent = pairs.select("label", "dim", "i", "j", F.col("i").alias("block")).union(
        pairs.where("i < j").select("label", "dim", "i", "j", F.col("j").alias("block"))
    )
    key = ["label", "dim", "i", "j"]
    sent = sent.join(trees, ["label", "dim", "block"]).select(*key, "block", "seq", "vec_id", "vec", "born", "parent")

    def found(key: tuple, rows: pa.Table) -> dict:
        block = rows["block"].to_numpy()
        seq, ids, born, parent = (rows[c].to_numpy() for c in ("seq", "vec_id", "born", "parent"))
        raw = _matrix(rows["vec"], key[1])
        trees = []
        for b in dict.fromkeys(key[2:]):
            at = np.flatnonzero(block == b)
            at = at[np.argsort(seq[at])]
            trees.append(Tree(ids[at], raw[at], born[at], parent[at]))
        one, two = trees[0], trees[1] if len(trees) > 1 else None
        links, others, edges = traverse(one, two, cosine)
        names, counts = one.ids, links
        if two is not None:
            names, counts = np.concatenate([one.ids, two.ids]), np.concatenate([links, others])
        root = names[_roots(len(names), edges)]
        some = np.flatnonzero((counts > 0) | (root != names))
        return {"a": names[some], "b": root[some], "n": counts[some]}

    linked = group_rows(
        sent.repartition(*key).sortWithinPartitions(*key), key, found, "a long, b long, n long"
    )
    linked = materialize(spark, linked, "cover-links")
    counts = linked.groupBy("a").agg(F.sum("n").alias("n_links")).withColumnRenamed("a", "vec_id")
    named = components(spark, linked.select("a", "b"), "cover-components").withColumnRenamed("v", "vec_id")
    return (
        embeddings.select(F.col("vec_id").cast("long"))
        .join(counts, "vec_id", "left")
        .join(named, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
