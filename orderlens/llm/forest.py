"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Vectors are compared only within a label and length. Equal vectors are reduced to one with a count.
Each tree splits such a set again and again at a random direction; a vector within the spill margin
of the split goes both ways, so a close pair is parted only if it lies wide across it, and many trees
make up for that. All pairs within a leaf are compared by cosine in doubles; a pair that meets in
several leaves counts in the first one they share. A leaf too large for one task is cut into blocks,
every two of which meet in a task.

The trees are fitted on a bounded sample (``sample`` vectors over all labels); every vector is indexed. A label
that is no larger than a leaf, or of which fewer than two vectors are drawn, has no tree: all of it is one leaf,
cut into blocks by its counted size. So the trees are bounded by the sample, however many labels there are. Of a
leaf's links only each vector's number of them and a spanning forest leave the task.

Defined results: a row whose label, id or vector is null, whose vector is zero or has a component
that is null or not finite, links with nothing (its component is its own id). Repeated rows are equal
vectors, linked with each other. Different vectors under one id are one node, whose links add up.
Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import share_hash
from orderlens.llm.components import components
from orderlens.llm.simhash import join_roots
from orderlens.llm.vectors import lists, matrices, usable
from orderlens.session import pin


@dataclass(frozen=True)
class ForestParams:
    similarity: float = 0.98
    trees: int = 5
    leaf: int = 256
    #: Half width of the overlap, in standard deviations of the widest allowed pair's projections.
    spill: float = 0.6
    sample: int = 16_384
    #: Vectors of a leaf that one task compares with as many others.
    block: int = 2_048
    deepest: int = 40
    seed: int = 7


@dataclass
class Node:
    direction: np.ndarray | None = None
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None
    leaf: int = -1
    blocks: int = 1


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def margin(dims: int, params: ForestParams) -> float:
    chord = np.sqrt(2 - 2 * params.similarity)
    return params.spill * chord / np.sqrt(dims)


class Forest:
    """Trees per (label, length); leaves are numbered from 1 over all of them, 0 is a whole label."""

    def __init__(self, params: ForestParams):
        self.params, self.trees, self.leaves = params, {}, 1

    def fit(self, key: tuple[int, int], sample: np.ndarray, total: int) -> None:
        random = np.random.default_rng([self.params.seed, key[0] % 2**32, key[1]])
        weight = total / len(sample)
        self.trees[key] = [self._grow(sample, weight, random, 0) for _ in range(self.params.trees)]

    def _grow(self, sample: np.ndarray, weight: float, random, depth: int) -> Node:
        p = self.params
        expected = len(sample) * weight
        if expected > p.leaf and depth < p.deepest and len(sample) >= 2:
            direction = random.standard_normal(sample.shape[1])
            direction /= np.linalg.norm(direction)
            places = sample @ direction
            wide = margin(sample.shape[1], p)
            # Of the cuts near the middle, the one with the least overlap.
            cuts = np.quantile(places, np.linspace(0.3, 0.7, 17))
            both = [np.count_nonzero(np.abs(places - c) <= wide) for c in cuts]
            cut = float(cuts[int(np.argmin(both))])
            left, right = places <= cut + wide, places >= cut - wide
            if max(left.sum(), right.sum()) < 0.9 * len(sample):
                return Node(direction, cut, self._grow(sample[left], weight, random, depth + 1),
                            self._grow(sample[right], weight, random, depth + 1))
        self.leaves += 1
        return Node(leaf=self.leaves - 1, blocks=max(1, int(np.ceil(1.2 * expected / p.block))))

    def leaves_of(self, key: tuple[int, int], vectors: np.ndarray, size: int) -> list[tuple[Node, np.ndarray]]:
        """Each leaf that some vector goes to, with the rows of those vectors; the label has ``size`` vectors."""
        if key not in self.trees:
            return [(Node(leaf=0, blocks=-(-size // self.params.block)), np.arange(len(vectors)))]
        found = []
        wide = margin(vectors.shape[1], self.params)
        todo = [(tree, np.arange(len(vectors))) for tree in self.trees[key]]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node.direction is None:
                found.append((node, rows))
                continue
            places = vectors[rows] @ node.direction
            todo.append((node.left, rows[places <= node.cut + wide]))
            todo.append((node.right, rows[places >= node.cut - wide]))
        return found


def with_sizes(vectors: DataFrame) -> DataFrame:
    """``vectors`` with ``dims`` and ``size``, the number of vectors of their label and length."""
    measured = vectors.withColumn("dims", F.size("vector"))
    sizes = pin(measured.groupBy("label", "dims").agg(F.count("*").alias("size")), "label-sizes")
    return measured.join(sizes, ["label", "dims"])


def grow_forest(vectors: DataFrame, params: ForestParams) -> Forest:
    """Forest over ``vectors`` (rep, label, vector, size), fitted on a sample drawn by a hash of the id."""
    total = vectors.count()
    drawn = vectors.filter(share_hash("rep") <= min(1.0, params.sample / max(1, total))).filter(
        F.col("size") > params.leaf).orderBy("rep")
    forest = Forest(params)
    rows: dict[tuple[int, int], list] = {}
    sizes = {}
    for r in drawn.select("label", "size", "vector").collect():
        rows.setdefault((r["label"], len(r["vector"])), []).append(r["vector"])
        sizes[r["label"], len(r["vector"])] = r["size"]
    for key, sample in sorted(rows.items()):
        if len(sample) >= 2:
            forest.fit(key, unit(np.array(sample, np.float64)), sizes[key])
    return forest


def _spread(vectors: DataFrame, forest: Forest) -> DataFrame:
    """A row per task in which a vector is compared: leaf, the two blocks that meet there, its own block."""
    shared = vectors.sparkSession.sparkContext.broadcast(forest)
    names = ["label", "dims", "leaf", "first", "second", "block", "rep", "copies", "vector", "leaves"]

    def run(batches):
        grown = shared.value
        for batch in batches:
            labels = batch.column("label").to_numpy()
            reps, copies, sizes = (batch.column(c).to_numpy() for c in ("rep", "copies", "size"))
            for at, matrix in matrices(batch.column("vector")):
                for label in np.unique(labels[at]):
                    own = labels[at] == label
                    rows, vectors_ = at[own], unit(matrix[own])
                    met = grown.leaves_of((int(label), matrix.shape[1]), vectors_, int(sizes[rows[0]]))
                    pairs = np.concatenate([np.column_stack([r, np.full(len(r), n.leaf)]) for n, r in met])
                    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
                    starts = np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1))
                    for node, members in met:
                        block = (reps[rows[members]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(node.blocks)
                        block = block.astype(np.int32)
                        counts = starts[members + 1] - starts[members]
                        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                        inner = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts) + np.repeat(starts[members], counts)
                        leaves = pa.ListArray.from_arrays(pa.array(offsets), pa.array(pairs[inner, 1].astype(np.int32)))
                        for other in range(node.blocks):
                            n = len(members)
                            yield pa.RecordBatch.from_arrays([
                                pa.array(np.full(n, label, np.int64)), pa.array(np.full(n, matrix.shape[1], np.int32)),
                                pa.array(np.full(n, node.leaf, np.int32)),
                                pa.array(np.minimum(block, other).astype(np.int32)),
                                pa.array(np.maximum(block, other).astype(np.int32)),
                                pa.array(block), pa.array(reps[rows[members]]), pa.array(copies[rows[members]]),
                                lists(matrix[own][members], np.float64), leaves], names)

    return vectors.select("rep", "copies", "label", "size", "vector").mapInArrow(
        run, "label bigint, dims int, leaf int, first int, second int, block int, rep bigint, copies bigint, vector array<double>, leaves array<int>")


def _first_shared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest common leaf of each pair; rows hold leaves in order, filled up with -1."""
    same = (left[:, :, None] == right[:, None, :]) & (left[:, :, None] >= 0)
    return left[np.arange(len(left)), same.any(axis=2).argmax(axis=1)]


def compare_leaf(leaf: int, part: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links within one block of a leaf, or between two: per vector their number and a root."""
    part = part.sort_values("rep", kind="stable").reset_index(drop=True)
    vectors = unit(np.stack(part["vector"].to_numpy()).astype(np.float64))
    reps, copies, block = (part[c].to_numpy() for c in ("rep", "copies", "block"))
    widest = part["leaves"].map(len).max()
    leaves = np.full((len(part), widest), -1, np.int64)
    for i, own in enumerate(part["leaves"]):
        leaves[i, : len(own)] = own
    across = part["first"].iat[0] != part["second"].iat[0]
    links = np.zeros(len(part), np.int64)
    parent = np.arange(len(part))
    for at in range(0, len(part), 512):
        close = vectors[at: at + 512] @ vectors.T >= similarity
        a, b = np.nonzero(close)
        a = a + at
        chosen = (a < b) & (reps[a] != reps[b])
        if across:
            chosen &= block[a] != block[b]
        a, b = a[chosen], b[chosen]
        for k in range(0, len(a), 1 << 16):
            x, y = a[k: k + (1 << 16)], b[k: k + (1 << 16)]
            counts = _first_shared(leaves[x], leaves[y]) == leaf
            np.add.at(links, x[counts], copies[y[counts]])
            np.add.at(links, y[counts], copies[x[counts]])
        parent = join_roots(parent, a, b)
    out = pd.DataFrame({"rep": reps, "links": links, "root": reps[parent]})
    return out[(links > 0) | (out["rep"] != out["root"])]


def near_duplicates(
    table: DataFrame, params: ForestParams = ForestParams(), key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = table.select(
        table[key].alias("vec_id"), table[label].cast("bigint").alias("label"), table[vector].cast("array<double>").alias("vector"))
    takes_part = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.exists(
        "vector", lambda x: x != 0)
    # 128 bits tell different vectors apart.
    marks = [F.xxhash64("label", "vector").alias("mark1"), F.xxhash64("vector", F.lit(1), "label").alias("mark2")]
    marked = rows.filter(F.coalesce(takes_part, F.lit(False))).select("vec_id", "label", "vector", *marks)
    distinct = pin(
        marked.groupBy("label", "mark1", "mark2").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")),
        "vectors")
    sized = with_sizes(distinct)
    forest = grow_forest(sized, params)

    def compare(key_, part):
        return compare_leaf(int(key_[2]), part, params.similarity)

    found = pin(
        _spread(sized, forest).groupBy("label", "dims", "leaf", "first", "second").applyInPandas(
            compare, "rep bigint, links bigint, root bigint"),
        "leaf-links")
    counts = found.groupBy(F.col("rep").alias("counted")).agg(F.sum("links").alias("links"))
    joined = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    own = distinct.groupBy(F.col("rep").alias("own")).agg(F.sum(F.col("copies") - 1).alias("equal"))
    nodes = pin(
        own.join(counts, F.col("own") == F.col("counted"), "left").join(joined, F.col("own") == F.col("node"), "left")
        .select("own", (F.col("equal") + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "own").alias("component")),
        "nodes")
    reps = distinct.select(
        F.col("mark1").alias("m1"), F.col("mark2").alias("m2"), F.col("label").alias("l"), F.col("rep"))
    keyed = rows.withColumn("part", F.coalesce(takes_part, F.lit(False))).select(
        "vec_id", "label", *[F.when(F.col("part"), m).alias(n) for m, n in zip(marks, ("mark1", "mark2"))])
    known = keyed.join(
        reps, (F.col("mark1") == F.col("m1")) & (F.col("mark2") == F.col("m2")) & (F.col("label") == F.col("l")), "left")
    return known.join(nodes, F.col("rep") == F.col("own"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
