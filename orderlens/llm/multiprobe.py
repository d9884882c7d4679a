"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled by the longest one's length and get one component more, which brings them all to length 1; a
query gets 0 there, so that the largest inner product is the smallest distance. Each table hashes by several
Gaussian (2-stable) projections, cut into slots of one width at random offsets; equal slots are a bucket. Of each
table a query visits its own bucket and those in which some slots are moved by one, in the order of their
estimated success: the sum of the squared distances to the edges that are crossed. What the tables' buckets hold
is scored exactly; a query's best of all buckets are merged.

How many buckets are visited is fitted: a bounded sample of queries (``sample``) is searched exactly, over all
rows, and the least number is taken at which the tables together hold ``recall`` of the sample's neighbours. Where
no number up to ``most_probes`` does, slots are widened and the fit is repeated. Every row is indexed. Queries
that found less than they could are searched exactly against all rows, in blocks.

Rows with equal vectors are one entry of a bucket, with the smallest k + 1 of their ids: more can't be among the k
best of any query, as ties go to the smaller id. Buckets, and the queries that visit one, are cut into blocks
that meet pairwise; a meeting returns only each query's best k.

Defined results: rows whose id or vector is null, whose vector is empty or zero or holds null or non-finite
components take no part; vectors of other lengths than the query's are no candidates. Repeated rows of one id and
vector count once, as queries and as candidates; different vectors of one id count each, but none is a candidate of
a query with that id. Extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import mix, share_hash
from orderlens.llm.vectors import lists, matrices, usable
from orderlens.session import pin


@dataclass(frozen=True)
class ProbeParams:
    k: int = 20
    tables: int = 4
    #: Projections of a table: enough for buckets of this many rows, if each halves them; never fewer than ``least``.
    bucket: int = 256
    least: int = 8
    #: Slot width, in standard deviations of a projection of a unit vector's.
    width: float = 3.0
    recall: float = 0.95
    sample: int = 256
    most_probes: int = 512
    #: Rows and queries of one meeting, and rows of the buckets that share a task.
    block: int = 4_096
    queries: int = 4_096
    seed: int = 3


@lru_cache(maxsize=8)
def probe_sets(hashes: int, most: int) -> np.ndarray:
    """Sets of moved slots in the order of their expected scores, as 0/1 over the 2 * hashes edges by distance.

    Place j stands for the (j+1)-nearest edge; edges j and 2 * hashes - 1 - j belong to one projection and exclude
    each other. The first set is empty: the query's own bucket.
    """
    m = hashes
    place = np.arange(1, m + 1)
    near = place * (place + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - place[::-1] / (m + 1) + place[::-1] * (place[::-1] + 1) / (4 * (m + 1) * (m + 2))
    cost = np.concatenate([near, far]).tolist()
    found, heap = [()], [(cost[0], (0,))]
    while heap and len(found) < most:
        score, chosen = heapq.heappop(heap)
        if not any(2 * m - 1 - j in chosen for j in chosen):
            found.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score + cost[last + 1], (*chosen, last + 1)))
            heapq.heappush(heap, (score + cost[last + 1] - cost[last], (*chosen[:-1], last + 1)))
    sets = np.zeros((len(found), 2 * m))
    for i, chosen in enumerate(found):
        sets[i, list(chosen)] = 1
    return sets


@dataclass(frozen=True)
class Hashing:
    """The tables of one length: projections of (components and one more), offsets, slot width, longest vector."""

    projections: np.ndarray
    offsets: np.ndarray
    width: float
    longest: float

    @staticmethod
    def make(dims: int, hashes: int, longest: float, width: float, params: ProbeParams) -> Hashing:
        random = np.random.default_rng([params.seed, dims])
        projections = random.standard_normal((params.tables, dims + 1, hashes))
        return Hashing(projections, random.random((params.tables, hashes)), width, longest or 1.0)

    def _places(self, table: int, unit: np.ndarray) -> np.ndarray:
        return unit @ self.projections[table] / self.width + self.offsets[table]

    def of_rows(self, vectors: np.ndarray) -> np.ndarray:
        """Slots by row, table and projection."""
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))
        unit = np.column_stack([scaled, rest])
        return np.stack([np.floor(self._places(t, unit)) for t in range(len(self.offsets))], axis=1).astype(np.int64)

    def of_queries(self, vectors: np.ndarray, probes: int, most: int) -> np.ndarray:
        """Slots by query, table, probe in order of estimated success, and projection."""
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit = np.column_stack([scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)), np.zeros(len(vectors))])
        hashes = self.offsets.shape[1]
        sets = probe_sets(hashes, most)
        out = np.empty((len(vectors), len(self.offsets), min(probes, len(sets)), hashes), np.int64)
        for t in range(len(self.offsets)):
            places = self._places(t, unit)
            own = np.floor(places)
            # Distances to the lower edges, then to the upper ones.
            edges = np.concatenate([places - own, own + 1 - places], axis=1)
            order = np.argsort(edges, axis=1, kind="stable")
            scores = np.take_along_axis(edges, order, 1) ** 2 @ sets.T
            chosen = np.argsort(scores, axis=1, kind="stable")[:, : out.shape[2]]
            moved = np.zeros((len(vectors), out.shape[2], 2 * hashes))
            np.put_along_axis(moved, order[:, None, :].repeat(out.shape[2], 1), sets[chosen], 2)
            out[:, t] = own[:, None, :] + moved[:, :, hashes:] - moved[:, :, :hashes]
        return out


def bucket_ids(slots: np.ndarray) -> np.ndarray:
    """64-bit numbers of buckets; the last axis holds the slots. Buckets that fall together only hold more."""
    total = np.zeros(slots.shape[:-1], np.uint64)
    for i in range(slots.shape[-1]):
        total = mix(total ^ (slots[..., i].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 + i)))
    return total.view(np.int64)


def scores_of(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products whose rounding does not depend on where a row lies."""
    return (rows * query).sum(axis=1)


def only_id(ids: list) -> tuple[np.ndarray, np.ndarray]:
    """The first id of each entry, and whether it has no other."""
    return np.array([i[0] for i in ids], np.int64), np.array([len(i) == 1 for i in ids], bool)


def best_of(query: np.ndarray, own: int, rough: np.ndarray, rows: np.ndarray, ids: list[np.ndarray], k: int) -> list[tuple[float, int]]:
    """(-score, id) of the k best; ``rough`` are the scores but for rounding, -inf where a row is none of them."""
    some = np.flatnonzero(rough > -np.inf)
    if len(some) > k:
        least = np.partition(rough[some], -k)[-k]
        size = float(np.abs(query).max(initial=0) * np.abs(rows).max(initial=0)) * rows.shape[1]
        some = some[rough[some] >= least - 1e-13 * size]
    scores = scores_of(query, rows[some])
    order = np.lexsort(([int(ids[i][int(ids[i][0] == own)]) for i in some], -scores))[:k]
    pairs = [(-float(scores[j]), int(i)) for j in order for i in ids[some[j]] if i != own]
    return sorted(pairs)[:k]


FOUND = "asked bigint, best array<struct<away double, id bigint>>"


def as_found(best: dict[int, list[tuple[float, int]]]) -> pd.DataFrame:
    listed = [[{"away": away, "id": i} for away, i in pairs] for pairs in best.values()]
    return pd.DataFrame({"asked": pd.Series(list(best), dtype="int64"), "best": pd.Series(listed, dtype=object)})


def search(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k best rows of the buckets that it visits here: ``asked`` and (-score, id) in order."""
    if not len(queries) or not len(rows):
        return as_found({})
    rows, queries = rows.sort_values("bucket", kind="stable"), queries.sort_values("bucket", kind="stable")
    held, visits = rows["bucket"].to_numpy(), queries["bucket"].to_numpy()
    vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    asks = np.stack(queries["vector"].to_numpy()).astype(np.float64)
    ids = rows["ids"].to_numpy()
    single, alone = only_id(ids)
    own, asked = queries["own"].to_numpy(), queries["asked"].to_numpy()
    found: dict[int, list[tuple[float, int]]] = {}
    for bucket in np.unique(visits):
        here = slice(*(int(np.searchsorted(held, bucket, side)) for side in ("left", "right")))
        if here.start == here.stop:
            continue
        begin, end = (int(np.searchsorted(visits, bucket, side)) for side in ("left", "right"))
        for at in range(begin, end, 512):
            some = slice(at, min(at + 512, end))
            rough = asks[some] @ vectors[here].T
            rough[(own[some][:, None] == single[here][None, :]) & alone[here][None, :]] = -np.inf
            for i in range(some.start, some.stop):
                best = best_of(asks[i], own[i], rough[i - at], vectors[here], ids[here], k)
                old = found.get(asked[i])
                found[asked[i]] = best if old is None else sorted({*old, *best})[:k]
    return as_found(found)


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all its meetings."""
    every = found.groupBy("asked").agg(F.sort_array(F.flatten(F.collect_list("best"))).alias("every"))
    # Tables share candidates, whose scores are equal to the last bit and lie side by side.
    once = F.filter("every", lambda one, i: (i == 0) | (one != F.element_at("every", F.greatest(i, F.lit(1)))))
    return every.select("asked", F.slice(once, 1, k).alias("best"))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """A row per different vector: ``dims``, ``vector`` and the smallest k + 1 of its ids."""
    marks = [F.xxhash64("vector").alias("mark1"), F.xxhash64("vector", F.lit(1)).alias("mark2")]
    place = Window.partitionBy("mark1", "mark2").orderBy("vec_id")
    # Spark cuts each task's rows to the first k + 1 before it shuffles them.
    few = rows.select("vec_id", "vector", *marks).withColumn("place", F.dense_rank().over(place)).filter(F.col("place") <= k + 1)
    return few.groupBy("mark1", "mark2").agg(
        F.sort_array(F.collect_set("vec_id")).alias("ids"), F.first("vector").alias("vector"),
    ).select("ids", "vector", F.size("vector").alias("dims"))


def _blocks(counts: DataFrame, name: str, size: int) -> DataFrame:
    """``name``: how many blocks of ``size`` a bucket's rows make, where more than one."""
    return counts.filter(F.col("n") > size).select(
        F.col("dims").alias(f"{name}_dims"), F.col("at").alias(f"{name}_at"), F.col("bucket").alias(f"{name}_bucket"),
        F.ceil(F.col("n") / size).cast("int").alias(name))


def _cut(frame: DataFrame, known: dict[str, DataFrame]) -> DataFrame:
    for name, blocks in known.items():
        frame = frame.join(
            blocks, (frame["dims"] == blocks[f"{name}_dims"]) & (frame["at"] == blocks[f"{name}_at"])
            & (frame["bucket"] == blocks[f"{name}_bucket"]), "left").withColumn(name, F.coalesce(name, F.lit(1)))
        frame = frame.drop(f"{name}_dims", f"{name}_at", f"{name}_bucket")
    return frame


def meet(rows: DataFrame, queries: DataFrame, cells: int, params: ProbeParams) -> DataFrame:
    """Best k of the rows that share a table (``at``) and ``bucket`` with a query; large buckets are cut.

    rows: dims, at, bucket, ids, vector; queries: dims, at, bucket, asked, own, vector.
    """
    each = ["dims", "at", "bucket"]
    # Stored, so that their size decides whether the vectors have to be shuffled for them.
    known = {
        "row_blocks": pin(_blocks(rows.groupBy(*each).agg(F.count("*").alias("n")), "row_blocks", params.block), "row-blocks"),
        "query_blocks": pin(
            _blocks(queries.groupBy(*each).agg(F.count("*").alias("n")), "query_blocks", params.queries), "query-blocks")}

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    cell = F.pmod("bucket", F.lit(cells)).alias("cell")
    # Blocks of cut buckets are tasks of their own, the others of a cell share one.
    held = _cut(rows, known).select(
        "dims", "at", cell, "bucket", "ids", "vector", "query_blocks",
        F.pmod(F.xxhash64("ids", "vector"), F.col("row_blocks")).cast("int").alias("row_block")).select(
        "*", every("query_blocks").alias("query_block"))
    visits = _cut(queries, known).select(
        "dims", "at", cell, "bucket", "asked", "own", "vector", "row_blocks",
        F.pmod(F.xxhash64("asked"), F.col("query_blocks")).cast("int").alias("query_block")).select(
        "*", every("row_blocks").alias("row_block"))
    keys = ["dims", "at", "cell", "row_block", "query_block"]
    k = params.k

    def run(left, right):
        return search(left, right, k)

    left = visits.select(*keys, "bucket", "asked", "own", "vector")
    right = held.select(*keys, "bucket", "ids", "vector")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, FOUND)


def exact_neighbours(rows: DataFrame, sample: list[tuple[int, np.ndarray]], k: int) -> dict[int, list[np.ndarray]]:
    """The vectors of the k nearest rows of each sampled (own id, vector), by place in the sample."""
    shared = rows.sparkSession.sparkContext.broadcast(sample)

    def run(batches):
        best: list[list[tuple[float, int, list[float]]]] = [[] for _ in shared.value]
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            single, alone = only_id(ids)
            for at, matrix in matrices(batch.column("vector")):
                same = [(p, own, q) for p, (own, q) in enumerate(shared.value) if len(q) == matrix.shape[1]]
                for start in range(0, len(same), 64):
                    part = same[start: start + 64]
                    scores = np.array([q for _, _, q in part]) @ matrix.T
                    for line, (place, own, _) in zip(scores, part):
                        line[(single[at] == own) & alone[at]] = -np.inf
                        some = np.argpartition(-line, k - 1)[:k] if len(line) > k else np.arange(len(line))
                        met = [(-line[j], ids[at[j]][0], matrix[j].tolist()) for j in some if line[j] > -np.inf]
                        best[place] = heapq.nsmallest(k, best[place] + met)
        rows_ = [(place, -away, i, v) for place, found in enumerate(best) for away, i, v in found]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows_], pa.int32()), pa.array([r[1] for r in rows_], pa.float64()),
            pa.array([r[2] for r in rows_], pa.int64()), pa.array([r[3] for r in rows_], pa.list_(pa.float64()))],
            ["place", "score", "id", "vector"])

    scored = rows.select("ids", "vector").mapInArrow(run, "place int, score double, id bigint, vector array<double>")
    order = Window.partitionBy("place").orderBy(F.desc("score"), "id")
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found: dict[int, list[np.ndarray]] = {p: [] for p in range(len(sample))}
    for r in best.select("place", "vector").collect():
        found[r["place"]].append(np.array(r["vector"]))
    return found


@dataclass(frozen=True)
class Index:
    """Tables by vector length, probes to visit in each, and the recall that they had on the sample."""

    hashing: dict[int, Hashing]
    probes: int
    recall: float


def _places_of_neighbours(
    hashing: dict[int, Hashing], sample: list[tuple[int, np.ndarray]], near: dict[int, list[np.ndarray]], params: ProbeParams,
) -> np.ndarray:
    """For every sampled neighbour the first probe, in any table, that meets it; most_probes where none does."""
    places = []
    for place, (_, query) in enumerate(sample):
        if near[place]:
            known = hashing[len(query)]
            visited = bucket_ids(known.of_queries(query[None, :], params.most_probes, params.most_probes))[0]
            held = bucket_ids(known.of_rows(np.array(near[place])))
            met = visited[None, :, :] == held[:, :, None]
            first = np.where(met.any(axis=2), met.argmax(axis=2), params.most_probes)
            places += first.min(axis=1).tolist()
    return np.array(places, np.int64)


def fit(rows: DataFrame, queries: DataFrame, params: ProbeParams) -> Index:
    """Index for ``rows`` (entries) and ``queries`` (own, vector)."""
    longest = {
        r["dims"]: (r["longest"], r["n"]) for r in rows.groupBy("dims").agg(
            F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).alias("longest"),
            F.count("*").alias("n")).collect()}
    share = params.sample / max(1, queries.count())
    drawn = queries.filter(share_hash("own", "vector") <= min(1.0, share)).select("own", "vector").orderBy("own", "vector").collect()
    sample = [(r["own"], np.array(r["vector"], np.float64)) for r in drawn]
    near = exact_neighbours(rows, sample, params.k)
    width = params.width
    while True:
        hashing = {
            dims: Hashing.make(dims, max(params.least, int(np.ceil(np.log2(n / params.bucket)))), size, width, params)
            for dims, (size, n) in longest.items()}
        places = _places_of_neighbours(hashing, sample, near, params)
        if not len(places):
            return Index(hashing, 1, 1.0)
        wanted = int(np.sort(places)[min(len(places) - 1, int(np.ceil(params.recall * len(places))) - 1)])
        if wanted < params.most_probes:
            return Index(hashing, wanted + 1, float((places <= wanted).mean()))
        width *= 1.5


def _hashed(frame: DataFrame, index: Index, column: str, probes: int = 0, most: int = 0) -> DataFrame:
    """``frame`` with the buckets of its vectors: one a table, or ``probes`` a table one after another."""
    shared = frame.sparkSession.sparkContext.broadcast(index.hashing)
    names = [*frame.columns, column]

    def run(batches):
        for batch in batches:
            buckets: list = [None] * len(batch)
            for rows, matrix in matrices(batch.column("vector")):
                known = shared.value[matrix.shape[1]]
                for at in range(0, len(rows), 1_024):
                    part = matrix[at: at + 1_024]
                    slots = known.of_queries(part, probes, most) if probes else known.of_rows(part)
                    for row, own in zip(rows[at: at + 1_024], bucket_ids(slots).reshape(len(part), -1)):
                        buckets[row] = own
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(buckets, pa.list_(pa.int64()))], names)

    return frame.mapInArrow(run, T.StructType([*frame.schema, T.StructField(column, T.ArrayType(T.LongType()))]))


def nearest(
    table: DataFrame, is_query: Column, params: ProbeParams = ProbeParams(), key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for every row that ``is_query``."""
    stored = table.select(
        table[key].cast("bigint").alias("vec_id"), table[vector].alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    part = usable(F.col("vector")) & F.col("vec_id").isNotNull() & F.exists("vector", lambda x: x != 0)
    numbers = stored.filter(F.coalesce(part, F.lit(False)))
    rows = pin(entries(numbers, params.k), "entries")
    marks = [F.xxhash64("vector").alias("m1"), F.xxhash64("vector", F.lit(1)).alias("m2")]
    once = numbers.filter("asks").select(F.col("vec_id").alias("own"), "vector", *marks).groupBy("own", "m1", "m2").agg(
        F.first("vector").alias("vector"))
    queries = pin(once.select(
        F.monotonically_increasing_id().alias("asked"), "own", "vector", F.size("vector").alias("dims")), "queries")
    index = fit(rows, queries, params)
    held = pin(_hashed(rows, index, "buckets"), "index")
    visits = pin(_hashed(queries, index, "visits", index.probes, params.most_probes), "visits")
    count = rows.count()
    # A probe's place over the number of probes is its table's; all lengths visit the same number.
    tables = params.tables
    spread = visits.select("asked", "own", "vector", "dims", F.size("visits").alias("all"), F.posexplode("visits").alias("p", "bucket")).select(
        "dims", F.floor(F.col("p") * tables / F.col("all")).cast("int").alias("at"), "bucket", "asked", "own", "vector")
    cells = max(1, -(-count // (params.block // 2)))
    found = meet(held.select("dims", F.posexplode("buckets").alias("at", "bucket"), "ids", "vector"), spread, cells, params)
    first = pin(merged(found, params.k), "found")
    best = pin(_completed(first, rows, queries, count, params), "nearest")
    ranked = best.join(queries.select(F.col("asked").alias("asker"), "own"), F.col("asked") == F.col("asker")).select(
        F.col("own").alias("query_id"), F.posexplode("best").alias("place", "one"))
    return ranked.select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.id").alias("vec_id"),
        (-F.col("one.away")).alias("score"))


def _completed(found: DataFrame, rows: DataFrame, queries: DataFrame, count: int, params: ProbeParams) -> DataFrame:
    """``found`` with the queries that have fewer than k searched exactly, as far as there are more rows."""
    full = found.filter(F.size("best") >= params.k)
    short = pin(queries.join(full.select(F.col("asked").alias("done")), F.col("asked") == F.col("done"), "left_anti"), "short")
    if short.isEmpty():
        return found
    one = [F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("bucket")]
    exact = meet(rows.select("dims", *one, "ids", "vector"), short.select("dims", *one, "asked", "own", "vector"), 1, params)
    return full.unionByName(merged(exact, params.k))
