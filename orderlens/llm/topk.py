"""Exact top-k inner products by a pivot table.

Each vector's distances to the same few pivots are stored beside it. The triangle inequality turns
them into lower bounds of the distance between a query and a vector, the largest over all pivots,
and with the vectors' lengths into an upper bound of their inner product. Vectors are evaluated in
the order of that bound until the next bound is below the k-th score, when none of the rest can
enter. Rows and queries are cut into blocks that meet pairwise, each meeting gives the best k of its
rows, and the best k of those are the result. Every query first meets one bounded sample of the rows: no
block need look at a bound below the k-th score that it found there, and a block without any is skipped.
Pivots are taken from that sample, each as far as possible from those before it.

Components are whole numbers, floor(scale * x); scores are exact. Those beyond 64 bits are set to the
nearest long. Ties go to the smaller id. A row whose id or vector is null, or whose vector has a
component that is null or not finite, takes no part; vectors of other lengths than the query's are
no candidates. Rows with the query's id are its own. Repeated query rows give repeated results, and
repeated candidates count each. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.vectors import lists, matrices, usable
from orderlens.session import pin


@dataclass(frozen=True)
class TopKParams:
    k: int = 5
    scale: int = 256
    pivots: int = 32
    #: Rows and queries of one meeting, and queries and rows looked at together in it.
    rows: int = 4_096
    queries: int = 16_384
    together: int = 256
    step: int = 256
    #: Rows that pivots are chosen from and that give each query its first scores.
    sample: int = 4_096


LONG = (-(1 << 63), (1 << 63) - 1)


def pivot_table(numbers: DataFrame, pivots: list[list[float]]) -> DataFrame:
    """Adds each vector's distances to the pivots of its length, -1 where a pivot has another."""
    schema = T.StructType([*numbers.schema, T.StructField("distances", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            out = np.full((len(batch), len(pivots)), -1.0)
            for rows, matrix in matrices(batch.column("numbers")):
                for i, pivot in enumerate(pivots):
                    if len(pivot) == matrix.shape[1]:
                        away = matrix - np.array(pivot)
                        out[rows, i] = np.sqrt((away * away).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists(out, np.float64)], schema.names)

    return numbers.mapInArrow(run, schema)


def known_scores(asks: DataFrame, sample: list, k: int) -> DataFrame:
    """Adds the k-th best score of each query among the sampled rows: -inf where there are fewer."""
    shared = asks.sparkSession.sparkContext.broadcast([(r["vec_id"], r["numbers"]) for r in sample])
    schema = T.StructType([*asks.schema, T.StructField("known", T.DoubleType())])

    def run(batches):
        for batch in batches:
            out = np.full(len(batch), -np.inf)
            ids = batch.column("vec_id").to_numpy()
            for at, matrix in matrices(batch.column("numbers")):
                same = [(i, v) for i, v in shared.value if len(v) == matrix.shape[1]]
                if len(same) <= k or not matrix.shape[1]:
                    continue
                theirs, vectors = np.array([i for i, _ in same]), np.array([v for _, v in same])
                # Beyond 2**52 scores are not whole in doubles, so nothing is known beforehand.
                if np.abs(matrix).max() * np.abs(vectors).max() * matrix.shape[1] >= 2.0**52:
                    continue
                for start in range(0, len(at), 256):
                    rows = at[start: start + 256]
                    scores = matrix[start: start + 256] @ vectors.T
                    scores[ids[rows][:, None] == theirs[None, :]] = -np.inf
                    out[rows] = np.partition(scores, -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], schema.names)

    return asks.mapInArrow(run, schema)


def _exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in Python's whole numbers, for components too large for doubles."""
    left = np.array([[int(x) for x in q] for q in queries], object)
    right = np.array([[int(x) for x in r] for r in rows], object)
    return np.array([[min(max(int(v), LONG[0]), LONG[1]) for v in line] for line in left @ right.T], np.int64).reshape(
        len(queries), len(rows))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, ~scores))[:k]


def spread_pivots(sample: list[list[float]], count: int) -> list[list[float]]:
    """``count`` vectors of the sample over all lengths, each as far as possible from those chosen before it."""
    by_length: dict[int, list[list[float]]] = {}
    for vector in sample:
        by_length.setdefault(len(vector), []).append(vector)
    chosen = []
    for length, vectors in sorted(by_length.items()):
        matrix = np.array(vectors, np.float64).reshape(len(vectors), length)
        share = max(1, round(count * len(vectors) / len(sample)))
        far = np.full(len(matrix), np.inf)
        at = 0
        for _ in range(min(share, len(matrix))):
            chosen.append(matrix[at].tolist())
            far = np.minimum(far, np.sqrt(((matrix - matrix[at]) ** 2).sum(axis=1)))
            at = int(far.argmax())
            if far[at] == 0:
                break
    return chosen


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, params: TopKParams) -> pd.DataFrame:
    """The best k of ``rows`` for each of ``queries``; all vectors have one length."""
    q, c = (np.stack(f["numbers"].to_numpy()).astype(np.float64) for f in (queries, rows))
    q_far, c_far = (np.stack(f["distances"].to_numpy()).astype(np.float64) for f in (queries, rows))
    q_id, c_id = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
    known = queries["known"].to_numpy().astype(np.float64)
    largest = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(1, q.shape[1])
    whole = largest < 2.0**52
    q_len, c_len = (q * q).sum(axis=1), (c * c).sum(axis=1)
    found = []
    for at in range(0, len(q), params.together):
        part = slice(at, min(len(q), at + params.together))
        if not whole:
            scores = _exact_scores(q[part], c)
            for i in range(part.start, part.stop):
                others = np.flatnonzero(c_id != q_id[i])
                pick = others[_best(scores[i - at][others], c_id[others], params.k)]
                found.append((np.full(len(pick), i), c_id[pick], scores[i - at][pick]))
            continue
        near = np.zeros((part.stop - part.start, len(c)))
        for p in range(q_far.shape[1]):
            if q_far[part.start, p] >= 0:
                np.maximum(near, np.abs(q_far[part, p][:, None] - c_far[:, p][None, :]), out=near)
        limit = (q_len[part][:, None] + c_len[None, :] - near * near) / 2
        # Roundings of the distances are far below this.
        limit += 1e-9 * (q_len[part][:, None] + c_len[None, :]) + 0.5
        for i in range(part.start, part.stop):
            bound = limit[i - at]
            places = np.flatnonzero(bound >= known[i])
            places = places[np.argsort(-bound[places])]
            ids, scores = np.zeros(0, c_id.dtype), np.zeros(0, np.int64)
            for first in range(0, len(places), params.step):
                if len(ids) == params.k and bound[places[first]] < scores[-1]:
                    break
                some = places[first: first + params.step]
                some = some[c_id[some] != q_id[i]]
                ids = np.concatenate([ids, c_id[some]])
                scores = np.concatenate([scores, (c[some] @ q[i]).astype(np.int64)])
                best = _best(scores, ids, params.k)
                ids, scores = ids[best], scores[best]
            found.append((np.full(len(ids), i), ids, scores))
    which = np.concatenate([f[0] for f in found]).astype(np.int64)
    return pd.DataFrame({
        "row": queries["row"].to_numpy()[which], "query_id": q_id[which],
        "vec_id": np.concatenate([f[1] for f in found]), "score": np.concatenate([f[2] for f in found]).astype(np.int64)})


RESULT = "row bigint, query_id bigint, vec_id bigint, score bigint"


def top_k(table: DataFrame, is_query: Column, params: TopKParams = TopKParams(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for every row that ``is_query``."""
    numbers = table.filter(usable(table[vector]) & table[key].isNotNull()).select(
        table[key].cast("bigint").alias("vec_id"),
        F.transform(table[vector], lambda x: _floor(x, params.scale)).alias("numbers"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    stored = pin(numbers, "numbers")
    drawn = stored.orderBy(F.xxhash64("vec_id", "numbers")).limit(params.sample).select("vec_id", "numbers").collect()
    pivots = spread_pivots([r["numbers"] for r in drawn], params.pivots)
    counts = stored.agg(F.count("*").alias("rows"), F.count_if("asks").alias("asks")).first()
    row_blocks = max(1, -(-counts["rows"] // params.rows))
    query_blocks = max(1, -(-counts["asks"] // params.queries))

    known = pin(pivot_table(stored, pivots).withColumn("row", F.monotonically_increasing_id()), "pivots").withColumn(
        "length", F.size("numbers"))
    row_block = F.pmod(F.xxhash64("row"), F.lit(row_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int")
    columns = ["vec_id", "row", "numbers", "distances", "length"]
    rows = known.select(*columns, row_block.alias("row_block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"))
    asks = known_scores(known.filter("asks"), drawn, params.k).select(*columns, "known", query_block.alias("query_block"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("row_block"))
    keys = ["query_block", "row_block", "length"]

    def meet(queries, candidates):
        if not len(queries) or not len(candidates) or not len(queries["numbers"].iat[0]):
            return _no_score(queries, candidates, params.k)
        return search_block(queries, candidates, params)

    met = asks.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(meet, RESULT)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= params.k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _floor(x: Column, scale: int) -> Column:
    """floor(scale * x) as a double, also where it exceeds a long."""
    scaled = x.cast("double") * F.lit(float(scale))
    return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)


def _no_score(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Empty vectors score 0 with each other."""
    out = []
    for row, own in zip(queries.get("row", []), queries.get("vec_id", [])):
        ids = np.sort(rows["vec_id"].to_numpy()[rows["vec_id"].to_numpy() != own])[:k] if len(rows) else []
        out += [(row, own, i, 0) for i in ids]
    return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"]).astype("int64")
