"""Multiprobe hashing against brute force."""

import itertools

import numpy as np
import pytest
from conftest import CHECK
from pyspark.sql import functions as F

from orderlens.llm import multiprobe, queries
from orderlens.llm.multiprobe import Hashing, ProbeParams, bucket_ids, probe_sets

from .test_tables import odd_vectors, vectors


def brute(rows, k, every=20):
    """{query id: [(vec_id, score)]} over rows (id, vector), each different one once."""
    good = sorted({(i, tuple(map(float, v))) for i, v, *_ in rows
                   if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    found = {}
    for q, x in good:
        if q % every == 0:
            scored = sorted((-float((np.array(y) * np.array(x)).sum()), c) for c, y in good if c != q and len(y) == len(x))
            found.setdefault(q, []).append([(c, -s) for s, c in scored[:k]])
    return found


def by_query(made):
    found = {}
    for r in sorted(made, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r)
    return found


def test_probe_sets_are_in_the_order_of_expected_scores():
    m = 3
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    cost += [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    valid = [c for n in range(m + 1) for c in itertools.combinations(range(2 * m), n) if not any(2 * m - 1 - j in c for j in c)]
    sets = probe_sets(m, 1000)
    assert len(sets) == len(valid) == 3**m
    assert {tuple(np.flatnonzero(s)) for s in sets} == set(valid)
    scores = [sum(cost[j] for j in np.flatnonzero(s)) for s in sets]
    assert np.allclose(scores, sorted(scores)) and not sets[0].any()


def test_probes_are_buckets_in_the_order_of_their_distance():
    random = np.random.default_rng(2)
    made = Hashing.make(8, 4, 1.0, 2.0, ProbeParams(tables=2))
    asked = random.standard_normal((6, 8))
    slots = made.of_queries(asked, 81, 81)
    unit = np.column_stack([asked / np.linalg.norm(asked, axis=1, keepdims=True), np.zeros(6)])
    for i, t in itertools.product(range(6), range(2)):
        places = unit[i] @ made.projections[t] / 2.0 + made.offsets[t]
        own = np.floor(places)
        assert np.array_equal(slots[i, t, 0], own)
        moved = slots[i, t] - own
        scores = np.where(moved > 0, own + 1 - places, np.where(moved < 0, places - own, 0.0)) ** 2
        assert len({tuple(s) for s in slots[i, t]}) == 81 and (np.diff(scores.sum(axis=1)) >= -1e-12).all()
    assert len(np.unique(bucket_ids(slots))) >= 81


@pytest.mark.parametrize("params", [
    ProbeParams(k=5, sample=16, block=16, queries=4, recall=1.0), ProbeParams(k=5, sample=400, width=0.2, most_probes=4, least=3)])
def test_neighbours_of_odd_rows(spark, params):
    rows = [(i, v) for i, v, _ in odd_vectors(np.random.default_rng(1))]
    rows += [(None, [1.0] * 16), (4000, [3e30] * 16), (4020, [-3e30] * 16), (5000, [7.0] * 5), (5001, [5.0] * 5)]
    rows += [(6000 + i, rows[0][1]) for i in range(60)] + [(40, rows[3][1]), (40, rows[3][1])]
    made = multiprobe.nearest(
        vectors(spark, [(*r, 1) for r in rows], extra=True), F.col("vec_id") % 20 == 0, params).collect()
    wanted = brute(rows, 5)
    got = by_query(made)
    assert set(got) == {q for q, each in wanted.items() if any(each)}
    held = total = 0
    for q, each in wanted.items():
        answers = got.get(q, [])
        assert len(answers) == sum(map(len, each))
        if len(each) == 1:
            assert [r.rank for r in answers] == list(range(1, len(each[0]) + 1))
            # No found score is better than brute force's at that rank, and ties are in order.
            assert all(r.score <= s + 1e-9 * abs(s) for r, (_, s) in zip(answers, each[0]))
            assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(answers, answers[1:]))
            total += len(each[0])
            held += len({r.vec_id for r in answers} & {c for c, _ in each[0]})
    assert held >= 0.9 * total
    assert multiprobe.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_copies_of_one_vector_are_found_by_their_smallest_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [float(i), 1.0, 0.0]) for i in range(30)]
    got = by_query(multiprobe.nearest(vectors(spark, [(*r, 1) for r in rows]), F.col("vec_id") % 20 == 0, ProbeParams(k=3)).collect())
    for q, each in brute(rows, 3).items():
        assert [(r.vec_id, r.score) for r in got[q]] == each[0]


def test_few_rows_are_all_found(spark):
    random = np.random.default_rng(8)
    rows = [(i, random.standard_normal(12).tolist()) for i in range(60)]
    got = by_query(multiprobe.nearest(vectors(spark, [(*r, 1) for r in rows[:15]]), F.col("vec_id") % 20 == 0).collect())
    assert len(got[0]) == 14
    got = by_query(multiprobe.nearest(vectors(spark, [(*r, 1) for r in rows]), F.col("vec_id") % 20 == 0).collect())
    assert [len(got[q]) for q in (0, 20, 40)] == [20] * 3


def test_recall_of_the_query(spark):
    stored = [(r.vec_id, r.embedding) for r in queries.table(spark, CHECK, "embeddings").collect()]
    got, wanted = by_query(queries.op12_multiprobe(spark, CHECK).collect()), brute(stored, 20)
    assert set(got) == set(wanted)
    held = 0
    for q, (each,) in wanted.items():
        assert len(got[q]) == 20
        truth = dict(each)
        held += len({r.vec_id for r in got[q]} & set(truth))
        assert all(r.score == pytest.approx(truth[r.vec_id], abs=1e-14) for r in got[q] if r.vec_id in truth)
    assert held >= 0.9 * 20 * len(wanted)
