"""Chat, vectors, mixing, the pipeline, and every query that SQL can express."""

import hashlib
import json
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from compare import normal
from conftest import CHECK
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from orderlens.llm import chat, forest, mixing, topk
from orderlens.llm.queries import QUERIES, SQL, table

from .conftest import ODD, documents


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_agree_with_sql(spark, name):
    frame = QUERIES[name](spark, CHECK)
    with duckdb.connect() as db:
        for view in ("documents", "embeddings", "conversations"):
            db.execute(f"CREATE VIEW {view} AS SELECT * FROM '{CHECK}/{view}.parquet'")
        result = db.execute(SQL[name])
        names, rows = [d[0] for d in result.description], result.fetchall()
    assert normal(frame.columns, [tuple(r) for r in frame.collect()]) == normal(names, rows)


def test_registered_queries():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names


RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "a<|im_end|>b"}], "id": 3},
    "conversations": {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
    "instruction with input": {"instruction": "do", "input": "this", "output": "done"},
    "instruction": {"instruction": "do", "output": "done", "messages": 5},
    "prompt and completion": {"prompt": "p", "completion": "c"},
    "question and answer": {"question": "q", "answer": "a", "extra": {"prompt": 1}},
    None: {"unknown": 1},
}


def test_each_record_is_mapped_by_its_own_schema(spark):
    rows = [(i, json.dumps(r)) for i, r in enumerate(RECORDS.values())] + [(90, None), (91, "no json"), (92, "[1]")]
    got = {r.conv_id: r for r in chat.from_json_text(spark.createDataFrame(rows, "conv_id long, record string"), "record").collect()}
    assert [got[i].layout for i in range(len(RECORDS))] == list(RECORDS)
    assert [tuple(t) for t in got[1].turns] == [("user", "hi"), ("assistant", "yo")]
    assert [tuple(t) for t in got[2].turns] == [("user", "do\nthis"), ("assistant", "done")]
    assert all(got[i].turns is None for i in (90, 91, 92))


def test_a_frame_is_mapped_by_its_schema(spark):
    frame = spark.createDataFrame([(1, [("user", "x"), (None, None)], 2)],
                                  "conv_id long, messages array<struct<role string, content string>>, other int")
    assert [tuple(t) for t in chat.from_frame(frame).first().turns] == [("user", "x"), ("", "")]
    with pytest.raises(ValueError):
        chat.from_frame(spark.range(1).withColumnRenamed("id", "conv_id"))


def test_formatting_is_reversible(spark):
    rng = random.Random(3)
    parts = ["<|im_end|>\n", "<|im_start|>", "<|im_sep|>", "<", "\\", "|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "é", "\n", "x", "$1"]
    rows = [(i % 40, i, rng.choice(["user", "assistant", "tool<|im_sep|>", None]), None if i == 7 else "".join(rng.choice(parts) for _ in range(8)))
            for i in range(400)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.from_frame(frame.withColumn("segments", F.lit("old")))
    made = turns.join(chat.render(turns), "conv_id").withColumn("formatted", chat.formatted_text(F.col("segments")))
    for r in made.select("turns", chat.read_turns(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("loss")).collect():
        assert r.turns == r.back
        assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")
    assert chat.from_frame(frame.limit(0)).count() == 0


def vectors(spark, rows, extra=False):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return frame.withColumns({n: F.lit(1) for n in ("rep", "links", "rank", "score", "numbers")}) if extra else frame


def odd_vectors(rng, n=400, dims=16):
    made = []
    for i in range(n):
        v = rng.standard_normal(dims)
        if i % 3 == 0 and made:
            v = np.array(made[rng.integers(len(made))]) + 0.03 * rng.standard_normal(dims)
        made.append(v.astype(np.float32).tolist())
    rows = [(i, v, i % 2) for i, v in enumerate(made)]
    inf, nan = float("inf"), float("nan")
    rows += [(1000 + i, v, 1) for i, v in enumerate([None, [], [0.0] * dims, [inf] + [1.0] * 15, [nan] * dims, [None] * dims, [1.0, 2.0], [2.0, 4.0]])]
    return rows + [(2000, made[0], None), (2001, made[0], 0), (2002, made[0], 0), (3000, made[1], 1), (3000, made[1], 1)]


def test_forest_links_are_those_of_brute_force(spark):
    rows = odd_vectors(np.random.default_rng(1))
    got = forest.near_duplicates(vectors(spark, rows, extra=True), forest.ForestParams(leaf=32, block=16)).collect()
    assert len(got) == len(rows)
    good = [i for i, (_, v, label) in enumerate(rows) if v and label is not None and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y >= 0.98 * np.linalg.norm(x) * np.linalg.norm(y):
                links[a].add(b)
    counts = {r.vec_id: r.n_links for r in got}
    found = sum(counts[rows[i][0]] for i in links)
    assert found <= sum(map(len, links.values())) and found >= 0.99 * sum(map(len, links.values()))
    assert counts[2001] == len(links[next(i for i in range(len(rows)) if rows[i][0] == 2001)]) and counts[2000] == 0
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert forest.near_duplicates(vectors(spark, [])).count() == 0


def test_pivots_lie_far_apart():
    near = np.random.default_rng(1).standard_normal((200, 4)) * 0.01
    corners = 10 * np.eye(4)
    chosen = topk.spread_pivots([*near.tolist(), *corners.tolist(), [1.0], [2.0]], 6)
    assert all(c in chosen for c in corners.tolist()) and sum(len(c) == 1 for c in chosen) == 1
    assert topk.spread_pivots([[1.0, 2.0]] * 9, 4) == [[1.0, 2.0]]


def test_blocks_without_a_bound_are_skipped():
    """Queries that know a score look only at rows whose bound reaches it."""
    rng = np.random.default_rng(4)
    centres = 100 * np.eye(6)
    rows = np.floor(np.repeat(centres, 50, axis=0) + rng.standard_normal((300, 6)))
    pivots = topk.spread_pivots(rows.tolist(), 8)
    far = np.array([[np.linalg.norm(r - p) for p in pivots] for r in rows])
    frame = pd.DataFrame({"vec_id": np.arange(300), "row": np.arange(300), "numbers": list(rows), "distances": list(far)})
    queries = frame.iloc[::50].assign(known=9_500.0)
    here, elsewhere = frame.iloc[:50], frame.iloc[50:100]
    found = topk.search_block(queries.iloc[:1], here, topk.TopKParams())
    assert len(found) == 5 and (found["score"] >= 9_500).all()
    assert topk.search_block(queries.iloc[:1], elsewhere, topk.TopKParams()).empty


def test_labels_outside_the_sample_are_cut_by_their_size(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(4).astype(np.float32).tolist(), 0) for i in range(300)]
    rows += [(1000 + i, rows[i][1], 0) for i in range(100)] + [(2000 + i, rng.standard_normal(4).tolist(), 1 + i // 2) for i in range(600)]
    params = forest.ForestParams(leaf=16, block=40, sample=0)
    frame = vectors(spark, rows)
    distinct = forest.with_sizes(frame.select(
        F.col("vec_id").alias("rep"), F.lit(1).cast("bigint").alias("copies"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector")))
    grown = forest.grow_forest(distinct, params)
    assert not grown.trees
    tasks = forest._spread(distinct, grown).groupBy("label", "leaf", "first", "second").count().collect()
    assert max(r["count"] for r in tasks) < 2 * 60 and len([r for r in tasks if r.label == 0]) == 55
    # Labels no larger than a leaf have no tree, so many of them do not make the forest larger.
    assert set(forest.grow_forest(distinct, forest.ForestParams(leaf=16, sample=10**6)).trees) == {(0, 4)}
    got = {r.vec_id: r.n_links for r in forest.near_duplicates(frame, params).collect()}
    whole = {r.vec_id: r.n_links for r in forest.near_duplicates(frame, forest.ForestParams(leaf=10**6)).collect()}
    assert got == whole and all(got[1000 + i] >= 1 for i in range(100))


@pytest.mark.parametrize("sample", [1, 40, 4096])
def test_top_k_is_exact(spark, sample):
    rows = odd_vectors(np.random.default_rng(2)) + [(4000, [3e38] * 16, 1), (4050, [-3e38] * 16, 1)]
    # Just below nil the floor is -1.
    rows += [(4100, [1.0] * 3, 1), (4101, [-1e-20, 1.0, 1e-20], 1), (4102, [-0.0, 1.0, -1.0], 1)]
    params = topk.TopKParams(rows=64, queries=8, together=3, step=10, pivots=6, sample=sample)
    got = topk.top_k(vectors(spark, rows, extra=True), F.col("vec_id") % 50 == 0, params).collect()
    good = [(i, [int(np.floor(256.0 * float(x))) for x in v]) for i, v, _ in rows if v is not None and None not in v and np.isfinite(v).all()]
    wanted = []
    for q, x in good:
        if q % 50 == 0:
            scored = sorted((-min(max(sum(a * b for a, b in zip(x, y)), -2**63), 2**63 - 1), c) for c, y in good if c != q and len(x) == len(y))
            wanted += [(q, n, c, -s) for n, (s, c) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_targets_stop_at_the_limit_and_the_rest_is_shared_again(spark):
    sizes = {"a": 10, "b": 1000, "c": 400, None: 90, "d": 0}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame, (3, 1, 2), 1.5, 2.0).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    level, total = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in level]
        rest = total - sum(level.values())
        share = {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = {s: 2.0 * sizes[s] for s in open_ if share[s] > 2.0 * sizes[s]}
        if not over:
            break
        level |= over
    assert got == pytest.approx({**share, **level})
    assert sum(got.values()) == pytest.approx(total)


def test_mix_comes_near_its_targets_and_is_in_training_order(spark):
    docs = documents(spark, [*ODD, *["word " * (1 + i % 40) for i in range(600)]], extra=True)
    plan = mixing.plan(mixing.measured(docs)).collect()
    assert sorted(plan) == sorted(mixing.plan(mixing.measured(docs.repartition(7))).collect())
    for source in {r.source for r in plan}:
        own = [r for r in plan if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(r.taken <= 2 * r.size for r in own)
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert len(rows) == sum(r.copies for r in plan) and all(0 <= r.position <= 1 for r in rows)
    assert mixing.mix(documents(spark, [])).count() == 0


def time_asked(points, share):
    """The time at which the schedule has asked for this share of its integral, by halving."""
    grid, weights = zip(*points)

    def asked(until):
        inside = [t for t in grid if t < until] + [until]
        return np.trapezoid(np.interp(inside, grid, weights), inside)

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if asked(mid) < share * asked(1.0) else (low, mid)
    return low


def test_registered_mix_is_made_of_its_training_order(spark, monkeypatch):
    stored = []
    real = mixing.in_training_order
    monkeypatch.setattr(mixing, "in_training_order", lambda *a: stored.append(real(*a)) or stored[-1])
    taken = {r.doc_id: r for r in QUERIES["op10_mixing"](spark, CHECK).collect()}
    assert stored
    rows = QUERIES["op10_training_order"](spark, CHECK).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    copies = {}
    for r in rows:
        copies.setdefault(r.doc_id, []).append(r)
    assert {d: len(c) * taken[d].size for d, c in copies.items()} == {d: r.taken for d, r in taken.items() if r.taken}
    # Each source's documents in the order of their digests, epoch after epoch, inverted one by one.
    sources = {r.doc_id: r.source for r in table(spark, CHECK, "documents").collect()}
    names, checked = sorted(set(sources.values())), 0
    for source in names:
        at, points = 0, mixing.SCHEDULES[names.index(source) % 3]
        for d in sorted((d for d in sources if sources[d] == source), key=lambda d: hashlib.md5(str(d).encode()).hexdigest()):
            for c in copies.get(d, []):
                middle = at + taken[d].size / 2 + c.copy * taken[d].source_size
                assert c.source == source and c.position == pytest.approx(time_asked(points, middle / taken[d].target), abs=1e-9)
                checked += 1
            at += taken[d].size
    assert checked == len(rows) > 1000


def slow_plan(rows):
    """Copies, middle and place of each (id, source, size), in the order of SQL."""
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    own = {s: sum(r[2] for r in rows if r[1] == s) for s in names}
    target, total = {}, 1.5 * sum(own.values())
    while True:
        open_ = [s for s in names if s not in target]
        rest = (total - sum(target.values())) / sum(weights[s] for s in open_)
        over = {s: 2.0 * own[s] for s in open_ if rest * weights[s] > 2.0 * own[s]}
        if not over:
            target |= {s: rest * weights[s] for s in open_}
            break
        target |= over
    out, at = [], dict.fromkeys(names, 0)
    key = lambda r: (hashlib.md5(b"" if r[0] is None else str(r[0]).encode()).hexdigest(), r[0] is not None, r[0] or 0, r[2])
    for i, s, size in sorted(rows, key=key):
        middle = at[s] + size / 2
        out.append((i, s, size, int(np.ceil((target[s] - middle) / own[s])) if size and middle < target[s] else 0))
        at[s] += size
    return out


def test_rows_of_null_and_repeated_ids_have_their_own_plans(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, None, None, 1, 2, rng.randrange(9_000)]), rng.choice(["a", "a", "a", "b", None]),
             "w " * rng.randrange(30), rng.choice(["x", None])) for _ in range(900)]
    # Ids whose digests lie around that of a null id, and rows that are equal in every column.
    rows += [(i, "a", "w " * 9, "x") for i in range(60_000) if hashlib.md5(str(i).encode()).hexdigest().startswith("d41")]
    rows += [(7, "b", "twin twin twin", None)] * 40 + [(None, "b", "null twin", None)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, extra string").repartition(5)
    sizes = mixing.measured(docs)
    wanted = slow_plan([(i, s, len(t.split())) for i, s, t, _ in rows])
    order = lambda r: tuple((x is None, x) for x in r)
    for crowded in (mixing.CROWDED, 30):
        plan = mixing.plan(sizes, crowded=crowded).collect()
        assert sorted([(r.doc_id, r.source, r.size, r.copies) for r in plan], key=order) == sorted(wanted, key=order)
    whole, cut = (
        max(r["count"] for r in mixing.with_pieces(sizes, c).groupBy("source", "piece").count().collect()) for c in (mixing.CROWDED, 30))
    assert whole > 200 and cut <= 60
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == sum(w[3] for w in wanted)
    words, taken = {}, {}
    for r in mixed:
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    for _, s, size, n in wanted:
        taken[s] = taken.get(s, 0) + size * n
    assert words == taken
    assert {(r.doc_id, r.source, r.text, r.extra) for r in mixed} <= set(rows)


@pytest.mark.parametrize("turn", [0, 1, 2])
def test_training_time_inverts_the_integral_of_the_schedule(spark, turn):
    points = mixing.SCHEDULES[turn]
    asked = [i / 20 for i in range(21)]
    frame = spark.createDataFrame([(a,) for a in asked], "x double")
    for share, time in frame.select("x", mixing.training_time(F.col("x"), F.lit(turn))).collect():
        grid = np.linspace(0, time, 2001)
        weights = np.interp(grid, [t for t, _ in points], [w for _, w in points])
        assert np.trapezoid(weights, grid) == pytest.approx(share, abs=1e-6)


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = table(spark, CHECK, "documents")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, CHECK)
        after[name] = docs
        if name != names[-1]:
            assert docs.columns == before.columns
    kept = {r.doc_id for r in after["language_id"].collect()}
    assert len(kept) == 1000
    counts = {n: f.count() for n, f in after.items()}
    assert counts["simhash_near_duplicates"] == counts["secret_scan"] < 1000
    assert counts["source_mix"] == counts["sentencepiece"] > 1000


def test_language_stage_keeps_texts_of_one_letter_words(spark):
    docs = table(spark, CHECK, "documents")
    texts = [("A.", "en"), ("I - a, B", None), ("é", "fr"), ("...", "en"), ("", None), (None, "en"), ("ЖЩЪЫ ЖЩЪЫ", "en")]
    more = spark.createDataFrame([(-1 - i, t, lang, "s", 0) for i, (t, lang) in enumerate(texts)], docs.schema)
    kept = corpus_pipeline.language_id(spark, docs.unionByName(more), CHECK).collect()
    assert sorted((r.doc_id, r.text, r.lang) for r in kept if r.doc_id < 0) == [
        (-3, "é", "fr"), (-2, "I - a, B", "und"), (-1, "A.", "en")]
    assert len(kept) == 1000 + 3


def test_last_stage_decodes_what_it_encodes(spark):
    rows = {r.doc_id: r for r in corpus_pipeline.token_ids(spark, documents(spark, ODD), CHECK).collect()}
    for key, text in enumerate(ODD):
        plain = None if text is None else text.replace("▁", " ")
        wanted = (None, None) if text is None else (len(plain), zlib.crc32(plain.encode()))
        assert (rows[key].decoded_chars, rows[key].decoded_crc32) == wanted and rows[key].text_crc32 == wanted[1]


def test_pipeline_stages_take_odd_and_empty_tables(spark):
    from .conftest import DOCUMENT

    for docs in (documents(spark, ODD), spark.createDataFrame([], DOCUMENT)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, CHECK)
            docs.count()
