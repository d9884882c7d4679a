"""Each stage's rows against plain Python, and column names that operators use themselves."""

import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from conftest import CHECK
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import langid, mixing, pieces, secrets, simhash
from orderlens.llm.queries import PIECE_MODEL, table, tokenizer_file

from .conftest import ODD
from .test_tables import slow_plan
from .test_texts import brute_components, by_regex, slow_fingerprint
from .test_tokens import best_score

HELPERS = ("text__", "row__", "copy__", "lang__", "key__", "score", "lang_pred", "n_grams", "fp", "root", "own_row", "plan_key",
           "plan_copy", "position", "copies", "read0", "text_", "kept text", "doc_id__", "secrets", "component_id", "kept_id")


def fixture(spark):
    stored = table(spark, CHECK, "documents").filter("doc_id < 160").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in stored]
    rng = random.Random(3)
    base = [r for r in rows if r[1] and len(r[1].split()) > 150][:6]
    rows += [(500 + i, re.sub(r"\b\w+\b", lambda m: m[0] if rng.random() > 0.004 else "other", r[1]), r[2], r[3], r[4]) for i, r in enumerate(base)]
    rows += [(600 + i, r[1], r[2], None, r[4]) for i, r in enumerate(base)]
    odd = [t for t in ODD if t is None or len(t) < 1000] + [
        "password: hunter2hunter2 AKIA" + "B7" * 9, "see ghp_" + "Ab1" * 12, "xoxb-" + "12ab-" * 5 + " eyJab.cd" + "x" * 30 + ".sig_1-", "zzqq xxkk jjww"]
    rows += [(700 + i, t, rng.choice(["en", None]), "odd", 0) for i, t in enumerate(odd)] + [(None, "a null id and words", "en", "odd", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in HELPERS}).repartition(4)


def grams_of(text, orders=(3, 4)):
    padded = ["", *[(c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] in "LM" else "" for c in text or ""], ""]
    return [(o, *padded[i: i + o]) for o in orders for i in range(len(padded) - o + 1)
            if all(padded[i + 1: i + o - 1]) and (padded[i] or padded[i + o - 1])]


def slow_language(rows):
    """(row, language) of those kept."""
    counts = {}
    for r in rows:
        fold = 0 if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 4
        if r.lang is not None and r.text is not None and fold != 2:
            for g in grams_of(r.text):
                counts.setdefault(r.lang, {}).setdefault(g, 0)
                counts[r.lang][g] += 1
    common = {lang: {g: n for g, n in c.items() if n >= 3} for lang, c in counts.items()}
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in common.items()}
    known = {lang: {g for g, x in c.items() if x >= 0.15 * sum(o.get(g, 0) for o in rate.values())} for lang, c in rate.items()}
    kept = []
    for r in rows:
        if not any(unicodedata.category(c)[0] == "L" for c in r.text or ""):
            continue
        own = grams_of(r.text)
        held = {lang: sum(g in k for g in own) for lang, k in sorted(known.items())}
        best = max(held, key=held.get)
        if not own or held[best] / len(own) >= 0.2:
            kept.append((r, r.lang if r.lang is not None else best if own else "und"))
    return kept


def values(r, **changed):
    return tuple({**r.asDict(), **changed}.values())


def order(row):
    return tuple((x is None, str(x)) for x in row)


def slow_spans(text):
    raw, found = text.encode(), []
    for kind, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, raw):
            if len(m[2] if rule.value_only else m[0]) >= rule.shortest:
                a, b = (len(raw[:i].decode()) for i in m.span())
                found.append((a, kind, b))
    return [(secrets.RULES[k].kind, a, b) for a, k, b in sorted(found)]


def test_rows_of_every_stage(spark):
    docs = fixture(spark)
    rows = docs.collect()
    language, distinct, hidden, mixed, coded = (f for _, f in corpus_pipeline.STAGES)

    made = language(spark, docs, CHECK)
    assert made.columns == docs.columns
    wanted = [values(r, lang=lang) for r, lang in slow_language(rows)]
    assert sorted(map(tuple, made.collect()), key=order) == sorted(wanted, key=order)
    assert len(wanted) < len(rows) and any(r.doc_id == 703 for r in rows)

    docs, rows = made, made.collect()
    made = distinct(spark, docs, CHECK)
    groups = brute_components([slow_fingerprint(r.text) for r in rows])
    first = {}
    for r, g in sorted(zip(rows, groups), key=lambda x: (x[0].doc_id is None, x[0].doc_id or 0)):
        first.setdefault(g, r)
    assert sorted(map(tuple, made.collect()), key=order) == sorted(map(tuple, first.values()), key=order)
    assert len(first) < len(rows) - 5

    docs, rows = made, made.collect()
    made = hidden(spark, docs, CHECK)
    wanted = []
    for r in rows:
        spans = slow_spans(r.text)
        assert [s for s in spans if s[0] in {x.kind for x in secrets.BASE_RULES}] == by_regex(r.text)
        text = secrets.hide(r.text, spans) if spans else r.text
        wanted.append(values(r, text=text, n_chars=len(text)))
    assert sorted(map(tuple, made.collect()), key=order) == sorted(wanted, key=order)
    assert sum(a != b for a, b in zip(sorted(map(tuple, rows), key=order), sorted(wanted, key=order))) > 2

    docs, rows = made, made.collect()
    made = mixed(spark, docs, CHECK)
    plan = {i: n for i, _, _, n in slow_plan([(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in rows])}
    wanted = [tuple(r) for r in rows for _ in range(plan[r.doc_id])]
    assert made.columns == docs.columns and sorted(map(tuple, made.collect()), key=order) == sorted(wanted, key=order)

    docs, rows = made, made.collect()
    vocabulary = pieces.Vocabulary(tokenizer_file(PIECE_MODEL))
    by_id = {r.doc_id: r for r in rows}
    made = coded(spark, docs, CHECK).collect()
    assert len(made) == len(rows)
    known = {}
    for r in made:
        text = by_id[r.doc_id].text.replace("▁", " ")
        raw = b"".join(vocabulary.bytes_of[i] for i in r.ids).decode().replace("▁", " ")
        assert raw == (" " + text if text else "") and r.text_crc32 == r.decoded_crc32 == zlib.crc32(text.encode())
        assert (r.decoded_chars, r.lang, r.source) == (len(text), by_id[r.doc_id].lang, by_id[r.doc_id].source)
        if len(text) < 400:
            score = 0.0
            for word in re.findall(r" +[^ \n]*|\n|[^ \n]+", " " + text):
                if word not in known:
                    known[word] = best_score(vocabulary, word.replace(" ", "▁"))
                score += known[word][1]
            scores, got, spelt = next(iter(known.values()))[0], 0.0, b""
            for i in r.ids:
                if i in vocabulary.byte_ids.values():
                    spelt += vocabulary.bytes_of[i]
                else:
                    got += scores[vocabulary.bytes_of[i].decode()]
            assert got + len(spelt.decode()) * vocabulary.unknown == pytest.approx(score, rel=1e-9)


def test_job_leaves_its_result_alone(spark, tmp_path, monkeypatch):
    import glob

    from orderlens import session

    made = []
    real = session.shared_path
    monkeypatch.setattr(session, "shared_path", lambda *a: made.append(real(*a)) or made[-1])
    table(spark, CHECK, "documents").filter("doc_id < 150").write.parquet(f"{tmp_path}/in/documents.parquet")
    corpus_pipeline.main(["--tables", f"{tmp_path}/in", "--output", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out").filter("size(ids) > 0").count() > 100
    assert len(made) > 10 and not any(glob.glob(p.removeprefix("file:") + "/*") for p in made)


def test_names_that_operators_use_themselves_come_through(spark):
    docs = fixture(spark)
    want = {r.doc_id: r for r in docs.collect()}
    outputs = {"lang_pred", "score", "fp", "secrets", "root", "component_id", "position", "text", "n_chars"}
    made = [
        langid.predict(docs, langid.learn(docs, F.lit(True))), simhash.distinct_documents(docs), secrets.find(docs),
        secrets.redact(docs), mixing.mix(docs), pieces.encode(docs, tokenizer_file(PIECE_MODEL))]
    for frame in made:
        assert {c for c in docs.columns if c not in outputs} <= set(frame.columns)
        for r in frame.collect():
            for c in set(docs.columns) - outputs - {"position"}:
                assert r[c] == want[r.doc_id][c]
