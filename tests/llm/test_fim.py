"""Fill-in-the-middle examples and the learned rank index that cuts them."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import fim

from .conftest import LONG, ODD, documents


@pytest.mark.parametrize("slack", [0, 3, 127])
@pytest.mark.parametrize("shape", ["even", "random", "one long line", "steps", "ties", "single", "none"])
def test_index_gives_every_offset(shape, slack, monkeypatch):
    monkeypatch.setattr(fim, "FIT_RANKS", 1000)
    rng = np.random.default_rng(5)
    steps = {
        "even": np.full(5000, 40), "random": rng.integers(1, 900, 5000), "one long line": np.r_[np.full(700, 3), 10**7, np.full(900, 5)],
        "steps": np.repeat(rng.integers(1, 10**6, 40), 60), "ties": np.zeros(3000, int), "single": np.array([9]), "none": np.zeros(0, int)}[shape]
    offsets = np.cumsum(steps).astype(np.int64)
    index = fim.RankIndex(offsets, slack)
    ranks = np.arange(len(offsets))
    assert np.array_equal(index[ranks], offsets)
    assert len(offsets) == 0 or np.abs(offsets - index.predict(ranks)).max() <= slack
    if shape in ("even", "ties"):
        assert len(index.segments) == -(-len(offsets) // 1000)


def by_hand(key, text, rate=100, suffix_first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in fim.MARKERS) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = ODD + [
    "a\nb\nc\n", "a\n\n\nb", "\n", "one\r\ntwo\r\n", "has <M> inside\nx", "ends with <P\nP> and <\nS>x\n", "é\n日本\n\U0001F600\n" * 50,
    (LONG[:400] + "\n") * 300, "x" * 70_000 + "\n" + "y\n" * 3_000 + "z" * 90_000]


@pytest.mark.parametrize("rate, first", [(100, 50), (40, 100), (100, 0)])
def test_examples_are_those_made_by_hand(spark, rate, first):
    docs = documents(spark, TEXTS * 3, extra=True).withColumns({n: F.lit("old") for n in ("n", "form", "read0", "text_", "Output")})
    made = fim.transform(docs, fim.FimParams(rate=rate, suffix_first=first)).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    rows = made.collect()
    assert len(rows) == 3 * len(TEXTS) and {"read0", "text_", "score"} < set(made.columns) and rows[0].read0 == "old"
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, r.text, rate, first)
        assert r.back == (r.text or "")
        if r.form != "plain":
            assert r.prefix_chars + r.middle_chars + r.suffix_chars == len(r.text)


def test_null_and_equal_ids_and_empty_tables(spark):
    docs = documents(spark, ["a\nb\nc\nd", "a\nb\nc\nd", "e\nf"]).withColumn("doc_id", F.lit(None).cast("long"))
    for r in fim.transform(docs).collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(None, r.text)
    assert fim.transform(docs.limit(0)).count() == 0
