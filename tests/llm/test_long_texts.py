"""Texts far longer than what is worked on at once, and cuts of long texts."""

import random
import resource
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlens.llm import common, langid, pieces, secrets, simhash, token_files, toxicity
from orderlens.llm.queries import PIECE_MODEL, WORD_BPE, tokenizer_file

RNG = random.Random(21)
WORDS = "The house, the river — Ünïcode ▁ 日本語 scum don't stop.\nNew  line\t tab \U0001F600 x1 <|a|> A.B".split(" ") + ["", "", "\n"]
TEXTS = [" ".join(RNG.choice(WORDS) for _ in range(n)) for n in (0, 1, 2, 3, 40, 900)] + [
    "é token: abcdef1234,\n日 AKIA" + "B7" * 9 + ", password = 'hunter2hunter2', " + "deadbeef" * 4 + "\tghp_" + "Ab1" * 12 + " end " * 30] + ["x" * 700, " " * 500, "日本" * 300, "\n" * 300]


def results(text):
    column = pa.array([text], pa.string())
    known = langid.LanguageFilter.build(
        {n: np.random.default_rng(i).integers(0, 1 << 62, 20_000) for i, n in enumerate("ab")}, langid.LanguageModelParams())
    held, total, letters = np.zeros((1, 2)), np.zeros(1), np.zeros(1, bool)
    for piece in common.long_pieces(column, langid.after_no_letter):
        hashes, rows, some = langid.letter_grams(piece, (3, 4))
        more = known.found(hashes, rows, 1)
        held, total, letters = held + more[0], total + more[1], letters | some
    model = toxicity.ToxicityModel(np.sort(toxicity.hashes_of(["scum", "house", "x1"])), np.array([1.0, 2.0, 4.0]), -3.0)
    ids, counts = token_files.encode_rows(column, token_files.word_ids(tokenizer_file(WORD_BPE)))
    more, sizes, crcs = pieces.encode_rows(column, tokenizer_file(PIECE_MODEL))
    digests = pieces.decoded_digests(more, sizes, pieces.word_ids(tokenizer_file(PIECE_MODEL))[2])
    spans = secrets.spans_of(column, secrets.scanner())
    return (held.tolist(), spans, total.tolist(), letters.tolist(), toxicity.score_texts(column, model).tolist(), ids.tolist(), counts.tolist(),
            more.tolist(), sizes.tolist(), crcs, *map(list, digests), simhash.majority_bits(simhash.shingle_hashes(text.encode(), 3)))


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("limit", [8, 64, 257])
def test_stretches_give_what_the_whole_text_gives(monkeypatch, text, limit):
    whole = results(text)
    for module in (common, pieces):
        monkeypatch.setattr(module, "SLICE_BYTES", limit)
    assert results(text) == whole


def test_stretches_cover_the_text():
    for text in TEXTS:
        data = np.frombuffer(text.encode(), np.uint8)
        for limit in (8, 100):
            cuts = list(common.stretches(data, common.after_space, limit))
            assert b"".join(data[a:b].tobytes() for a, b in cuts) == text.encode()
            assert all(chr(data[b - 1]).isspace() for _, b in cuts[:-1])


def test_memory_does_not_grow_with_a_text(spark):
    """Sixteen megabytes: all operators' own arrays stay below a few times that."""
    text = ("The quick brown fox, jumps over it " * 8 + "\n") * (16 * 1024 * 1024 // 281)
    results(text[:3000])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    made = results(text)
    assert made[9] == [zlib.crc32(text.encode())] == made[11] and made[10] == [len(text)]
    # The ids of 16 MB are 14 MB each as arrays; lists of them, as the test makes, take 8 bytes an id more.
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 700 * 1024


def test_rows_of_whole_operators(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))], "doc_id long, toxic int")
    model = langid.learn(docs, F.lit(True), langid.LanguageModelParams(min_count=1))
    assert all(r.lang_pred in ("en", "und") for r in langid.predict(docs, model).collect())
    assert toxicity.score(docs, toxicity.learn(docs, labels, F.lit(True))).count() == len(TEXTS)
