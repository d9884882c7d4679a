"""Token files and pieces against the libraries and brute force."""

import random
import zlib

import numpy as np
import pytest
from conftest import CHECK
from pyspark.sql import functions as F

from orderlens.llm import pieces, token_files
from orderlens.llm.queries import PIECE_MODEL, QUERIES, WORD_BPE, table, tokenizer_file
from orderlens.session import shared_path

from .conftest import LONG, ODD, documents


def texts(n=60):
    rng = random.Random(3)
    parts = ["The", "don't", "Éa", "ǅ", "á", "l'été", "x,y", "end.", "end?!", "12,", "(z),", "Σ,", "İ.", "\t", "\n", "", "<|startoftext|>", "<|x", "日本,"]
    return ODD + [rng.choice([" ", "  "]).join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def stored(spark, docs):
    path = shared_path(spark, "test-tokens")
    token_files.write(token_files.encode(docs, tokenizer_file(WORD_BPE), 1), path)
    return path


@pytest.mark.parametrize("whole", [False, True])
def test_token_files_hold_what_the_library_gives(spark, whole):
    from tokenizers import Tokenizer

    docs = table(spark, CHECK, "documents") if whole else documents(spark, texts(), extra=True)
    path = stored(spark, docs)
    got = sorted(token_files.digests(token_files.read(spark, path)).collect())
    library = Tokenizer.from_file(tokenizer_file(WORD_BPE))
    start = 0
    for (key, text), row in zip(sorted(tuple(r) for r in docs.select("doc_id", F.coalesce("text", F.lit(""))).collect()), got):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(row) == (key, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_are_in_id_order_and_indexed(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = stored(spark, documents(spark, [f"word {i}" for i in range(500)]))
    files = sorted(glob.glob(path.removeprefix("file:") + "/part-*"))
    ids = [i for f in files for i in pq.read_table(f, columns=["doc_id"]).column(0).to_pylist()]
    assert ids == sorted(ids) and len(ids) == 500
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(0)
    assert column.has_column_index and column.has_offset_index


def test_selective_reads_of_token_files(spark, tmp_path):
    """Encodings and row groups as asked for; a read of some documents leaves the pages of others alone."""
    import glob

    import pyarrow.parquet as pq

    rng = random.Random(8)
    docs = documents(spark, [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(900)) for _ in range(400)) for _ in range(3000)])
    path = stored(spark, docs.coalesce(1))
    kinds = {}
    for file in glob.glob(path.removeprefix("file:") + "/part-*"):
        groups = pq.ParquetFile(file).metadata
        for g in range(groups.num_row_groups):
            assert groups.row_group(g).total_byte_size <= 40 << 20
            for c in range(groups.num_columns):
                column = groups.row_group(g).column(c)
                assert column.has_column_index and column.has_offset_index and column.compression == "ZSTD"
                kinds.setdefault(column.path_in_schema, set()).update(column.encodings)
    assert "DELTA_BINARY_PACKED" in kinds["doc_id"] and "DELTA_BINARY_PACKED" in kinds["before"]
    tokens = next(v for k, v in kinds.items() if k.startswith("tokens"))
    assert "RLE_DICTIONARY" in tokens
    # Metadata alone, and the tokens of three documents, by their ids.
    some = token_files.read(spark, path).filter(F.col("doc_id").between(1500, 1502))
    plan = some.select("doc_id", "start", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,1500)" in plan and "tokens:array" not in plan
    whole = {r.doc_id: r.tokens for r in token_files.read(spark, path).select("doc_id", "tokens").collect()}
    assert {r.doc_id: r.tokens for r in some.select("doc_id", "tokens").collect()} == {i: whole[i] for i in (1500, 1501, 1502)}


def test_empty_and_null_ids(spark):
    assert token_files.digests(token_files.read(spark, stored(spark, documents(spark, [])))).count() == 0
    repeated = spark.createDataFrame([(None, "b"), (1, "x"), (1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    rows = token_files.digests(token_files.read(spark, stored(spark, repeated))).collect()
    assert sorted(r.start for r in rows)[0] == 0 and len(rows) == 5
    assert sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)


def best_score(vocabulary, word):
    """Plain dynamic programme over all segmentations."""
    scores = {}
    for length, (_, ids, values) in vocabulary.by_length.items():
        scores.update({vocabulary.bytes_of[i].decode(): v for i, v in zip(ids, values)})
    best = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            value = scores.get(word[start:end], vocabulary.unknown if end - start == 1 else -np.inf)
            best[end] = max(best[end], best[start] + value)
    return scores, best[-1]


def test_pieces_have_the_best_score():
    vocabulary = pieces.Vocabulary(tokenizer_file(PIECE_MODEL))
    rng = random.Random(1)
    words = ["▁international", "▁▁▁a", "▁日本語", "▁x\x00y", "▁" + "ab" * 40] + [
        "▁" + "".join(rng.choice("aeiourstlnéß1.") for _ in range(rng.randrange(1, 14))) for _ in range(200)]
    for word, ids in zip(words, vocabulary.search_all(words)):
        scores, expected = best_score(vocabulary, word)
        got, unknown = 0.0, b""
        for i in np.frombuffer(ids, "<i4").tolist():
            if i in vocabulary.byte_ids.values():
                unknown += vocabulary.bytes_of[i]
            else:
                got += scores[vocabulary.bytes_of[i].decode()]
        got += len(unknown.decode()) * vocabulary.unknown
        assert got == pytest.approx(expected, rel=1e-12)


def test_words_longer_than_a_window():
    vocabulary = pieces.Vocabulary(tokenizer_file(PIECE_MODEL))
    word = "▁" + "abcdefgh" * 1_200
    ids = np.frombuffer(vocabulary.search([word])[0], "<i4")
    assert b"".join(vocabulary.bytes_of[i] for i in ids).decode() == word


def test_round_trip(spark):
    import sentencepiece

    docs = documents(spark, texts(), extra=True)
    model = tokenizer_file(PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = pieces.decode(pieces.encode(docs, model, decoded=True), model).collect()
    assert len(rows) == docs.count()
    for row in rows:
        if row.text is None:
            assert row.ids is None and row.decoded is None and row.decoded_crc32 is None
        else:
            plain = row.text.replace("▁", " ")
            assert row.decoded == plain == library.decode(row.ids)
            assert row.text_crc32 == row.decoded_crc32 and row.decoded_chars == len(plain)
    assert LONG in {r.decoded for r in rows}
    assert pieces.encode(documents(spark, []), model).count() == 0


def test_round_trip_of_the_query_is_that_of_the_stored_text(spark, tmp_path):
    given = ["plain text", "a ▁ b", "▁", "", None, "  two  spaces\n"]
    documents(spark, given).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op8_sentencepiece"](spark, str(tmp_path)).collect()}
    assert [rows[i].round_trip for i in range(len(given))] == ["▁" not in (t or "") for t in given]


def test_scores_of_a_unigram_model_stay():
    assert pieces.log_probabilities({3: -1.5, 4: -2.25}) == {3: -1.5, 4: -2.25}
    made = pieces.log_probabilities({3: 0.0, 4: -1.0, 5: -2.0})
    assert sum(np.exp(v) for v in made.values()) == pytest.approx(1.0)


def test_hash_clash_is_encoded_piece_by_piece(monkeypatch):
    from orderlens.llm import word_ids

    def clashing(data, starts, ends):
        return np.zeros(len(starts), np.uint64), np.arange(len(starts), dtype=np.uint64)

    monkeypatch.setattr(word_ids, "two_hashes", clashing)
    known = word_ids.WordIds(lambda words: word_ids.in_order([np.array([len(w)], np.int32) for w in words]))
    ids, counts = known(np.frombuffer(b"abbccc", np.uint8), np.array([0, 1, 3]), np.array([1, 3, 6]))
    assert ids.tolist() == [1, 2, 3] and counts.tolist() == [1, 1, 1]


def test_a_full_memory_starts_anew():
    from orderlens.llm import word_ids

    known = word_ids.WordIds(lambda words: word_ids.in_order([np.array([*w], np.int32) for w in words]), remembered=3)
    for text in (b"ab", b"cd", b"ae", b"xy", b"ab"):
        data = np.frombuffer(text, np.uint8)
        ids, _ = known(data, np.array([0, 1]), np.array([1, 2]))
        assert ids.tolist() == list(text)
