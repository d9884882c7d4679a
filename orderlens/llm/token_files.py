"""Token ids of documents as Parquet list columns, in id order, read back selectively.

The files are ordinary Parquet: one row per document with its id, the number of ids, the ids before
it in its file, and the ids as a list. Ids are dictionary-encoded (49,408 ids need 16 bits) and
compressed, the counters delta-encoded. Row groups are held to a stated size and every page is
listed in the column and offset indexes, so a reader that wants some documents (or only counts)
reads those pages alone.

Nulls: a null text is an empty one and gives the end id alone; rows with a null id come first.
Repeated rows and ids stay, ordered by id and then by text. An empty table gives an empty file set.
Columns beyond id and text are not written.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import after_space, long_pieces, slices, text_offsets
from orderlens.llm.word_ids import WordIds, in_order, per_row
from orderlens.session import pin

WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.writer.version": "PARQUET_2_0",
}


# Kinds of bytes that decide where a text may be cut.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTER = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz"))
_OPENS = np.isin(np.arange(256), list(b",.;:!?"))


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of lower-case texts that are encoded by themselves.

    The tokenizer drops white space and never joins across it. A run of plain punctuation at a
    word's end, after an ASCII letter, is a token of its own too, so it is cut off, which makes
    fewer distinct pieces.
    """
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.zeros(len(inside), bool)
    edge[offsets + 1] = True
    first = inside[1:-1] & (~inside[:-2] | edge[1:-1])
    last = inside[1:-1] & (~inside[2:] | edge[2:])
    # The trailing punctuation of a word: the word's last bytes back to the last other byte.
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    other = np.where(~_OPENS[data] & inside[1:-1], np.arange(len(data)), -1)
    np.maximum.accumulate(other, out=other)
    core = other[ends - 1] + 1
    off = (core > starts) & (core < ends)
    off[off] = _LETTER[data[core[off] - 1]]
    split = core[off]
    return np.sort(np.concatenate([starts, split])), np.sort(np.concatenate([ends, split]))


@lru_cache(maxsize=2)
def word_ids(tokenizer_path: str) -> WordIds:
    """The words this worker knows the ids of."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(tokenizer_path)

    ends_word = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if suffix:
        ends_word[[i for t, i in tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def alone(texts: list[str]) -> list[np.ndarray]:
        return [np.array(got.ids, np.int32) for got in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def together(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words that are one token of the pre-tokenizer each: their last ids show where they end."""
        groups = [" ".join(texts[at: at + 500]) for at in range(0, len(texts), 500)]
        ids = np.concatenate([np.zeros(0, np.int32), *alone(groups)])
        last = np.flatnonzero(ends_word[ids]) + 1
        if len(last) != len(texts):
            return in_order(alone(texts))
        counts = np.diff(last, prepend=0)
        return ids, last - counts, counts

    def encode(words: list[bytes]):
        texts = [w.decode("utf-8", "replace") for w in words]
        single = np.array([bool(suffix) and t.isalpha() for t in texts], bool)
        parts = (together([t for t, s in zip(texts, single) if s]),
                 in_order(alone([t for t, s in zip(texts, single) if not s])))
        begins, counts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        begins[single], counts[single] = parts[0][1:]
        begins[~single], counts[~single] = parts[1][1] + len(parts[0][0]), parts[1][2]
        return np.concatenate([parts[0][0], parts[1][0]]), begins, counts

    return WordIds(encode)


def encode_rows(column: pa.Array, known: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column one after another, and the number of each text's.

    The tokenizer lowers all letters itself, so ASCII ones may be lowered before; not in texts that
    may hold its special tokens, which are told apart by case.
    """
    offsets, data = text_offsets(column)
    special = b"<|" in data.tobytes()
    ids, counts = [], np.zeros(len(column), np.int64)
    for piece in long_pieces(column, after_space):
        offsets, data = text_offsets(piece)
        data = data if special else _LOWER[data]
        starts, ends = cut(data, offsets)
        made, sizes = known(data, starts, ends)
        ids.append(made)
        counts += per_row(sizes, starts, offsets)
    return np.concatenate(ids), counts


def encode(docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in id order with their ids, each with the ids before it in its chunk of rows."""
    digest = F.xxhash64("text")
    ordered = (
        docs.select(docs[key].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
        .withColumn("digest", digest)
        .repartitionByRange("doc_id", "digest")
        .sortWithinPartitions("doc_id", "digest", "text")
        .select("doc_id", "text")
    )
    schema = T.StructType([
        ordered.schema["doc_id"],
        T.StructField("chunk", T.IntegerType()),
        T.StructField("before", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.IntegerType(), False)),
    ])

    def run(batches):
        known = word_ids(tokenizer_path)
        before, chunk = 0, TaskContext.get().partitionId()
        for part in slices(batches, "text"):
            ids, counts = encode_rows(part.column("text"), known)
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"),
                pa.array(np.full(len(part), chunk, np.int32)),
                pa.array(before + ends - counts),
                pa.array(counts),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
            ], schema.names)
            before += int(ends[-1])

    return ordered.mapInArrow(run, schema)


def write(encoded: DataFrame, path: str) -> None:
    encoded.write.options(**WRITE_OPTIONS).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with ``start``, the number of ids of all documents before each.

    One total per chunk is added up over the chunks; that table has a row per written file. It is stored, so
    that its size decides whether it is broadcast.
    """
    rows = spark.read.parquet(path)
    upto = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = pin(
        rows.groupBy("chunk").agg(F.sum("n_tokens").alias("ids"))
        .select("chunk", F.coalesce(F.sum("ids").over(upto), F.lit(0)).alias("chunk_start")),
        "chunks")
    return rows.join(chunks, "chunk").withColumn("start", F.col("chunk_start") + F.col("before"))


def digests(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""
    rows = stored.select("doc_id", "start", "n_tokens", "tokens")
    schema = T.StructType([
        *[T.StructField(n, rows.schema[n].dataType) for n in ("doc_id", "start", "n_tokens")],
        T.StructField("ids_crc32", T.LongType()),
    ])

    def run(batches):
        for batch in batches:
            lists = batch.column("tokens")
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            offsets = lists.offsets.to_numpy()
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("doc_id", "start", "n_tokens")] + [pa.array(crcs, pa.int64())],
                schema.names)

    return rows.mapInArrow(run, schema)
