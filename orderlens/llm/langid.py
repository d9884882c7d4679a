"""Language identification by n-gram filters that answer with a bitmask of languages.

One filter holds all languages, cut into bit slices: each position of the Bloom filter is a word
with a bit per language, so ANDing the words at an n-gram's few positions gives all languages that
contain it. The set bits are counted per language over a text, each count is corrected for the
false positives its language's filling predicts, and the largest corrected count decides.

An n-gram belongs to the languages in which it is common: those with at least ``min_share`` of its
rates added over the languages. The filters are learned from a bounded sample of the labelled rows
(``sample_per_language``, drawn by a hash of the id, so that copies of a text are drawn one by one) and hold at most ``grams_per_language``
n-grams each; those two parameters bound the model, which goes through the driver. Predictions read
whole texts.

Nulls: rows with a null language teach nothing; a null text, or one without a letter, is ``und``
with score 0, and so is every text if nothing was learned. A text whose n-grams no language holds
gets the first of the best languages by name, with score 0. Ties go to the smaller name. A long text is
read in stretches of a megabyte that no n-gram crosses, so memory does not grow with it. An empty table gives an
empty one. Repeated
rows stay, extra columns are carried, and input columns named like an output column are replaced.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import append_columns, long_pieces, mix, slices, text_offsets, texts_of

UNDECIDED = "und"


@dataclass(frozen=True)
class LanguageModelParams:
    orders: tuple[int, ...] = (3, 4)
    sample_per_language: int = 6_000
    grams_per_language: int = 60_000
    min_count: int = 3
    min_share: float = 0.15
    probes: int = 3
    #: Filter positions for each n-gram of the fullest language.
    positions_per_gram: int = 8


@lru_cache(maxsize=1)
def lowered_letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case letter or mark, 0 if it is neither, and whether it is a letter."""
    table = np.zeros(sys.maxunicode + 2, np.uint32)
    letter = np.zeros(sys.maxunicode + 2, bool)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LM":
            low = chr(code).lower()
            table[code] = ord(low) if len(low) == 1 else code
            letter[code] = kind == "L"
    return table, letter


def letter_grams(column: pa.Array, orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all letter n-grams, the row of each, and whether each row has a letter.

    Marks are parts of words, but a text of marks alone has no letter. Other characters are word edges; an n-gram starts at an edge or a letter and holds no edge
    inside, and rows never share an n-gram.
    """
    offsets, data = text_offsets(column)
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    rows = np.repeat(np.arange(len(column)), np.diff(begins))
    lowered, letter = lowered_letters()
    low = lowered[codes]
    widest = max(orders)
    letters = np.zeros(len(low) + len(column) + widest, np.uint64)
    letters[np.arange(len(low)) + rows + 1] = low
    owner = np.zeros(len(letters), np.int64)
    owner[np.arange(len(low)) + rows + 1] = rows
    with_letter = np.zeros(len(column), bool)
    with_letter[rows[letter[codes]]] = True

    hashes, owners = [], []
    isletter = letters > 0
    for order in orders:
        size = len(letters) - order + 1
        ok = np.ones(size, bool)
        value = np.full(size, order, np.uint64)
        for k in range(order):
            value = value * np.uint64(0x100000001B3) + letters[k: k + size]
            if 0 < k < order - 1 or (k == 1 and order == 2):
                ok &= isletter[k: k + size]
        ok &= isletter[:size] | isletter[order - 1: order - 1 + size]
        at = np.flatnonzero(ok)
        hashes.append(mix(value[at]))
        owners.append(owner[at + min(1, order - 1)])
    return np.concatenate(hashes), np.concatenate(owners), with_letter


def after_no_letter(window: np.ndarray) -> np.ndarray:
    """Places after an ASCII byte that is no letter: no n-gram reaches across."""
    before = window[:-1] | 32
    return np.flatnonzero((window[:-1] < 128) & ((before < ord("a")) | (before > ord("z")))) + 1


@dataclass
class LanguageFilter:
    """Bit slices: words[w, p] holds the bits of languages 64*w ... at position p."""

    languages: list[str]
    orders: tuple[int, ...]
    probes: int
    words: np.ndarray
    false_rate: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], params: LanguageModelParams) -> LanguageFilter:
        languages = sorted(grams)
        fullest = max((len(g) for g in grams.values()), default=1)
        bits = min(21, max(10, int(fullest * params.positions_per_gram - 1).bit_length()))
        words = np.zeros((-(-len(languages) // 64) or 1, 1 << bits), np.uint64)
        made = cls(languages, params.orders, params.probes, words)
        filled = []
        for i, name in enumerate(languages):
            for at in made.positions(grams[name].view(np.uint64)):
                words[i // 64, at] |= np.uint64(1 << (i % 64))
            filled.append(np.mean((words[i // 64] >> np.uint64(i % 64)) & np.uint64(1)))
        made.false_rate = np.array(filled) ** params.probes
        return made

    def positions(self, hashes: np.ndarray) -> list[np.ndarray]:
        mask = np.uint64(self.words.shape[1] - 1)
        return [((hashes >> np.uint64(21 * k)) & mask).astype(np.int64) for k in range(self.probes)]

    def counts(self, hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row and language, n-grams held, less the false positives expected among the rest; and all n-grams."""
        return self.corrected(*self.found(hashes, rows, n_rows))

    def found(self, hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row and language the n-grams that the filter holds, and all n-grams of the row."""
        places = self.positions(hashes)
        total = np.bincount(rows, minlength=n_rows).astype(float)
        held = np.zeros((n_rows, len(self.languages)))
        for w, slice_ in enumerate(self.words):
            masks = slice_[places[0]]
            for at in places[1:]:
                masks &= slice_[at]
            for i in range(64 * w, min(len(self.languages), 64 * w + 64)):
                bit = (masks >> np.uint64(i % 64)) & np.uint64(1)
                held[:, i] = np.bincount(rows, weights=bit, minlength=n_rows)
        return held, total

    def corrected(self, held: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        false = np.minimum(self.false_rate, 0.999)
        return np.clip((held - total[:, None] * false) / (1 - false), 0, None), total


def _count_grams(texts: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """n-grams per language and slice of rows; equal ones are added up before the shuffle."""
    def run(batches):
        for part in slices(batches, "text"):
            kinds = part.column("lang").dictionary_encode()
            for piece in long_pieces(part.column("text"), after_no_letter):
                hashes, rows, _ = letter_grams(piece, orders)
                codes = kinds.indices.to_numpy()[rows]
                for code, name in enumerate(kinds.dictionary.to_pylist()):
                    grams, counts = np.unique(hashes[codes == code], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)],
                        ["lang", "gram", "n"])

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(
    docs: DataFrame, usable: Column, params: LanguageModelParams = LanguageModelParams(),
    text: str = "text", lang: str = "lang", key: str = "doc_id",
) -> LanguageFilter:
    """Filters from rows that are ``usable`` and have a language; rows of a null id are drawn at random."""
    luck = F.when(docs[key].isNull(), F.rand(17)).otherwise(F.pmod(F.xxhash64(docs[key]), F.lit(1 << 30)) / float(1 << 30))
    rows = docs.filter(usable).select(
        docs[lang].cast("string").alias("lang"), docs[text].alias("text"), luck.alias("luck"))
    rows = rows.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageFilter.build({}, params)
    shares = F.create_map(*[F.lit(x) for name, n in sizes.items()
                            for x in (name, min(1.0, params.sample_per_language / n))])
    sample = rows.filter(F.col("luck") <= shares[F.col("lang")])

    counted = _count_grams(sample, params.orders).filter(F.col("n") >= params.min_count)
    rate = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    common = counted.withColumn("rate", rate).withColumn(
        "share", F.col("rate") / F.sum("rate").over(Window.partitionBy("gram")))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    chosen = (
        common.filter(F.col("share") >= params.min_share)
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= params.grams_per_language)
        .groupBy("lang").agg(F.sort_array(F.collect_list("gram")).alias("grams"))
    )
    grams = {name: np.zeros(0, np.int64) for name in sizes}
    grams.update({r["lang"]: np.array(r["grams"], np.int64) for r in chosen.collect()})
    return LanguageFilter.build(grams, params)


def predict(
    docs: DataFrame, model: LanguageFilter, text: str = "text", keep: list[str] | None = None, grams: bool = False,
) -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the share of the text's n-grams its language holds.

    ``grams`` adds ``n_grams``, their number: a text of one-letter words has none, and its score says nothing.
    """
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if grams:
        fields.append(T.StructField("n_grams", T.LongType()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        known = shared.value
        names = np.array(known.languages + [UNDECIDED], object)

        def made(part: pa.RecordBatch) -> list[pa.Array]:
            held, total = np.zeros((len(part), len(known.languages))), np.zeros(len(part))
            with_letter = np.zeros(len(part), bool)
            for piece in long_pieces(texts_of(part), after_no_letter):
                hashes, rows, letters = letter_grams(piece, known.orders)
                held_, total_ = known.found(hashes, rows, len(part))
                held, total, with_letter = held + held_, total + total_, with_letter | letters
            if not known.languages:
                best, score = np.zeros(len(part), int), np.zeros(len(part))
            else:
                held, total = known.corrected(held, total)
                best = np.argmax(held, axis=1)
                score = np.clip(held[np.arange(len(part)), best] / np.maximum(total, 1), 0, 1)
            best = np.where(with_letter, best, len(known.languages))
            out = [pa.array(names[best], pa.string()), pa.array(np.where(with_letter, score, 0.0))]
            return out + [pa.array(total.astype(np.int64))] * grams

        return made

    return append_columns(docs, text, fields, work, keep)
