"""Toxicity classifier whose score may not depend on which identity group a sentence names.

Logistic regression on the words a text has (hashed, lower case), fitted on labelled rows with a
penalty on counterfactuals: where a labelled text names an identity, the name is swapped for each
other name of its kind, and left out, and the squared change of the text's score is added to the loss. A neutral
mention then cannot carry weight of its own, however the labels happen to be spread. Corpora may name few
identities or none, so names are also put into a share of the sampled texts (``planted``), one of each kind drawn
by the text's words: those texts keep their labels, learn as any other, and are swapped likewise.

The fit takes a bounded sample: at most ``sample_per_class`` labelled rows of each class, drawn by
a hash of the id, and the ``words`` most telling words, besides the identity terms. Both bound what
one task and the driver hold. Sampled classes are weighted back to their share. Scores read whole
texts.

Nulls: rows without label, id or text teach nothing; a null text scores as an empty one, which gets
the bias alone. An id with several labels counts as toxic if one of them is. With no label, or one
class only, every score is that class's share (0.0 without any). A long text is read in stretches of a
megabyte, cut at white space. An empty table gives an empty one. Repeated rows stay, extra columns
are carried, input columns named like an output column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import (
    after_space, append_columns, long_pieces, mix, share_hash, slices, span_hashes, text_offsets, texts_of)

# Identity terms by kind; a term is swapped for the others of its kind.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("man", "woman"),
    ("men", "women"),
    ("american", "mexican", "chinese", "african", "european"),
    ("young", "old", "elderly"),
    ("blind", "deaf", "disabled"),
)


@dataclass(frozen=True)
class ToxicityParams:
    sample_per_class: int = 8_000
    words: int = 3_000
    min_rows: int = 5
    #: Standard deviations by which a word's toxic rows must differ from chance.
    min_surprise: float = 5.0
    shrink: float = 0.002
    counterfactual: float = 100.0
    #: Share of the sampled texts into which a name of a kind is put, for each kind.
    planted: float = 0.25
    steps: int = 400
    identities: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


@dataclass
class ToxicityModel:
    keys: np.ndarray
    weights: np.ndarray
    bias: float


_CHARS = np.zeros(256, np.uint8)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789'":
    _CHARS[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _CHARS[_c] = _c + 32
_CHARS[128:] = np.arange(128, 256)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column and the row of each."""
    offsets, data = text_offsets(column)
    chars = _CHARS[data]
    inside = np.concatenate([[False], chars > 0, [False]])
    # A word ends where its row does, whatever byte comes next.
    edge = np.zeros(len(inside), bool)
    edge[offsets + 1] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[1:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[2:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return span_hashes(chars, starts, ends), rows


def distinct(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's words once, in order."""
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def hashes_of(words: list[str]) -> np.ndarray:
    hashes, rows = word_hashes(pa.array(words, pa.string()))
    assert len(hashes) == len(words), "identity terms are single words"
    return hashes[np.argsort(rows)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_weights(
    cells: np.ndarray, columns: np.ndarray, labels: np.ndarray, weights: np.ndarray, n_columns: int,
    swaps: tuple[np.ndarray, np.ndarray, np.ndarray], params: ToxicityParams,
) -> tuple[np.ndarray, float]:
    """Minimise weighted log loss + shrink * |w|^2 + counterfactual * mean squared score change.

    ``cells`` and ``columns`` are the rows and words of the non-zero cells; ``swaps`` the row, the
    word that goes and the word that comes of each counterfactual, ``n_columns`` where none does.
    Accelerated gradient steps.
    """
    n = len(labels)
    total = weights.sum()
    w, bias = np.zeros(n_columns), 0.0
    ahead_w, ahead_b, momentum = w, bias, 1.0
    scale = np.maximum(np.bincount(columns, weights=weights[cells], minlength=n_columns) / total, 1e-3)
    row, gone, come = swaps
    per_row = np.bincount(cells, minlength=n).astype(float)
    curve = 0.25 * (per_row.mean() + 1) + params.shrink + 1.0
    rate = 1.0 / curve
    # Names curve the loss by their swaps too, so they take shorter steps; words do not wait for them.
    swapped = np.bincount(gone, minlength=n_columns + 1)[:n_columns] + np.bincount(come, minlength=n_columns + 1)[:n_columns]
    steep = scale + params.counterfactual / 4 * swapped / max(1, len(row)) / curve
    for _ in range(params.steps):
        margin = np.bincount(cells, weights=ahead_w[columns], minlength=n) + ahead_b
        score = _sigmoid(margin)
        error = weights * (score - labels) / total
        slope = np.bincount(columns, weights=error[cells], minlength=n_columns)
        slope_b = error.sum()
        slope = slope + params.shrink * scale * ahead_w
        if len(row):
            other = _sigmoid(margin[row] - ahead_w[gone] + np.append(ahead_w, 0.0)[come])
            change = 2 * params.counterfactual * (score[row] - other) / len(row)
            here, there = change * score[row] * (1 - score[row]), change * other * (1 - other)
            pull = np.bincount(row, weights=here - there, minlength=n)
            slope += np.bincount(columns, weights=pull[cells], minlength=n_columns)
            slope += np.bincount(gone, weights=there, minlength=n_columns)
            slope -= np.bincount(come, weights=there, minlength=n_columns + 1)[:n_columns]
            slope_b += pull.sum()
        # Rare words move further: the loss curves less along them.
        step_w = ahead_w - rate * slope / steep
        step_b = ahead_b - rate * slope_b
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead_w = step_w + (momentum - 1) / following * (step_w - w)
        ahead_b = step_b + (momentum - 1) / following * (step_b - bias)
        w, bias, momentum = step_w, step_b, following
    return w, float(bias)


def planted(
    cells: np.ndarray, columns: np.ndarray, rows: int, kinds: list[np.ndarray], share: float,
) -> tuple[np.ndarray, np.ndarray]:
    """``cells`` and ``columns`` with a name of each kind in a share of the rows, whatever their labels."""
    marks = np.bincount(cells, weights=columns + 1, minlength=rows).astype(np.uint64)
    for number, kind in enumerate(kinds):
        drawn = mix(marks * np.uint64(2 * len(kinds) + 1) + mix(np.arange(rows, dtype=np.uint64)) + np.uint64(number))
        chosen = np.flatnonzero((drawn >> np.uint64(40)).astype(float) < share * 2.0**24)
        named = kind[(drawn[chosen] % np.uint64(len(kind))).astype(np.int64)]
        cells, columns = np.concatenate([cells, chosen]), np.concatenate([columns, named])
    width = int(columns.max(initial=0)) + 1
    both = np.unique(cells * width + columns)
    return both // width, both % width


def counterfactuals(
    cells: np.ndarray, columns: np.ndarray, kinds: list[np.ndarray], n_columns: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, name that goes and name that comes, for every name of a row: each other one of its kind, and none.

    No name comes where the row has it already.
    """
    row, gone, come = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for kind in kinds:
        for name in kind:
            having = cells[columns == name]
            for other in [*kind[kind != name], n_columns]:
                row.append(having)
                gone.append(np.full(len(having), name))
                come.append(np.where(np.isin(having, cells[columns == other]), n_columns, other))
    return np.concatenate(row), np.concatenate(gone), np.concatenate(come)


def _known_words(rows: DataFrame, keys: np.ndarray) -> DataFrame:
    """``rows`` with those of their words that the model knows: ``keys`` bounds each list."""
    names = rows.columns

    def run(batches):
        for batch in batches:
            lists = batch.column("words")
            words = lists.flatten().to_numpy().view(np.uint64)
            place = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
            known = keys[place] == words
            begins = lists.offsets.to_numpy()
            offsets = np.concatenate([[0], np.cumsum(known)])[begins - begins[0]]
            kept = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(words[known].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("weight"), kept], names)

    return rows.mapInArrow(run, rows.schema)


def _row_words(texts: DataFrame) -> DataFrame:
    """doc_id, toxic, weight and the distinct word hashes of each row."""
    def run(batches):
        for part in slices(batches, "text"):
            hashes, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for piece in long_pieces(part.column("text"), after_space):
                more = word_hashes(piece)
                hashes, rows = distinct(np.concatenate([hashes, more[0]]), np.concatenate([rows, more[1]]))
            offsets = np.searchsorted(rows, np.arange(len(part) + 1)).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), part.column("weight"), words], ["toxic", "weight", "words"])

    return texts.select("toxic", "weight", "text").mapInArrow(run, "toxic int, weight double, words array<bigint>")


def learn(
    docs: DataFrame, labels: DataFrame, usable: Column, params: ToxicityParams = ToxicityParams(),
    store=lambda df, label: df, key: str = "doc_id", text: str = "text",
) -> ToxicityModel:
    """Model from the labelled rows that are ``usable``, a condition on the id column of ``labels``."""
    marked = (
        labels.filter(usable).filter(labels[key].isNotNull() & labels["toxic"].isNotNull())
        .groupBy(labels[key].alias("key__")).agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    nothing = np.zeros(0, np.uint64)
    if len(sizes) < 2:
        return ToxicityModel(nothing, np.zeros(0), 40.0 if sizes.get(1) else -40.0)
    shares = {c: min(1.0, params.sample_per_class / n) for c, n in sizes.items()}
    share = F.create_map(*[F.lit(x) for item in shares.items() for x in item])[F.col("toxic")]
    # Bounded by its parameter, whatever the size of the tables: two numbers for each of 16,000 ids or so.
    drawn = F.broadcast(marked.filter(share_hash("key__") <= share).withColumn("weight", 1.0 / share))
    texts = docs.select(docs[key].alias("key__"), docs[text].alias("text")).filter("text is not null").join(drawn, "key__")
    rows = store(_row_words(texts), "toxicity-words")

    seen = rows.select("toxic", F.explode("words").alias("word"))
    counted = seen.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    sums = rows.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).first()
    if not sums["n"] or not 0 < sums["bad"] < sums["n"]:
        return ToxicityModel(nothing, np.zeros(0), 40.0 if sums["bad"] else -40.0)
    overall = sums["bad"] / sums["n"]
    surprise = F.abs(F.col("bad") - F.col("n") * overall) / F.sqrt(F.col("n") * overall * (1 - overall) + 1.0)
    telling = (
        counted.filter(F.col("n") >= params.min_rows).filter(surprise >= params.min_surprise).orderBy(surprise.desc(), "word").limit(params.words)
        .select("word").collect()
    )
    kinds = [hashes_of(list(kind)) for kind in params.identities]
    keys = np.unique(np.concatenate([np.array([r["word"] for r in telling], np.int64).view(np.uint64), *kinds]))

    def fit(batches):
        cells, columns, toxic, weight, at = [], [], [], [], 0
        for batch in batches:
            lists = batch.column("words")
            offsets = lists.offsets.to_numpy()
            words = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            place = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
            hit = np.flatnonzero(keys[place] == words)
            cells.append(np.searchsorted(offsets, hit, "right") - 1 + at)
            columns.append(place[hit])
            toxic.append(batch.column("toxic").to_numpy())
            weight.append(batch.column("weight").to_numpy())
            at += len(batch)
        if not at:
            return
        places = [np.searchsorted(keys, kind) for kind in kinds]
        cells, columns = planted(np.concatenate(cells), np.concatenate(columns), at, places, params.planted)
        swaps = counterfactuals(cells, columns, places, len(keys))
        weights, bias = fit_weights(
            cells, columns, np.concatenate(toxic).astype(float), np.concatenate(weight), len(keys), swaps, params)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(keys, np.uint64(0)).view(np.int64)), pa.array(np.append(weights, bias)),
             pa.array(np.arange(len(keys) + 1) == len(keys))], ["word", "weight", "is_bias"])

    # One task fits the bounded sample.
    fitted = _known_words(rows, keys).repartition(1).sortWithinPartitions("words", "toxic", "weight").mapInArrow(
        fit, "word bigint, weight double, is_bias boolean").collect()
    bias = next(r["weight"] for r in fitted if r["is_bias"])
    found = [r for r in fitted if not r["is_bias"]]
    return ToxicityModel(
        np.array([r["word"] for r in found], np.int64).view(np.uint64), np.array([r["weight"] for r in found]), bias)


def score_texts(column: pa.Array, model: ToxicityModel) -> np.ndarray:
    """Scores of a text column: each known word a text has counts once."""
    n = len(column)
    if not len(model.keys):
        return _sigmoid(np.full(n, model.bias))
    likely = np.zeros(1 << 16, bool)
    likely[(model.keys >> np.uint64(48)).astype(np.int64)] = True
    cells = np.zeros(0, np.int64)
    for piece in long_pieces(column, after_space):
        hashes, rows = word_hashes(piece)
        maybe = np.flatnonzero(likely[(hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(model.keys, hashes[maybe]), len(model.keys) - 1)
        hit = model.keys[place] == hashes[maybe]
        cells = np.unique(np.concatenate([cells, rows[maybe[hit]] * len(model.keys) + place[hit]]))
    margin = np.bincount(cells // len(model.keys), weights=model.weights[cells % len(model.keys)], minlength=n)
    return _sigmoid(margin + model.bias)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        known = shared.value

        def made(part: pa.RecordBatch) -> list[pa.Array]:
            scores = score_texts(texts_of(part), known)
            return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

        return made

    return append_columns(docs, text, fields, work, keep)
