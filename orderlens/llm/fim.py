"""Fill-in-the-middle examples, cut by a piecewise-linear learned rank index.

A text's units are its lines (``[^\\n]*\\n|[^\\n]+``). The byte offsets at which units begin and end, of all texts
in hand, are the index's keys: segments, each a chord between two of them, predict the offset of every
rank to within ``slack`` bytes, and what the prediction misses by is stored in one signed byte a rank. A cut
at any rank is then its segment's prediction plus the stored residual, which is exact. Segments are found top
down: the whole is one chord, those that miss by more than ``slack`` are halved, all at once, until none does.

The two cuts of a document, whether it is changed at all and in which order its parts come are drawn from a
sha256 of the seed and its id, so that a rerun or a lost task gives the same examples.

Defined results: a null text is empty; empty texts and texts that hold a marker stay as they are (``plain``),
with null parts. A null id is drawn like the empty id. Equal ids draw equal numbers. Input columns named like
the new ones are replaced, all others are carried. An empty table gives none. A task holds a text, its
parts and its output, and about 60 bytes a unit, whatever the length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import append_columns, text_offsets, texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
NEWLINE = 10
#: Ranks fitted together.
FIT_RANKS = 1 << 18


@dataclass(frozen=True)
class FimParams:
    seed: int = 7
    #: Per cent of the texts that are changed, and of those that put the suffix first.
    rate: int = 100
    suffix_first: int = 50
    #: Most bytes by which a segment's prediction may miss; residuals are stored in one byte.
    slack: int = 127


class RankIndex:
    """Exact offsets by rank: error-bounded linear segments and a signed byte for each rank."""

    def __init__(self, offsets: np.ndarray, slack: int = 127):
        if not 0 <= slack <= 127:
            raise ValueError("residuals must fit a signed byte")
        self.residuals = np.zeros(len(offsets), np.int8)
        segments = [self._fit(offsets, at, min(at + FIT_RANKS, len(offsets)) - 1, slack) for at in range(0, len(offsets), FIT_RANKS)]
        self.segments = np.concatenate([np.zeros((0, 2), np.int64), *segments])
        self.starts, self.rises, self.runs = self._line(offsets, self.segments)

    def _fit(self, offsets: np.ndarray, first: int, last: int, slack: int) -> np.ndarray:
        """First and last rank of the segments that ``first`` to ``last`` need, in order."""
        done, todo = [], np.array([[first, last]], np.int64)
        while len(todo):
            # All ranks of the segments still open, one after another.
            sizes = todo[:, 1] - todo[:, 0] + 1
            begins = np.cumsum(sizes) - sizes
            steps = np.arange(sizes.sum()) - np.repeat(begins, sizes)
            ranks = steps + np.repeat(todo[:, 0], sizes)
            lines = [np.repeat(x, sizes) for x in self._line(offsets, todo)]
            missed = offsets[ranks] - self._chord(steps, *lines)
            fits = np.maximum.reduceat(np.abs(missed), begins) <= slack
            kept = np.repeat(fits, sizes)
            self.residuals[ranks[kept]] = missed[kept]
            done.append(todo[fits])
            # A chord through one rank or two neighbours misses none, so halves end there at the latest.
            low, high = todo[~fits].T
            half = (low + high) // 2
            todo = np.concatenate([np.column_stack([low, half]), np.column_stack([half + 1, high])])
        found = np.concatenate(done)
        return found[np.argsort(found[:, 0])]

    @staticmethod
    def _line(offsets: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, last = segments.T
        return offsets[first], offsets[last] - offsets[first], np.maximum(1, last - first)

    @staticmethod
    def _chord(steps, starts, rises, runs):
        return starts + steps * rises // runs

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.segments[:, 0], ranks, "right") - 1
        return self._chord(ranks - self.segments[at, 0], self.starts[at], self.rises[at], self.runs[at])

    def __getitem__(self, ranks: np.ndarray) -> np.ndarray:
        return self.predict(ranks) + self.residuals[ranks]


def boundaries(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which units of the texts begin or end, and where each text's first one is.

    Text i has those from ``firsts[i]`` up to but without ``firsts[i + 1]``: one more than its units.
    """
    starts, ends = offsets[:-1], offsets[1:]
    after = np.flatnonzero(data == NEWLINE) + 1
    # A newline's end is listed once, also where it ends the text; a rest without one ends with the text.
    ragged = (ends > starts) & (data[np.maximum(ends, 1) - 1] != NEWLINE) if len(data) else np.zeros(len(starts), bool)
    # The text that a newline ends in, not an empty one that begins there.
    owner = np.searchsorted(offsets, after, "left") - 1
    places = np.concatenate([starts, after, ends[ragged]])
    owners = np.concatenate([np.arange(len(starts)), owner, np.flatnonzero(ragged)])
    order = np.lexsort((places, owners))
    return places[order], np.searchsorted(owners[order], np.arange(len(starts) + 1))


def draws(key: Column, seed: int, count: int = 4) -> Column:
    """Unsigned 32-bit numbers from the hex sha256 of ``seed:key``, eight digits each."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)])


def holds_marker(data: np.ndarray) -> bool:
    text = data.tobytes()
    return any(m.encode() in text for m in MARKERS)


FIELDS = [
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("suffix_chars", T.LongType()), T.StructField("output", T.StringType()),
]


def _chars(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes, a stretch at a time."""
    return sum(int(np.count_nonzero((data[i: i + (1 << 20)] & 0xC0) != 0x80)) for i in range(0, len(data), 1 << 20))


def transform(
    docs: DataFrame, params: FimParams = FimParams(), key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the number of units, the form, the parts' code points and the output text."""
    names = [f.name for f in FIELDS]

    def work():
        def made(part: pa.RecordBatch) -> list[pa.Array]:
            offsets, data = text_offsets(texts_of(part))
            rows = len(part)
            h = part.column(part.num_columns - 2).flatten().to_numpy().reshape(rows, 4)
            places, firsts = boundaries(offsets, data)
            index = RankIndex(places, params.slack)
            n = np.diff(firsts) - 1
            one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
            begins, ends = index[firsts[:-1] + np.minimum(one, two)], index[firsts[:-1] + np.maximum(one, two)]
            out = {name: [] for name in names}
            for i in range(rows):
                text = data[offsets[i]: offsets[i + 1]]
                prefix, middle, suffix = np.split(text, [begins[i] - offsets[i], ends[i] - offsets[i]])
                plain = not len(text) or h[i, 2] % 100 >= params.rate or holds_marker(text)
                form = PLAIN if plain else SPM if h[i, 3] % 100 < params.suffix_first else PSM
                out["n"].append(int(n[i]))
                out["form"].append(form)
                for name, piece in zip(("prefix_chars", "middle_chars", "suffix_chars"), (prefix, middle, suffix)):
                    out[name].append(None if plain else _chars(piece))
                out["output"].append(arranged(form, text, prefix, middle, suffix))
            kinds = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in FIELDS]
            return [pa.array(out[name], kind) for name, kind in zip(names, kinds)]

        return made

    return append_columns(docs, text, FIELDS, work, keep, reads=(draws(docs[key], params.seed),))


def arranged(form: str, whole: np.ndarray, prefix: np.ndarray, middle: np.ndarray, suffix: np.ndarray) -> bytes:
    """The output's bytes."""
    p, s, m = (x.encode() for x in MARKERS)
    if form == PLAIN:
        return whole.tobytes()
    if form == PSM:
        return b"".join([p, prefix.tobytes(), s, suffix.tobytes(), m, middle.tobytes()])
    return b"".join([s, suffix.tobytes(), p, prefix.tobytes(), m, middle.tobytes()])


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. Parts hold no marker, nor can one arise where two parts meet."""
    def after(mark: str) -> Column:
        return F.element_at(F.split(output, mark, 2), -1)

    def between(mark: str, other: str) -> Column:
        return F.element_at(F.split(after(mark), other, 2), 1)

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
