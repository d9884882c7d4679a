"""SentencePiece encoding and decoding by a Viterbi search that numpy runs over many words at once.

A text gets the model's dummy prefix and its spaces become the space mark; no piece of the model
joins a space mark to something before it, so the text is searched word by word (a run of spaces and
what follows it). The words a task has not met yet are sorted by length, and those of one length
advance together: hashes of all their substrings probe the sorted hashes of the pieces of that
length, each end position takes the best total over the pieces that end there, and the choice is
kept for walking back. Equal totals go to the longer last piece. A character that no piece covers
costs less than any piece and is written as the pieces of its UTF-8 bytes, so decoding restores it.

The result is the segmentation with the highest sum of piece scores (``log_probabilities`` says what
they are for a merge model). Null texts give
null ids; an empty text gives no ids; repeated rows stay; extra columns are carried, and input
columns named like an output column are replaced. The space mark itself (U+2581) in a text reads
as a space, as in the model's own normalisation.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderlens.llm.common import SLICE_BYTES, append_columns, long_pieces, mix, powers, text_offsets, texts_of
from orderlens.llm.word_ids import WordIds, gathered, in_order, per_row

MARK = "▁"
#: Code points of the words searched at once, and end positions per block of probes.
LANES, WINDOW = 1 << 17, 1 << 12
NONE = -np.inf


def _prefix_sums(codes: np.ndarray) -> np.ndarray:
    sums = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(codes.shape[1])[0][: codes.shape[1]],
              axis=1, out=sums[:, 1:])
    return sums


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1)


def log_probabilities(scores: dict[int, float]) -> dict[int, float]:
    """Scores a sum of which means something.

    A unigram model's scores are log probabilities and stay. A merge model's are places in its merge
    order, 0, -1, -2 and so on; by Zipf's law the piece at place r has a probability in proportion to
    1 / (r + 1), which is what its score becomes. Scores below all places keep their order below those.
    """
    places = [s for s in scores.values() if s > -len(scores) - 1]
    if not places or len(set(places)) < len(places) or any(s > 0 or s != int(s) for s in places):
        return scores
    whole = np.log(np.sum(1.0 / (1.0 - np.array(places))))
    return {i: float(-np.log(1.0 - s) - whole) for i, s in scores.items()}


class Vocabulary:
    """Pieces of a model by length: sorted hashes, ids and scores."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(texts[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        plain = [i for i in range(size)
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = log_probabilities({i: model.get_score(i) for i in plain})
        self.unknown = min(scores.values(), default=0.0) - 10.0
        self.unk_id = model.unk_id()
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({len(texts[i]) for i in plain}):
            ids = np.array([i for i in plain if len(texts[i]) == length], np.int32)
            keys = mix(_prefix_sums(_codes([texts[i] for i in ids]))[:, -1])
            order = np.argsort(keys)
            self.by_length[length] = (
                keys[order], ids[order], np.array([scores[i] for i in ids])[order])
        self.longest = max(self.by_length, default=1)
        self.bytes_of = [b""] * size
        for i in plain:
            self.bytes_of[i] = texts[i].encode()
        for value, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([value])
        # What each id gives back, in one array.
        spaced = [b.replace(MARK.encode(), b" ") for b in self.bytes_of]
        self.flat = np.frombuffer(b"".join(spaced), np.uint8)
        self.sizes = np.array([len(b) for b in spaced], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes

    def probe(self, sums: np.ndarray, length: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the substrings of ``length`` that end at first..last-1; NONE and -1 where no piece."""
        keys, ids, scores = self.by_length[length]
        down = powers(sums.shape[1])[1][first - length: last - length]
        wanted = mix((sums[:, first:last] - sums[:, first - length: last - length]) * down)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        return np.where(hit, scores[at], NONE), np.where(hit, ids[at], -1)

    def search(self, words: list[str]) -> list[bytes]:
        """Ids, as 32-bit bytes, of words that are all of one length."""
        codes = _codes(words)
        n, size = codes.shape
        sums = _prefix_sums(codes)
        best = np.full((n, size + 1), NONE)
        best[:, 0] = 0
        taken = np.zeros((n, size + 1), np.int8 if self.longest < 128 else np.int32)
        piece = np.full((n, size + 1), -1, np.int32)
        lanes = np.arange(n)
        for start in range(1, size + 1, WINDOW):
            stop = min(size + 1, start + WINDOW)
            lengths = [m for m in range(min(self.longest, stop - 1), 0, -1) if m == 1 or m in self.by_length]
            found_scores = np.full((len(lengths), stop - start, n), NONE)
            found_ids = np.full((len(lengths), stop - start, n), -1, np.int32)
            for k, m in enumerate(lengths):
                first = max(start, m)
                if m in self.by_length and first < stop:
                    scores, ids = self.probe(sums, m, first, stop)
                    found_scores[k, first - start:], found_ids[k, first - start:] = scores.T, ids.T
                if m == 1:
                    found_scores[k][found_ids[k] < 0] = self.unknown
            steps = np.array(lengths)
            for end in range(start, stop):
                usable = int(np.searchsorted(-steps, -end))
                here = best[:, end - steps[usable:]].T + found_scores[usable:, end - start]
                pick = np.argmax(here, axis=0)
                best[:, end] = here[pick, lanes]
                taken[:, end] = steps[usable + pick]
                piece[:, end] = found_ids[usable + pick, end - start, lanes]
        return self._walk_back(words, taken, piece)

    def _walk_back(self, words: list[str], taken: np.ndarray, piece: np.ndarray) -> list[bytes]:
        n, size = len(words), taken.shape[1] - 1
        chosen = np.zeros((n, size), np.int32)
        count = np.zeros(n, np.int64)
        where = np.full(n, size)
        covered = np.ones(n, bool)
        live = np.arange(n)
        while len(live):
            ids = piece[live, where[live]]
            count[live] += 1
            chosen[live, size - count[live]] = ids
            covered[live] &= ids >= 0
            where[live] -= taken[live, where[live]]
            live = live[where[live] > 0]
        out = []
        for i, word in enumerate(words):
            ids = chosen[i, size - count[i]:]
            out.append(ids.astype("<i4").tobytes() if covered[i] else self._spell(word, ids))
        return out

    def _spell(self, word: str, ids: np.ndarray) -> bytes:
        """Replace what no piece covers by the pieces of its bytes."""
        out, at = [], 0
        for i in ids.tolist():
            if i >= 0:
                out.append(i)
                at += len(self.bytes_of[i].decode())
            else:
                raw = word[at].encode("utf-8", "surrogatepass")
                out.extend([self.byte_ids[b] for b in raw] if self.byte_ids else [self.unk_id])
                at += 1
        return np.array(out, "<i4").tobytes()

    def search_all(self, words: list[str]) -> list[bytes]:
        """Ids of words of any lengths, those of one length together."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        bounds = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, bounds):
            if not len(group):
                continue
            per = max(1, LANES // int(lengths[group[0]]))
            for at in range(0, len(group), per):
                part = group[at: at + per].tolist()
                for i, ids in zip(part, self.search([words[i] for i in part])):
                    out[i] = ids
        return out


def normalise(text: str) -> str:
    return MARK + text.replace(" ", MARK)


def before_spaces(window: np.ndarray) -> np.ndarray:
    """Places before a run of spaces, where a word begins."""
    return np.flatnonzero((window[1:] == 32) & (window[:-1] != 32)) + 1


def cut(data: np.ndarray, offsets: np.ndarray, breaks: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts, each a run of spaces and what follows it.

    With ``breaks`` a line feed is a word of its own: no piece holds one, so no piece is cut.
    """
    begin = np.zeros(len(data) + 1, bool)
    space = data == 32
    begin[:-1] = space
    begin[1:-1] &= ~space[:-1]
    if breaks:
        feed = np.flatnonzero(data == 10)
        begin[feed] = True
        begin[feed + 1] = True
    begin[offsets] = True
    starts = np.flatnonzero(begin[:-1])
    return starts, np.append(starts[1:], len(data))


@lru_cache(maxsize=2)
def word_ids(model_path: str) -> tuple[WordIds, bool, Vocabulary]:
    """The words this worker knows the ids of, whether line feeds part words, and the pieces."""
    vocabulary = Vocabulary(model_path)
    breaks = not any(b"\n" in vocabulary.bytes_of[i] for _, ids, _ in vocabulary.by_length.values() for i in ids)

    def encode(words: list[bytes]):
        texts = [w.decode("utf-8", "replace").replace(" ", MARK) for w in words]
        return in_order([np.frombuffer(ids, "<i4") for ids in vocabulary.search_all(texts)])

    return WordIds(encode), breaks, vocabulary


def encode_rows(column: pa.Array, model_path: str) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Ids of all texts one after another, the number of each text's, and the texts' crc32."""
    known, breaks, _ = word_ids(model_path)
    texts = [t.replace(MARK.encode(), b" ") for t in pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()]
    # The model puts a space before each text that is not empty.
    marked = pa.array([b" " + t if t else t for t in texts], pa.large_binary())
    ids, counts = [], np.zeros(len(column), np.int64)
    for piece in long_pieces(marked, before_spaces):
        offsets, data = text_offsets(piece)
        starts, ends = cut(data, offsets, breaks)
        made, sizes = known(data, starts, ends)
        ids.append(made)
        counts += per_row(sizes, starts, offsets)
    return np.concatenate(ids), counts, [zlib.crc32(t) for t in texts]


def decode_rows(
    ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary, first: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after another, without the spaces the model puts first, and their offsets.

    Without ``first`` the ids are no row's first ones, and no space goes.
    """
    sizes = vocabulary.sizes[ids]
    data = gathered(vocabulary.flat, vocabulary.places[ids], sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    if not first:
        return data, ends
    return np.delete(data, ends[:-1][counts > 0]), ends - np.concatenate([[0], np.cumsum(counts > 0)])


def decoded_digests(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> tuple[list[int], list[int]]:
    """Code points and crc32 of each row's decoded text; a long row is decoded in runs of its ids."""
    if len(counts) != 1 or len(ids) <= SLICE_BYTES:
        data, ends = decode_rows(ids, counts, vocabulary)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return np.diff(points[ends]).tolist(), [zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    chars, crc = 0, 0
    for at in range(0, len(ids), SLICE_BYTES):
        part = ids[at: at + SLICE_BYTES]
        data, _ = decode_rows(part, np.array([len(part)]), vocabulary, first=at == 0)
        chars, crc = chars + int(np.count_nonzero((data & 0xC0) != 0x80)), zlib.crc32(data, crc)
    return [chars], [crc]


def encode(
    docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None, decoded: bool = False,
) -> DataFrame:
    """Adds ``ids`` (array of int) and ``text_crc32``, the crc32 of the text the ids stand for.

    With ``decoded`` the ids are also decoded on the spot, which adds ``decoded_chars`` and
    ``decoded_crc32`` of the text they give back.
    """
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("text_crc32", T.LongType())]
    if decoded:
        fields += [T.StructField("decoded_chars", T.LongType()), T.StructField("decoded_crc32", T.LongType())]

    def made(part: pa.RecordBatch) -> list[pa.Array]:
        column = texts_of(part)
        null = column.is_null()
        ids, counts, crcs = encode_rows(column, model_path)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        out = [crcs]
        if decoded:
            out += decoded_digests(ids, counts, word_ids(model_path)[2])
        nothing = pa.scalar(None, pa.int64())
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=null),
                *[pc.if_else(null, nothing, pa.array(o, pa.int64())) for o in out]]

    return append_columns(docs, text, fields, lambda: made, keep)


def decode(coded: DataFrame, model_path: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``; null ids give null, bytes that are no UTF-8 a replacement mark."""
    kept = [c for c in coded.columns if c.lower() != "decoded"]
    schema = T.StructType([coded.schema[c] for c in kept] + [T.StructField("decoded", T.StringType())])

    def run(batches):
        vocabulary = word_ids(model_path)[2]
        for batch in batches:
            lists = batch.column("ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            data, ends = decode_rows(lists.flatten().to_numpy(), counts, vocabulary)
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") if known else None
                     for a, b, known in zip(ends[:-1], ends[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(texts, pa.string())], schema.names)

    return coded.mapInArrow(run, schema)
