"""Helpers the operators share: appended columns, text buffers of Arrow batches, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes worked on at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(0))


def share_hash(*columns: str) -> Column:
    """A number from 0 to 1 that depends on the row's values alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns of these names, in either case."""
    gone = {n.lower() for n in names}
    return df.select([df[c] for c in df.columns if c.lower() not in gone])


def text_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and UTF-8 bytes of a string column, null read as empty."""
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset: filled.offset + len(filled) + 1]
    raw = filled.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]: offsets[-1]]


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, or one text."""
    for batch in batches:
        offsets, _ = text_offsets(batch.column(text))
        start = 0
        while start < len(batch):
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def stretches(data: np.ndarray, places: Callable[[np.ndarray], np.ndarray], limit: int = 0) -> Iterator[tuple[int, int]]:
    """Starts and ends of stretches of about ``limit`` bytes of one long text.

    ``places`` gives the indexes of a window before which the text may be cut, 0 never among them. Where
    there is none for a while, the stretch is longer.
    """
    limit = limit or SLICE_BYTES
    at = 0
    while len(data) - at > limit:
        found = places(data[at + limit // 2: at + limit])
        end = at + limit // 2 + int(found[-1]) if len(found) else len(data)
        look = at + limit - 1
        while not len(found) and look < len(data):
            found = places(data[look: look + limit])
            end = look + int(found[0]) if len(found) else len(data)
            look += limit - 1
        yield at, end
        at = end
    if at < len(data) or not len(data):
        yield at, len(data)


def after_space(window: np.ndarray) -> np.ndarray:
    """Places after white space."""
    before = window[:-1]
    return np.flatnonzero((before == 32) | ((before >= 9) & (before <= 13))) + 1


def long_pieces(column: pa.Array, places: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.Array]:
    """A slice's texts, or the stretches of its only one, a column of one row each."""
    offsets, data = text_offsets(column)
    if len(column) != 1 or len(data) <= SLICE_BYTES:
        yield column
        return
    for start, end in stretches(data, places):
        yield pa.array([data[start:end].tobytes()], pa.large_binary())


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of the frames is called so, in either case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(part: pa.RecordBatch) -> pa.Array:
    """The text of a slice that ``append_columns`` passes on: its last column."""
    return part.column(part.num_columns - 1)


def append_columns(
    df: DataFrame, text: str, fields: list[T.StructField],
    work: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], keep: list[str] | None = None,
    reads: tuple[Column, ...] = (),
) -> DataFrame:
    """``df`` with the columns that ``work()`` makes from slices of it; input columns of their names go.

    ``keep`` names the input columns to carry over. The text itself may be left out that way. A slice holds
    the carried columns, then those of ``reads``, then the text.
    """
    carried = without(df, [f.name for f in fields])
    kept = [c for c in carried.columns if keep is None or c in keep]
    # Read under names of their own, so that the text can also be among the carried or the new columns.
    own = free_name("text", carried)
    more = [free_name(f"read{i}", carried) for i in range(len(reads))]
    source = df.select(
        *[df[c] for c in kept], *[r.alias(n) for r, n in zip(reads, more)], df[text].cast("string").alias(own))
    schema = T.StructType([source.schema[c] for c in kept] + fields)
    names = schema.names

    def run(batches):
        made = work()
        for part in slices(batches, own):
            yield pa.RecordBatch.from_arrays(part.columns[: len(kept)] + made(part), names)

    return source.mapInArrow(run, schema)


BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base):
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(BASE), powers(_INVERSE)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``size`` of them."""
    return _powers(1 << max(12, int(size - 1).bit_length()))


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes over all bits."""
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(29))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of codes[start:end], from one running sum over all codes."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])
