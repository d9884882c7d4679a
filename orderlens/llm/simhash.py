"""SimHash fingerprints and links between those that differ in few bits, by a Gray-order index.

Fingerprints: words are what lies between ASCII white space, A-Z in lower case; every run of
``shingle`` words, repeats included, is hashed with XXH64, and a bit of the fingerprint is set if
over half the hashes set it. A text with fewer words is one shingle; one without words, or a null
one, has fingerprint zero and links like any other.

Links: equal fingerprints are reduced to one first. Two that differ in at most ``distance`` bits
agree on one of ``distance + 1`` blocks of the 64 bits, and the rest of their bits agree on one of
as many sub-blocks, so each fingerprint goes to (distance + 1)^2 buckets of equal block and
sub-block, and each linked pair meets in one at least. A bucket with very many fingerprints is cut in
the same way by the bits it leaves free, so no task takes an unbounded one. Within a bucket the fingerprints are sorted
by Gray rank, which puts those with common bits side by side. Runs of them become the nodes of a
tree that holds the bits all below it share, each level only those its parent has not. A search
goes down from the top with the bits in which it differs so far, drops a node and all below it when
they exceed the distance, and takes a whole node when even its free bits could not exceed it.

Of the links a bucket yields only a spanning forest leaves the task; components are then found over
all buckets. Rows with a null id get a component like any other (its smallest id that is not null).
Repeated rows stay; extra columns are carried, columns named like an output column are replaced. A long text is
read in stretches of a megabyte, cut at white space. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import after_space, append_columns, free_name, stretches, texts_of, without
from orderlens.llm.components import components
from orderlens.session import pin

BITS, SEED = 64, 42
#: Children of a tree node, and searches that go down together.
FANOUT, SEARCHES = 16, 4096
#: Fingerprints from which a bucket is cut further, unless it has only so many free bits; kinds of buckets at most.
LARGE, FEW_BITS, KINDS = 1 << 16, 21, 1 << 12


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 hashes of all shingles of a text; a long one is read in stretches that share words."""
    carried, some = [], False
    for start, end in stretches(np.frombuffer(text, np.uint8), after_space):
        words = carried + text[start:end].lower().split()
        if len(words) >= shingle:
            yield hashes_of_words(words, shingle)
            some = True
        carried = words[max(0, len(words) - shingle + 1):]
    if not some:
        yield hashes_of_words(carried, len(carried))


def hashes_of_words(words: list[bytes], shingle: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    cut = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in cut], np.uint64)


def majority_bits(runs: Iterable[np.ndarray]) -> int:
    """Bits that over half of the hashes of all runs have."""
    votes, total = np.zeros(BITS, np.int64), 0
    for hashes in runs:
        total += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at: at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``fp``, the fingerprint as a signed 64-bit integer."""
    def work():
        def made(part: pa.RecordBatch) -> list[pa.Array]:
            texts = pc.fill_null(texts_of(part).cast(pa.binary()), b"").to_pylist()
            marks = np.array([majority_bits(shingle_hashes(t, shingle)) for t in texts], np.uint64)
            return [pa.array(marks.view(np.int64))]

        return made

    return append_columns(docs, text, [T.StructField("fp", T.LongType())], work, keep)


def equal_bits(distance: int, levels: int) -> list[int]:
    """Masks of the bits that agree in each kind of bucket, (distance + 1)**levels kinds.

    Each level cuts the bits that a kind leaves free into distance + 1 blocks; kind q becomes the
    kinds from q * (distance + 1) on.
    """
    kinds = [0]
    for _ in range(levels):
        kinds = [held | block for held in kinds for block in _blocks(held, distance)]
    return kinds


def _blocks(held: int, distance: int) -> list[int]:
    free = [b for b in range(BITS) if not held >> b & 1]
    edges = np.linspace(0, len(free), distance + 2).astype(int)
    return [sum(1 << b for b in free[a:e]) for a, e in zip(edges[:-1], edges[1:])]


def in_buckets(marks: DataFrame, distance: int, level: int) -> DataFrame:
    """fp, kind and bucket: each row of ``marks`` (fp, kind of the level before) in its buckets of ``level``."""
    # Signed, as the fingerprints are.
    masks = F.array(*[F.lit(m - (m >> 63 << 64)).cast("bigint") for m in equal_bits(distance, level)])
    below = F.sequence(F.col("kind") * (distance + 1), F.col("kind") * (distance + 1) + distance)
    spread = marks.select("fp", F.explode(below).alias("kind"))
    held = F.col("fp").bitwiseAND(F.element_at(masks, F.col("kind") + 1))
    return spread.withColumn("bucket", F.xxhash64("kind", held))


def split_buckets(marks: DataFrame, distance: int, most: int) -> DataFrame:
    """fp and bucket of all fingerprints; buckets of more than ``most`` are cut by further equal bits.

    Rows are counted in cells of many buckets, so few numbers are shuffled; an eighth of ``most`` is
    expected in a cell, and all buckets of a cell that holds more than ``most`` are cut.

    Two fingerprints of a bucket differ only in its free bits, so the same argument holds again: they
    agree on one of distance + 1 blocks of those. It ends where a bucket has so few free bits that
    it is bounded by them (after two more levels for a distance of 3), or KINDS is reached.
    """
    level = 2
    spread = in_buckets(in_buckets(marks.withColumn("kind", F.lit(0)), distance, 1), distance, 2)
    rows = marks.count()
    done = []
    while (
        max(BITS - m.bit_count() for m in equal_bits(distance, level)) > FEW_BITS
        and (distance + 1) ** (level + 1) <= KINDS
    ):
        cells = 4096 + 8 * rows * (distance + 1) ** level // most
        dealt = spread.withColumn("cell", F.pmod("bucket", F.lit(cells)))
        large = pin(dealt.groupBy("cell").count().filter(F.col("count") > most).select("cell"), "large-cells")
        if large.isEmpty():
            break
        done.append(dealt.join(large, "cell", "left_anti").select("fp", "bucket"))
        level += 1
        spread = in_buckets(dealt.join(large, "cell", "left_semi"), distance, level)
    whole = spread.select("fp", "bucket")
    for part in done:
        whole = whole.unionAll(part)
    return whole


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the order in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Tree over the fingerprints of one bucket, sorted by Gray rank.

    levels[0] are the fingerprints themselves, the last level the root. ``value`` and ``shared``
    hold the bits that all below a node have in common and its parent has not; ``free`` counts the
    bits in which those below it may differ.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes))]
        ones, some = [self.codes], [self.codes]
        while len(ones[-1]) > 1:
            cuts = np.arange(0, len(ones[-1]), FANOUT)
            ones.append(np.bitwise_and.reduceat(ones[-1], cuts))
            some.append(np.bitwise_or.reduceat(some[-1], cuts))
        full = [~(a ^ o) for a, o in zip(ones, some)]
        self.levels = []
        for k, (value, mask) in enumerate(zip(ones, full)):
            above = full[k + 1][np.arange(len(mask)) // FANOUT] if k + 1 < len(full) else np.uint64(0)
            shared = mask & ~above
            self.levels.append((value & shared, shared, BITS - np.bitwise_count(mask).astype(np.int64)))

    def search(self, first: int, last: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that join what the links of the fingerprints first..last-1 join.

        A node that is taken whole gives one link to its first fingerprint, and ties that one to the
        others below it, which are all linked to the searcher.
        """
        who, node = np.arange(first, last), np.zeros(last - first, np.int64)
        spent = np.zeros(last - first, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(len(self.levels) - 1, -1, -1):
            value, shared, free = self.levels[k]
            spent = spent + np.bitwise_count((self.codes[who] & shared[node]) ^ value[node])
            # Links are mutual: what lies before the searcher has been met from the other side.
            span = FANOUT**k
            near = (spent <= distance) & ((node + 1) * span > who)
            whole = near & (spent + free[node] <= distance)
            found.append((who[whole], node[whole] * span))
            if k and whole.any():
                taken = np.unique(node[whole])
                below = (taken[:, None] * span + np.arange(1, span)).ravel()
                head = np.repeat(taken * span, span - 1)
                found.append((head[below < len(self.codes)], below[below < len(self.codes)]))
            go = near & ~whole
            if k == 0 or not go.any():
                break
            children = node[go][:, None] * FANOUT + np.arange(FANOUT)
            inside = children < len(self.levels[k - 1][0])
            who, spent = np.repeat(who[go], FANOUT)[inside.ravel()], np.repeat(spent[go], FANOUT)[inside.ravel()]
            node = children[inside]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def join_roots(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Union of the sets that ``parent`` describes along the pairs; roots are the smallest members."""
    while len(left):
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            return parent
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        parent = _roots(parent)
    return parent


def bucket_forest(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among distinct fingerprints."""
    index = GrayIndex(codes)
    parent = np.arange(len(codes))
    for first in range(0, len(codes), SEARCHES):
        parent = join_roots(parent, *index.search(first, min(len(codes), first + SEARCHES), distance))
    linked = np.flatnonzero(parent != np.arange(len(codes)))
    return index.codes[linked], index.codes[parent[linked]]


def _pair_links(codes: np.ndarray, starts: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of two have nothing to prune; all of them are compared at once."""
    left, right = codes[starts], codes[starts + 1]
    near = np.bitwise_count(left ^ right) <= distance
    return left[near], right[near]


def links(marks: DataFrame, distance: int, most: int = LARGE) -> DataFrame:
    """Links between the distinct fingerprints in column ``fp``, a forest per bucket: columns a, b."""
    spread = split_buckets(marks.select("fp"), distance, most)
    sorted_ = spread.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches):
        rest_keys, rest_codes = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def forests(keys, codes):
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
            sizes = np.diff(np.append(starts, len(keys)))
            left, right = _pair_links(codes, starts[sizes == 2], distance)
            lefts, rights = [left], [right]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                left, right = bucket_forest(codes[start: start + size], distance)
                lefts.append(left)
                rights.append(right)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(lefts).view(np.int64)), pa.array(np.concatenate(rights).view(np.int64))],
                ["a", "b"])

        for batch in batches:
            keys = np.concatenate([rest_keys, batch.column("bucket").to_numpy()])
            codes = np.concatenate([rest_codes, batch.column("fp").to_numpy().view(np.uint64)])
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            yield forests(keys[:last], codes[:last])
            rest_keys, rest_codes = keys[last:], codes[last:]
        if len(rest_keys):
            yield forests(rest_keys, rest_codes)

    return sorted_.select("bucket", "fp").mapInArrow(run, "a bigint, b bigint")


def group(marked: DataFrame, distance: int, key: str = "doc_id") -> DataFrame:
    """``key``, ``fp``, ``component_id`` (smallest id reachable) and ``root`` (its fingerprint) per row of ``marked``."""
    distinct = pin(marked.groupBy("fp").agg(F.min(key).alias("first")), "fingerprints")
    joined = components(links(distinct, distance))
    rooted = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = pin(rooted.join(smallest, "root").select(F.col("fp").alias("fp__"), "root", "component_id"), "roots")
    rows = without(marked, ["root", "component_id"])
    return rows.join(labelled, rows["fp"] == labelled["fp__"]).drop("fp__")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, fp, component_id and root."""
    narrow = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    marked = pin(fingerprints(narrow, shingle, keep=["doc_id"]), "marks")
    return group(marked, distance)


def distinct_documents(docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each group: that of the smallest id, of repeated ids the one with the smallest row hash.

    Rows that are equal in every column count as one.
    """
    narrow = docs.select(
        docs[key].alias("doc_id"), F.xxhash64(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    marked = pin(fingerprints(narrow, shingle, keep=["doc_id", "row"]), "marks")
    grouped = pin(group(marked, distance).select("root", "doc_id", "row"), "groups")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    own, kept_id, kept_row = (free_name(n, docs) for n in ("own_row", "kept_id", "kept_row"))
    kept = grouped.groupBy("root").agg(F.min(order).alias("one")).select(
        F.col("one.doc_id").alias(kept_id), F.col("one.row").alias(kept_row))
    rows = docs.withColumn(own, F.xxhash64(*[docs[c] for c in docs.columns]))
    chosen = rows.join(kept, rows[key].eqNullSafe(kept[kept_id]) & (rows[own] == kept[kept_row]), "left_semi")
    if grouped.groupBy("doc_id", "row").count().filter("count > 1").isEmpty():
        return chosen.drop(own)
    return chosen.dropDuplicates([key, own]).drop(own)
