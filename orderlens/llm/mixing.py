"""Mixing sources to target weights along a curriculum whose weights change over the training.

Each source has a schedule: its share of the words that are being trained on at time t, from 0 to 1,
piecewise linear. The integral of the schedule is the source's total weight, and its running
integral, scaled to the source's target, is the cumulative demand D(t). A source's documents lie one
after another along its own line of words, in an order fixed by a digest of their ids, epoch after
epoch up to the target; the copy whose middle lies at word x is trained on at the time t with
D(t) = x, found by inverting the integral of its piece. Sorting all copies by that time gives the
training order.

Targets: all sources together get ``share`` of all words, split by weight. No target may pass
``most`` times its source; what a source cannot take goes to the others by weight, until none is
above. That is the level L with sum(min(most * size, L * weight)) = total, found in one pass over the
sources in the order in which they fill up.

Prefix sums are cut by digest: rows are added up per (source, first digits of the digest), those
sums over the source, and the rows within their piece, so a source with most of the rows is spread
over many tasks. A digest of many rows (null or repeated ids) is cut further by size and row hash. A copy is taken if its middle lies before the target, so a source ends within one
document of it. Everything depends on values alone, so reruns agree.

Nulls: a null text has no words and is never trained on; a null id sorts first; a null source is a
source, the last one. Repeated ids stay, each row with a plan of its own; they are ordered by (digest,
id, size, hash of the whole row). An empty table gives an empty mix. Extra columns are carried, columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import free_name, without
from orderlens.session import pin

WORD = r"[^\x20\x09-\x0D]+"
#: Digits of the digest that cut a source: 16^3 pieces.
PIECE_DIGITS = 3
#: Rows of one digest beyond which it is cut further.
CROWDED = 65_536
#: Times and relative weights of the default schedules; sources take them in turn. Their integrals are 1.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Per source (a row of ``sizes``: source, source_size): place, weight and target.

    The windows run over one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("source").asc_nulls_last())
    listed = sizes.withColumn("place", (F.row_number().over(order) - 1) % F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("place") + 1)
    capped = listed.withColumns({"weight": weight.cast("double"), "cap": F.lit(float(most)) * F.col("source_size")})
    fills = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    leveled = capped.withColumn("level", level)
    # The first source that the level of those before it does not fill up sets the level.
    open_ = F.col("level") * F.col("weight") <= F.col("cap")
    first = F.min(F.when(open_, F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"),
                                         F.col("level")))).over(everything)
    return leveled.withColumn("final", first["level"]).select(
        "source", "source_size", "place", "weight",
        F.coalesce(F.least(F.col("cap"), F.col("final") * F.col("weight")), F.col("cap")).alias("target"))


def row_hash(docs: DataFrame) -> Column:
    """Hash of a whole row; nulls count by their place, maps by their text."""
    cells = [F.to_json(F.struct(docs[c])) if "map<" in kind else docs[c] for c, kind in docs.dtypes]
    return F.xxhash64(*cells, *[docs[c].isNull() for c in docs.columns])


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """id, source, size, digest and row hash of each row."""
    return docs.select(
        docs[key].alias("doc_id"), docs[source].alias("source"), word_count(docs[text]).alias("size"),
        F.md5(F.coalesce(docs[key].cast("string"), F.lit("")).cast("binary")).alias("digest"),
        row_hash(docs).alias("row"))


def with_pieces(rows: DataFrame, crowded: int) -> DataFrame:
    """``rows`` with the ``piece`` that cuts a source, in the order of (digest, id, size, row).

    A piece is the digest's first digits. A digest of more than ``crowded`` rows, those of null or
    repeated ids, is cut by size and row hash, and so lies between two parts of its digits' piece.
    """
    start = F.substring("digest", 1, PIECE_DIGITS)
    many = rows.groupBy("digest").count().filter(F.col("count") > crowded)
    found = pin(many.groupBy(start.alias("start__")).agg(F.collect_list("digest").alias("many__")), "mix-crowded")
    if found.isEmpty():
        return rows.withColumn("piece", start)
    beside = rows.join(found, start == found["start__"], "left")
    inner = F.concat(
        "digest", F.when(F.col("doc_id").isNull(), "0").otherwise("1"), F.lpad(F.hex("size"), 16, "0"),
        F.hex(F.pmod("row", F.lit(16))))
    before = F.array_max(F.filter("many__", lambda d: d < F.col("digest")))
    piece = F.when(F.array_contains("many__", F.col("digest")), inner).when(
        before.isNotNull(), F.concat(before, F.lit("~"))).otherwise(start)
    return beside.withColumn("piece", piece).drop("start__", "many__")


def plan(
    rows: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    schedules=SCHEDULES, crowded: int = CROWDED,
) -> DataFrame:
    """``rows`` (doc_id, source, size, digest, row, ...) with source_size, target, copies, taken and the first copy's position."""
    cut = with_pieces(rows, crowded)
    pieces = pin(cut.groupBy("source", "piece").agg(F.sum("size").alias("words")), "mix-pieces")
    ahead = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("source", "piece", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    sizes = pieces.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    starts = pin(
        offsets.join(targets, offsets["source"].eqNullSafe(targets["source"])).drop(targets["source"]), "mix-starts"
    ).select(F.col("source").alias("source__"), F.col("piece").alias("piece__"), "offset", "source_size", "place", "target")

    inside = Window.partitionBy("source", "piece").orderBy(
        "digest", "doc_id", "size", F.pmod("row", F.lit(16)), "row").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = cut.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(
        starts, placed["source"].eqNullSafe(F.col("source__")) & (F.col("piece") == F.col("piece__")))
    middle = F.col("offset") + F.col("ahead") + F.col("size") / F.lit(2.0)
    copies = F.when(
        (F.col("size") > 0) & (middle < F.col("target")),
        F.ceil(F.try_divide(F.col("target") - middle, F.col("source_size")))).otherwise(F.lit(0))
    return (
        joined.withColumn("middle", middle)
        .withColumn("copies", copies.cast("bigint"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn("position", F.when(F.col("copies") > 0, training_time(F.try_divide("middle", "target"), F.col("place"), schedules)))
        .drop("piece", "ahead", "source__", "piece__", "offset")
    )


def training_time(demand: Column, place: Column, schedules=SCHEDULES) -> Column:
    """Time at which a share ``demand`` of the source's total has been asked for.

    Each piece's integral is a parabola in t; the root that lies in the piece is taken in the form
    that does not cancel.
    """
    cases = None
    for turn, points in enumerate(schedules):
        whole = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(points, points[1:]))
        done, times = 0.0, None
        for (t0, w0), (t1, w1) in zip(points, points[1:]):
            area = (t1 - t0) * (w0 + w1) / 2 / whole
            if area <= 0:
                continue
            slope = (w1 - w0) / (t1 - t0) / whole
            wanted = F.least(F.greatest(demand - F.lit(done), F.lit(0.0)), F.lit(area))
            root = F.sqrt(F.greatest(F.lit((w0 / whole) ** 2) + 2 * F.lit(slope) * wanted, F.lit(0.0)))
            step = F.when(wanted > 0, 2 * wanted / (F.lit(w0 / whole) + root)).otherwise(F.lit(0.0))
            time = F.lit(t0) + F.least(step, F.lit(t1 - t0))
            reached = demand <= F.lit(done + area)
            times = F.when(reached, time) if times is None else times.when(reached, time)
            done += area
        times = times.otherwise(F.lit(1.0))
        cases = F.when(place % len(schedules) == turn, times) if cases is None else cases.when(
            place % len(schedules) == turn, times)
    return cases


#: What a row's plan must say for its copies to be dealt.
STEP = ("copies", "middle", "source_size", "target", "place")


def copies(rows: DataFrame, step: str, schedules=SCHEDULES, copy: str = "copy") -> DataFrame:
    """One row per copy that a row's plan, the struct ``step``, takes: its epoch ``copy`` and ``position``."""
    of = F.col(step)
    kept = without(rows, ["position", copy])
    epochs = F.sequence(F.lit(0), of["copies"].cast("int") - 1)
    copied = kept.filter(of["copies"] > 0).select(*kept.columns, F.explode(epochs).alias(copy))
    demand = F.try_divide(of["middle"] + F.col(copy) * of["source_size"], of["target"])
    return copied.withColumn("position", training_time(demand, of["place"], schedules))


def in_training_order(copied: DataFrame, key: str = "doc_id") -> DataFrame:
    """``copied`` range-sorted by ``position``."""
    return copied.repartitionByRange("position", F.col(key)).sortWithinPartitions("position", key)


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    schedules=SCHEDULES, key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The training order: one row of ``docs`` per copy taken, range-sorted by ``position``.

    Rows are matched to their plan by id and row hash. Rows that are equal in every column have a plan
    each; there one of them stands for all, and each plan takes its copies of it.
    """
    sizes = pin(measured(docs, key, text, source), "mix-sizes")
    planned = plan(sizes, weights, share, most, schedules).filter("copies > 0")
    own, plan_key, plan_row, step, copy = (
        free_name(n, docs) for n in ("own_row", "plan_key", "plan_row", "plan_step", "plan_copy"))
    steps = planned.select(F.col("doc_id").alias(plan_key), F.col("row").alias(plan_row), F.struct(*STEP).alias(step))
    kept = [c for c in docs.columns if c.lower() != "position"]
    rows = docs.withColumn(own, row_hash(docs))
    if not sizes.groupBy("doc_id", "row").count().filter("count > 1").isEmpty():
        rows = rows.dropDuplicates([key, own])
    joined = rows.join(steps, rows[key].eqNullSafe(steps[plan_key]) & (rows[own] == steps[plan_row]))
    copied = copies(joined.select(*[rows[c] for c in kept], step), step, schedules, copy)
    return in_training_order(copied.select(*kept, "position"), key)
