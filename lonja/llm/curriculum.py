"""Mix sources to target weights along a curriculum, with DataFrame functions only.

Each source gets a target number of words (water filling: shares by weight, at most ``MOST`` times the
source's own size, the excess shared again). Over training time, a source's rate of use follows a piecewise
linear schedule whose integral is the target. A document stands at a cumulative demand of its source, copies
in later epochs at one source size more; inverting the integrated schedule at that demand gives the
training position, and the copies are range-sorted by it.

No window spans a source: cumulative sizes are taken within (source, bucket), where a bucket is a slice of
the documents by a hash of their id, and the sums of the buckets before are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.session import materialized

WEIGHTS = (5, 2, 1)
MOST = 3
#: (training time from 0 to 1, relative rate) of the sources with the same place in WEIGHTS: the heavy sources
#: lead, the middle ones stay even, the light ones are saved for the end.
SCHEDULES = (
    ((0.0, 1.5), (0.3, 1.5), (0.8, 0.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)),
)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 in code point order, null last; ranks within range partitions plus the rows before."""
    spread = sources.withColumn("none", F.col("source").isNull()).repartitionByRange("none", "source")
    spread = materialized(spread.withColumn("part", F.spark_partition_id()), "sources")
    before = spread.groupBy("part").count()
    before = before.select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("rows_before")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy("none", "source"))
    return spread.withColumn("inside", inside).join(before, "part").select(
        "source", "source_size", (F.col("rows_before") + F.col("inside") - 1).alias("rank")
    )


def _by_place(place: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, place, target`` from ``source, source_size``."""
    place = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int")
    ranked = _ranked(sizes).select("source", "source_size", place.alias("place"))
    ranked = materialized(ranked.withColumn("weight", _by_place(F.col("place"), weights)), "weights")
    bound = F.lit(most) * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = math.inf, -1
    while True:
        # Those at their bound give up the rest of their share; the level of the others rises until all fit.
        above = (bound <= F.lit(level) * F.col("weight")) if capped >= 0 else F.lit(False)
        row = ranked.agg(
            F.sum(F.when(above, 1).otherwise(0)), F.sum(F.when(above, bound).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        if row[0] is None or row[0] == capped or not row[2]:
            level = math.inf if row[0] is not None and not row[2] else level
            break
        capped, level = row[0], (total - row[1]) / row[2]
    exact = F.when(bound <= F.lit(level) * F.col("weight"), bound.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", "place", exact.alias("target"))


def _inverse(part: Column, knots: tuple) -> Column:
    """Training time at which the integral of the schedule reaches ``part`` of its whole."""
    pairs = list(zip(knots, knots[1:], strict=False))
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in pairs)
    done, time = 0.0, None
    for a, b in pairs:
        # Within a segment the integral is a quadratic in time; this form of its root also holds for slope 0.
        rate, slope = a[1] / area, (b[1] - a[1]) / (b[0] - a[0]) / area
        rest = F.greatest(part - F.lit(done), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(rate * rate) + F.lit(2 * slope) * rest, F.lit(0.0)))
        here = F.least(F.lit(a[0]) + F.lit(2.0) * rest / (F.lit(rate) + root), F.lit(b[0]))
        time = here if time is None else F.when(part >= F.lit(done), here).otherwise(time)
        done += (b[0] - a[0]) * (a[1] + b[1]) / 2 / area
    return time


def placed(rows: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``source_size, place, target, demand, before`` to rows with ``source, size, key``.

    ``demand`` is the target as a whole number of words, ``before`` the words of the source's documents that
    stand before this one in the order of ``key`` (a hash of the id as hexadecimal text, then ``tie``).
    """
    rows = rows.withColumn("bucket", F.substring("key", 1, 3))
    sums = materialized(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    aims = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    # At most 4096 rows a source here.
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("earlier", F.coalesce(F.sum("words").over(along), F.lit(0)))
    starts = starts.join(aims.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        "_s", F.col("bucket").alias("_b"), "earlier", "source_size", "place", "target"
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = rows.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    demand = F.least(F.floor(F.col("target") + 0.5), F.lit(most) * F.col("source_size"))
    return joined.withColumns({"before": F.col("earlier") + F.col("inner"), "demand": demand}).drop(
        "_s", "_b", "earlier", "inner", "bucket"
    )


def _in_epoch(epoch: int) -> Column:
    """Words of the document that the source's demand still reaches in this epoch."""
    left = F.col("demand") - F.col("before") - F.lit(epoch) * F.col("source_size")
    return F.greatest(F.least(left, F.col("size")), F.lit(0))


def _position(epoch: Column, words: Column, schedules: tuple) -> Column:
    middle = F.col("before") + epoch * F.col("source_size") + words / F.lit(2.0)
    part = F.when(F.col("demand") > 0, middle / F.col("demand")).otherwise(F.lit(0.0))
    time = F.lit(0.0)
    for place, knots in enumerate(schedules):
        time = F.when(F.pmod(F.col("place"), F.lit(len(schedules))) == place, _inverse(part, knots)).otherwise(time)
    return time


def _key(doc_id: str, text: str) -> Column:
    """Place of a row in its source's order: a hash of its id, or of its text where it has none."""
    unnamed = F.concat(F.lit(" "), F.coalesce(F.col(text), F.lit("")))
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), unnamed).cast("binary"))


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
            weights: tuple = WEIGHTS, most: int = MOST, schedules: tuple = SCHEDULES) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, epochs, positions``.

    ``positions`` has the training position of the copy in each epoch that uses the document. The result is
    range-partitioned and sorted by the first of them, documents that are not used last.

    ``taken`` sums to the rounded target in every source: the last document that the demand reaches is taken
    in part. A null text has size 0, a null source is a source of its own (last in order), a row without an id
    is placed by its text; rows that repeat are separate documents. An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        _key(doc_id, text).alias("key"),
    )
    rows = materialized(rows, "sizes").withColumn("tie", F.col("size"))
    parts = [_in_epoch(epoch) for epoch in range(most)]
    taken = sum(parts[1:], parts[0])
    epochs = sum([F.when(p > 0, 1).otherwise(0) for p in parts[1:]], F.when(parts[0] > 0, 1).otherwise(0))
    positions = [F.when(p > 0, _position(F.lit(epoch), p, schedules)) for epoch, p in enumerate(parts)]
    mixed = placed(rows, weights, most).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), epochs.alias("epochs"),
        F.array_compact(F.array(*positions)).alias("positions"), "key",
    )
    order = [F.get("positions", F.lit(0)).asc_nulls_last(), F.col("key")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).drop("key")


def curriculum(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple = WEIGHTS, most: int = MOST, schedules: tuple = SCHEDULES) -> DataFrame:
    """The documents in training order: one row per epoch that uses the document, with the input's columns.

    Whole documents only: an epoch uses a document if the demand reaches its middle. Documents without words
    are used once if their source's demand reaches them (a source without words keeps its documents once).
    Nulls and repeated rows are treated as in ``mixture``; an empty table gives an empty result.
    The result is range-partitioned and sorted by training position.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        _key(doc_id, text).alias("key"),
    ).withColumn("tie", F.xxhash64("row"))
    middle = F.col("before") * 2 + F.col("size")
    used = F.array(*[
        F.lit(epoch) for epoch in range(most)
    ])

    def reached(epoch: Column) -> Column:
        inside = middle + 2 * epoch * F.col("source_size") < 2 * F.col("demand")
        first = epoch == 0
        return (inside | (first & (F.col("source_size") == 0))) & ((F.col("size") > 0) | first)

    # Only the epochs that use a row make copies of it.
    rows = placed(rows, weights, most).withColumn("epoch", F.explode(F.filter(used, reached)))
    rows = rows.withColumn("position", _position(F.col("epoch"), F.col("size"), schedules))
    return rows.repartitionByRange("position", "key").sortWithinPartitions("position", "key").select("row.*")
