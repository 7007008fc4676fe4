"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition sorts the digests of its texts into runs of bounded length without repeats, each entry with
its smallest identifier and its count. Places then exchange runs in binomial rounds: in round r, a place keeps
those entries of its merged run whose r-th digest bit is its own r-th bit, and hands the others to the place that
differs from it in that bit. A place merges the sorted runs it gets, two at a time; equal digests meet there, are
verified by length and a second hash, and keep the smallest identifier. After the last round each place holds one
digest range, merged over all inputs. A run travels as one packed row, so its order survives the shuffle. A group
of copies of any size is a single entry per run from the start, so hot groups cost nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.rows import byte_column, small_batches
from lonja.session import materialized

#: Entries of one packed run at most before its first merge, and rows for which a place of its own is worth while.
RUN = 1 << 16
PLACE_ROWS = 1 << 13
#: Big-endian words of the digest, verification, smallest id (``none``: no id at all), number of rows.
ENTRY = np.dtype([("d0", ">u8"), ("d1", ">u8"), ("d2", ">u8"), ("d3", ">u8"), ("length", "<i8"), ("second", "<i8"),
                  ("least", "<i8"), ("none", "<i8"), ("size", "<i8")])
SAME = ("d0", "d1", "d2", "d3", "length", "second")
_ENTRY_COLUMNS = "digest binary, length long, second long, least long, size long"


def collapse(run: np.ndarray) -> np.ndarray:
    """One entry per verified digest of a run in order: neighbours are the same text if all of ``SAME`` agree."""
    if len(run) < 2:
        return run
    near = run["d0"][1:] == run["d0"][:-1]
    equal = near.copy()
    for field in SAME[1:]:
        equal &= run[field][1:] == run[field][:-1]
    if (near & ~equal).any():  # digests that begin alike: only these need more than the first word to be in order
        run = run[np.lexsort([run[field] for field in reversed(SAME)])]
        equal = np.ones(len(run) - 1, bool)
        for field in SAME:
            equal &= run[field][1:] == run[field][:-1]
    head = np.flatnonzero(np.append(True, ~equal))
    out = run[head].copy()
    out["least"] = np.minimum.reduceat(np.where(run["none"] > 0, np.iinfo(np.int64).max, run["least"]), head)
    out["none"] = np.minimum.reduceat(run["none"], head)
    out["size"] = np.add.reduceat(run["size"], head)
    return out


def merge_two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge two runs that are sorted by their first word."""
    if not len(a) or not len(b):
        return a if len(a) else b
    place = np.searchsorted(a["d0"].astype("<u8"), b["d0"].astype("<u8"), side="right") + np.arange(len(b))
    out = np.empty(len(a) + len(b), ENTRY)
    mine = np.ones(len(out), bool)
    mine[place] = False
    out[place], out[mine] = b, a
    return collapse(out)


def merge_many(runs: list[np.ndarray]) -> np.ndarray:
    """Merge sorted runs as in a tournament."""
    while len(runs) > 1:
        runs = [merge_two(*runs[i : i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0] if runs else np.zeros(0, ENTRY)


def sorted_run(batch: pa.RecordBatch) -> np.ndarray:
    """The run of some ``doc_id, digest, length, second`` rows."""
    run = np.zeros(batch.num_rows, ENTRY)
    words = byte_column(batch.column(1))[0].view(">u8").reshape(-1, 4)
    for place, field in enumerate(SAME[:4]):
        run[field] = words[:, place]
    run["length"], run["second"] = batch.column(2).to_numpy(), batch.column(3).to_numpy()
    run["none"] = batch.column(0).is_null().to_numpy(zero_copy_only=False)
    run["least"] = batch.column(0).fill_null(0).to_numpy()
    run["size"] = 1
    return collapse(run[np.argsort(run["d0"].astype("<u8"), kind="stable")])


def _halves(place: int, run: np.ndarray, turn: int) -> Iterator[tuple[int, bytes]]:
    """The slices of a run for the two places that differ in bit ``turn`` only."""
    bit = (run["d3"] >> np.uint64(turn)) & np.uint64(1)
    for value in (0, 1):
        part = run[bit == value]
        if len(part):
            yield (place & ~(1 << turn)) | value << turn, part.tobytes()


def _packed(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([place for place, _ in rows], pa.int32()), pa.array([run for _, run in rows], pa.binary())], ["place", "run"])


def _squeezed(text: str) -> Column:
    # A single space stays as it is, so only other white space and longer runs are matched.
    return F.regexp_replace(
        F.coalesce(F.col(text), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " "
    )


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest, length, second`` of each row's text after white space is made single spaces."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _squeezed(text).alias("plain"))
    return plain.select(
        "doc_id", F.unhex(F.sha2("plain", 256)).alias("digest"),
        F.octet_length("plain").cast("long").alias("length"), F.xxhash64("plain").alias("second"),
    )


def merge_runs(marks: DataFrame, rows_per_place: int = PLACE_ROWS) -> DataFrame:
    """The tree merge: ``digest, length, second, least, size``, one row per distinct text.

    ``least`` is null only if all identifiers of the group are null. There are as many places as input partitions
    (fewer for small inputs), rounded up to a power of two.
    """
    wanted = min(marks.rdd.getNumPartitions(), -(-marks.count() // rows_per_place))
    rounds = max(1, math.ceil(math.log2(max(2, wanted))))
    places = 1 << rounds

    def first_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, held, size = TaskContext.get().partitionId() % places, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, RUN):
                held.append(sorted_run(batch.slice(at, RUN)))
                size += len(held[-1])
                if size >= RUN:
                    yield _packed(list(_halves(place, merge_many(held), 0)))
                    held, size = [], 0
        yield _packed(list(_halves(place, merge_many(held), 0)))

    def exchanged(turn: int):
        def merge(key: tuple, group: pa.Table) -> pa.Table:
            place = key[0].as_py()
            run = merge_many([np.frombuffer(x, ENTRY) for x in group.column("run").to_pylist()])
            # After the last round the place holds all there is of its digests.
            return pa.Table.from_batches([_packed(list(_halves(place, run, turn)) if turn < rounds else [(place, run.tobytes())])])

        return merge

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1).to_pylist():
                whole = np.frombuffer(content, ENTRY)
                for at in range(0, len(whole), RUN):
                    run = whole[at : at + RUN]
                    digest = np.ascontiguousarray(np.stack([run[f] for f in SAME[:4]], axis=1).astype(">u8")).tobytes()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([digest[i : i + 32] for i in range(0, len(digest), 32)], pa.binary()),
                        *(pa.array(run[f].astype(np.int64)) for f in ("length", "second")),
                        pa.array(run["least"].astype(np.int64), mask=run["none"] > 0), pa.array(run["size"].astype(np.int64)),
                    ], ["digest", "length", "second", "least", "size"])

    runs = marks.mapInArrow(first_runs, "place int, run binary")
    for turn in range(1, rounds + 1):
        runs = runs.groupBy("place").applyInArrow(exchanged(turn), "place int, run binary")
    return runs.mapInArrow(entries, _ENTRY_COLUMNS)


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    A null text counts as empty, and empty texts are equal to each other. A null id is larger than any
    other. Of rows that share text and id, one is kept. An empty table gives an empty result; columns other
    than the two named are not read.
    """
    small_batches(docs.sparkSession)
    marks = materialized(digests(docs, doc_id, text), "digests")
    groups = merge_runs(marks).withColumnsRenamed({"least": "keep_id", "size": "group_size"})
    same = ["digest", "length", "second"]
    # Rows with the same id and text are counted here, so that just one of them is marked as kept.
    rows = marks.groupBy("doc_id", *same).agg(F.count(F.lit(1)).alias("copies"))
    joined = rows.join(groups, same)
    return joined.select(
        "doc_id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the one with the smallest id.

    Of several rows with that id and text, the one with the smallest hash over all columns stays.
    """
    small_batches(docs.sparkSession)
    marks = materialized(digests(docs, doc_id, text), "digests")
    keep = merge_runs(marks).select(F.col("digest").alias("_keep_digest"), F.col("least").alias("_keep_id"))
    marked = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
        F.col(doc_id).cast("long").alias("_id"),
        F.unhex(F.sha2(_squeezed(text), 256)).alias("_digest"),
    )
    left = marked.join(
        keep, F.col("_digest").eqNullSafe(F.col("_keep_digest")) & F.col("_id").eqNullSafe(F.col("_keep_id")), "left_semi"
    )
    # Only rows that share both id and text meet in one window group.
    once = Window.partitionBy("_digest", "_id").orderBy(F.xxhash64("_row"))
    return left.withColumn("_turn", F.row_number().over(once)).where("_turn = 1").select("_row.*")
