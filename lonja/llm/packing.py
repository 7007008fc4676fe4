"""Pack token sequences of documents by vector best fit.

A bin (one training sequence) has residual capacities for tokens, documents and attention cost (the sum of
squared lengths). Items come in order of decreasing length; each goes to the bin that fits in every
dimension and leaves the smallest weighted residual norm, or has the largest weighted dot product of
residual and demand. Items are dealt to groups of about ``GROUP_TOKENS`` tokens, packed independently, so the
only loss against one global packing is the last bins of each group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.rows import small_batches
from lonja.llm.tokens import default_vocabulary, gathered, shared_encoder
from lonja.session import materialized

END = 0
GROUP_TOKENS = 8 << 20
#: Bytes of text encoded together, and most pieces whose ids a worker keeps. Idle workers keep much of the memory they
#: once took, and an executor may have several of them for each core.
BATCH_BYTES = 1 << 20
KEPT = 100_000


@dataclass(frozen=True)
class Limits:
    """Capacities of one sequence and the weights of the three dimensions in the choice of a bin.

    With the defaults, tokens alone bind: 2048 documents of one token, or one document of 2048, still fit.
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"


def best_fit(lengths: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. An item beyond a capacity by itself gets a bin of its own."""
    scale = np.array([limits.tokens, limits.documents, limits.attention], np.float64)
    weights = np.array(limits.weights, np.float64)
    items = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1) / scale
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    left = np.empty((3, max(16, len(lengths))), np.float64)  # residuals of the open bins
    number = np.empty(max(16, len(lengths)), np.int64)
    filled = np.zeros(max(1, len(lengths)), np.int64)
    used = opened = 0
    smallest = items[:, 0].min() if len(items) else 0
    slack = 1e-9
    for i in np.argsort(-lengths, kind="stable"):
        need = items[i]
        room = left[:, :used]
        fits = (room[0] >= need[0] - slack) & (room[1] >= need[1] - slack) & (room[2] >= need[2] - slack)
        choice = np.flatnonzero(fits)
        if len(choice):
            rest = room[:, choice]
            if limits.rule == "norm":
                value = weights @ (rest - need[:, None]) ** 2
                place = choice[np.argmin(value)]
            else:
                place = choice[np.argmax((weights * need) @ rest)]
        else:
            place = used
            left[:, place], number[place] = 1.0, opened
            used, opened = used + 1, opened + 1
        left[:, place] -= need
        bins[i] = number[place]
        offsets[i] = filled[number[place]]
        filled[number[place]] += lengths[i]
        if left[0, place] < smallest - slack:  # nothing fits there any more
            used -= 1
            left[:, place], number[place] = left[:, used], number[used]
    return bins, offsets


def pieces(docs: DataFrame, doc_id: str, text: str, tokens: int, vocabulary: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of the pieces of each document's ids with the end id.

    Only a document longer than ``tokens`` is cut: its last pieces are full, its first one takes the rest.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary, KEPT, 2)
        for batch in gathered(batches, 1, BATCH_BYTES):
            ids, at = encoder.encode(batch.column(1).fill_null(""))
            ids = ids.astype("<u4")
            sizes = np.diff(at) + 1
            number = -(-sizes // tokens)
            owner = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            head = sizes - (number - 1) * tokens
            start = np.where(piece == 0, 0, head[owner] + (piece - 1) * tokens)
            length = np.where(piece == 0, head[owner], tokens)
            end = np.array([END], "<u4").tobytes()
            sums = []
            for doc, first, size in zip(owner, start, length, strict=True):
                stop = min(at[doc] + first + size, at[doc + 1])
                crc = zlib.crc32(ids[at[doc] + first : stop])
                sums.append(zlib.crc32(end, crc) if first + size == sizes[doc] else crc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                 pa.array(sums, pa.int64())], names)

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: Limits = Limits(),
         vocabulary: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is the end id alone. Repeated rows and null ids are packed like any other row. An empty
    table gives an empty result; other columns are not read.
    """
    vocabulary = vocabulary or default_vocabulary()
    rows = materialized(pieces(docs, doc_id, text, limits.tokens, vocabulary), "pieces")
    total = rows.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // GROUP_TOKENS))
    # Dealt by row number, so repeated ids do not meet in one group.
    dealt = rows.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    dealt = materialized(dealt, "dealt")

    def place(key: tuple, group: pa.Table) -> pa.Table:
        bins, offsets = best_fit(group.column("length").to_numpy(), limits)
        numbers = bins * groups + key[0].as_py()
        return group.drop_columns(["group"]).append_column("sequence_id", pa.array(numbers)).append_column(
            "offset", pa.array(offsets))

    return dealt.groupBy("group").applyInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
