"""Token ids of a corpus in binary files: frequency ranks in a byte-aligned code, decoded by table lookup.

A dataset is a folder with two Parquet tables. ``ranks`` lists the token id of each rank (rank 0 is the most
frequent id of the whole corpus). ``blocks`` holds one row per block of documents in ascending id order:

* ``part, block``: place in the order (parts ascend, blocks ascend within a part),
* ``docs``: ids, ``doc_null``: 1 where the id is null, ``lengths``: ids per document (little-endian),
* ``control``: two bits per id, four ids per byte from the low bits up: number of bytes minus one,
* ``data``: the ranks, each in that many little-endian bytes.

Parquet is only the container: it is committed by Spark, so a lost executor leaves no half-written file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lonja.llm.rows import row_key, small_batches
from lonja.llm.tokens import default_vocabulary, gathered, shared_encoder
from lonja.session import materialized, work_folder

END = 0
BLOCK_IDS = 1 << 19


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of the ranks."""
    size = 1 + (ranks >= 1 << 8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    ends = np.cumsum(size)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    begin = ends - size
    for byte in range(4):
        some = size > byte
        data[begin[some] + byte] = (ranks[some] >> (8 * byte)) & 255
    return control.tobytes(), data.tobytes()


#: Byte lengths of the four values of each control byte.
LENGTHS = np.stack([(np.arange(256) >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1)


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    values = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    begin = np.cumsum(sizes) - sizes
    ranks = values[begin].astype(np.uint32)
    for byte in range(1, 4):
        some = np.flatnonzero(sizes > byte)
        ranks[some] |= values[begin[some] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def _tokenized(docs: DataFrame, doc_id: str, text: str, vocabulary: str) -> DataFrame:
    """Blocks of ids in ascending order of ids: ``part, block, docs, doc_null, lengths, ids`` (ids compressed)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), row_key(doc_id, text)[1])
    # The hash of the text splits rows that share one id.
    rows = rows.repartitionByRange("doc_id", "tag").sortWithinPartitions("doc_id", "tag")
    names = ["part", "block", "docs", "doc_null", "lengths", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=3).compress
        encoder, part, block = shared_encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in gathered(batches, 1):
            ids, at = encoder.encode(batch.column(1).fill_null(""))
            names_of, none = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(at, at[start] + BLOCK_IDS, side="right")) - 1)
                lengths = np.diff(at[start : stop + 1])
                # The end id follows each document.
                own = np.insert(ids[at[start] : at[stop]], np.cumsum(lengths), END).astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([block], pa.int64()),
                    pa.array([names_of[start:stop].astype("<i8").tobytes()], pa.binary()),
                    pa.array([none[start:stop].astype(np.uint8).tobytes()], pa.binary()),
                    pa.array([(lengths + 1).astype("<i8").tobytes()], pa.binary()), pa.array([squeeze(own.tobytes())], pa.binary()),
                ], names)
                start, block = stop, block + 1

    return rows.mapInArrow(run, "part int, block long, docs binary, doc_null binary, lengths binary, ids binary")


def _ranks(tokens: DataFrame, folder: str) -> np.ndarray:
    """Write the rank table; return the rank of each id. Its size is bounded by the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, sums = zstandard.ZstdDecompressor().decompress, np.zeros(0, np.int64)
        for batch in batches:
            for frame in batch.column(0).to_pylist():
                own = np.bincount(np.frombuffer(unpack(frame), "<u4"))
                if len(own) > len(sums):
                    sums, own = own, sums
                sums[: len(own)] += own
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[used], pa.int64())], ["id", "n"])

    counts = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, times = counts["id"].to_numpy(), counts["n"].to_numpy()
    order = ids[np.lexsort((ids, -times))]
    spark = tokens.sparkSession
    rows = pa.table({"rank": np.arange(len(order), dtype=np.int64), "id": order.astype(np.int64)})
    spark.createDataFrame(rows).coalesce(1).write.parquet(f"{folder}/ranks")
    ranks = np.zeros(int(order.max()) + 1 if len(order) else 1, np.int64)
    ranks[order] = np.arange(len(order))
    return ranks


def write_tokens(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> None:
    """Write the dataset for all rows.

    A null or empty text is the end id alone. Null ids come first; rows with the same id are in an order fixed by
    their texts. An empty table gives empty tables; other columns are not read.
    """
    small_batches(docs.sparkSession)
    tokens = materialized(_tokenized(docs, doc_id, text, vocabulary or default_vocabulary()), "tokens")
    ranks = _ranks(tokens, folder)
    names = ["part", "block", "docs", "doc_null", "lengths", "n_ids", "control", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                values = ranks[np.frombuffer(unpack(one.column(5)[0].as_py()), "<u4")]
                control, data = encode_ranks(values)
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:5], pa.array([len(values)], pa.int64()), pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                    names)

    blocks = tokens.mapInArrow(
        run, "part int, block long, docs binary, doc_null binary, lengths binary, n_ids long, control binary, data binary")
    blocks.write.parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, ids_crc32`` from the files.

    ``start`` counts the ids of all documents before it; the sums over parts and blocks need the block sizes only.
    """
    small_batches(spark)
    table = spark.read.parquet(f"{folder}/ranks").toArrow()  # as many rows as the vocabulary at most
    ids = np.zeros(max(1, table.num_rows), "<u4")
    ids[table["rank"].to_numpy()] = table["id"].to_numpy()
    blocks = spark.read.parquet(f"{folder}/blocks")
    names = ["part", "block", "doc_id", "inner", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, docs, none, lengths, n_ids, control, data = (batch.column(c)[row].as_py() for c in range(8))
                values = ids[decode_ranks(control, data, n_ids)]
                sizes = np.frombuffer(lengths, "<i8")
                at = np.concatenate([[0], np.cumsum(sizes)])
                sums = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(sizes), part), pa.int32()), pa.array(np.full(len(sizes), block), pa.int64()),
                    pa.array(np.frombuffer(docs, "<i8"), mask=np.frombuffer(none, np.uint8) > 0), pa.array(at[:-1]), pa.array(sizes),
                    pa.array(sums, pa.int64()),
                ], names)

    columns = ["part", "block", "docs", "doc_null", "lengths", "n_ids", "control", "data"]
    rows = blocks.select(columns).mapInArrow(run, "part int, block long, doc_id long, inner long, n_tokens long, ids_crc32 long")
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("earlier"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")
    starts = sizes.withColumn("before", inside).join(parts, "part").select(
        "part", "block", (F.col("before") + F.col("earlier")).alias("before"))
    return rows.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the documents' ids and read them back."""
    folder = folder or work_folder(docs.sparkSession, "token-files")
    write_tokens(docs, folder, **options)
    return read_tokens(docs.sparkSession, folder)
