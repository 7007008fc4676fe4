"""Removal of byte strings that repeat anywhere in the corpus, by suffix arrays over groups of candidates.

A string of ``length`` bytes belongs to the group of its anchor: the smallest hash among its ``GRAM``-byte
substrings (the leftmost one in a tie). Equal strings have equal anchors, so groups can be searched apart.
Neighbouring start positions with the same anchor place form a run; a run of n starts is a text of
n + length - 1 bytes.

1. Anchors that occur once are out. Equal runs are merged and counted before any text moves; a run that occurs
   more than once is repeated as a whole. What remains to be found are the repeated starts of single runs.
2. The texts of the different runs of each anchor that has a single run among them are fetched, and the groups
   are sorted into suffix arrays by two-stage sorting; a start is repeated if it has a common prefix of
   ``length`` bytes with a neighbour.
3. A group with more than ``LARGE`` different runs is split by a finer key before it is sorted: the starts of a
   run are dealt by how far before the anchor they lie, ``WIDTHS`` places together, and with the bytes that all
   strings of such a class have in common (180 of 200 at first) they form a group of its own. Equal strings have
   their anchor at the same place, so they stay together; equal parts of runs are merged and counted again. Groups
   that are still too large are split once more; with classes of one place, a group is one string.
4. The repeated starts go back to all places of their run, and each document drops the bytes they cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.rows import byte_column, packed, row_key, small_batches
from lonja.llm.suffix_array import repeated
from lonja.llm.words import mix, stream
from lonja.session import materialized

LENGTH = 200
GRAM = 32
#: Different runs sorted in one group at most, and the widths of the classes by which larger ones are split.
LARGE = 2048
WIDTHS = (21, 3, 1)
#: Bytes whose anchors are searched at once, and bytes of one suffix array (whole groups, so a little more).
CHUNK = 1 << 20
ARRAY = 2 << 20
_PLACE = np.uint64((1 << 24) - 1)


def _gram_hashes(data: np.ndarray, gram: int, table: np.ndarray) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position on (``gram``: a power of two), by doubling."""
    factors = stream(12, 16) | np.uint64(1)
    value, width, turn = table[data], 1, 0
    while width < gram:
        value = value[:-width] * factors[turn] + value[width:]
        width, turn = 2 * width, turn + 1
    return mix(value)


def _window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbouring values."""
    span = 1
    while 2 * span <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = width - span
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def _runs(docs: DataFrame, length: int, gram: int, digests: bool) -> DataFrame:
    """``anchor`` of every run, with ``digest, did, tag, start, n, at`` if wanted (``at``: place of the anchor in the run)."""
    names = ["anchor", "digest", "did", "tag", "start", "n", "at"] if digests else ["anchor"]
    table = stream(11, 256)

    def chunk_runs(pieces: list[tuple[int, int, np.ndarray]]):
        """``(row, first, bytes)`` pieces; gives arrays: piece, start in the piece, number of starts, anchor and its place."""
        data = np.concatenate([x[2] for x in pieces])
        if len(data) < length:
            return None
        sizes = np.array([len(x[2]) for x in pieces])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        hashes = _gram_hashes(data, gram, table)
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least = _window_least(keys, length - gram + 1) & _PLACE
        owner = np.repeat(np.arange(len(pieces)), sizes)[: len(least)]
        starts = np.flatnonzero(np.arange(len(least)) + length <= ends[owner])
        if not len(starts):
            return None
        place = least[starts].astype(np.int64)
        head = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        first, count = starts[head], np.diff(np.append(head, len(starts)))
        return data, owner[first], first, first - begins[owner[first]], count, hashes[place[head]].view(np.int64), place[head] - first

    def emit(batch: pa.RecordBatch, pieces: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch | None:
        import xxhash

        found = chunk_runs(pieces)
        if found is None:
            return None
        data, piece, first, inner, count, anchor, at = found
        if not digests:
            return pa.RecordBatch.from_arrays([pa.array(anchor)], names)
        view, stops = memoryview(data), first + count + length - 1
        marks = [xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(first.tolist(), stops.tolist(), strict=True)]
        row = pa.array(np.array([x[0] for x in pieces])[piece])
        offset = np.array([x[1] for x in pieces])[piece]
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(marks, pa.binary()), batch.column(0).take(row), batch.column(1).take(row),
             pa.array(inner + offset, pa.int64()), pa.array(count.astype(np.int32)), pa.array(at.astype(np.int32))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch in batches:
            data, at = byte_column(batch.column(2))
            pieces, size = [], 0
            for row in range(batch.num_rows):
                # A long text is cut into pieces that overlap, so every start lies in exactly one.
                for first in range(int(at[row]), max(int(at[row + 1]) - length + 1, int(at[row])), CHUNK):
                    part = data[first : min(first + CHUNK + length - 1, int(at[row + 1]))]
                    if len(part) < length:
                        continue
                    pieces.append((row, first - int(at[row]), part))
                    size += len(part)
                    if size >= CHUNK:
                        if (out := emit(batch, pieces)) is not None:
                            yield out
                        pieces, size = [], 0
            if pieces and (out := emit(batch, pieces)) is not None:
                yield out

    kinds = "anchor long, digest binary, did long, tag int, start long, n int, at int" if digests else "anchor long"
    return docs.mapInArrow(run, kinds)


TEXTS = "key long, run long, low long, n int, at int, times long, text binary"


def _texts(packed_docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``TEXTS`` for the ``wanted`` places of runs (``low``: starts of the run before this part, none here)."""
    names = ["key", "run", "low", "n", "at", "times", "text"]
    fields = ["anchor", "run", "n", "at", "times", "start"]
    lists = wanted.groupBy("did", "tag").agg(F.collect_list(F.struct(*fields)).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in range(batch.num_rows):
                content = unpack(batch.column(0)[row].as_py())
                runs = batch.column(1).slice(row, 1).flatten()
                start, count = runs.field("start").to_numpy(), runs.field("n").to_numpy()
                texts = [content[a : a + n + length - 1] for a, n in zip(start.tolist(), count.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [runs.field("anchor"), runs.field("run"), pa.array(np.zeros(len(texts), np.int64)), runs.field("n"), runs.field("at"),
                     runs.field("times"), pa.array(texts, pa.binary())], names)

    # Rows that repeat id and text share a key; one of them is enough.
    joined = packed_docs.join(lists, ["did", "tag"]).select("did", "tag", "frame", "runs").dropDuplicates(["did", "tag"])
    return joined.select("frame", "runs").mapInArrow(cut, TEXTS)


def names_of(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _parts(texts: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """Runs cut into parts whose anchor lies in one class of ``width`` places, with a finer key and a digest."""
    names = ["key", "mark", "run", "low", "n", "at", "times", "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out = []
            for key, run, low, n, at, times, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                first = 0
                while first < n:
                    turn = (at - first) // width
                    count = min(n - first, at - first - turn * width + 1)
                    # What every string with its anchor in this class has before, at and after the anchor.
                    core = text[at - turn * width : at + length - (turn + 1) * width + 1]
                    part = text[first : first + count + length - 1]
                    seed = (key * 193 + turn) % (1 << 63)
                    out.append((xxhash.xxh64_intdigest(core, seed) - (1 << 63), xxhash.xxh3_128_digest(part), run, low + first, count,
                                at - first, times, part))
                    first += count
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    return texts.mapInArrow(cut, "key long, mark binary, run long, low long, n int, at int, times long, text binary")


def _repeated_starts(texts: DataFrame, length: int, gram: int, large: int) -> DataFrame:
    """``run, low, high``: repeated starts of the runs of ``texts`` that occur once."""
    found = []
    for width in (*WIDTHS, None):
        groups = texts.groupBy("key").agg(F.count(F.lit(1)).alias("different"), F.min("times").alias("least"))
        groups = groups.where("different > 1 AND least = 1").select("key", (F.col("different") > large).alias("large"))
        groups = materialized(groups, "groups")
        dealt = texts.join(groups.where("NOT large"), "key").select("key", "run", "low", "times", "text")
        dealt = dealt.repartition("key").sortWithinPartitions("key")
        found.append(dealt.mapInArrow(_search_groups(length), "run long, low long, high long"))
        wide = groups.where("large").select("key")
        # A group of strings with the same anchor, place and content is one string: the last classes leave none.
        if width is None or wide.isEmpty():
            break
        parts = materialized(_parts(texts.join(wide, "key").select(*names_of(TEXTS)), length, gram, width), "parts")
        merged = parts.groupBy("key", "mark").agg(F.sum("times").alias("times"), F.min(F.struct("run", "low", "n", "at", "text")).alias("part"))
        merged = materialized(merged.select("key", "mark", "times", "part.*"), "merged-parts")
        often = merged.where("times > 1").select("key", "mark")
        # Parts of runs that occur more than once themselves are known to be repeated.
        again = parts.where("times = 1").join(often, ["key", "mark"])
        found.append(again.select("run", "low", (F.col("low") + F.col("n")).alias("high")))
        texts = merged.select(*names_of(TEXTS))
    return reduce(DataFrame.unionByName, found)


def _search_groups(length: int):
    """Repeated starts ``run, low, high`` from ``key, run, low, times, text`` in ascending order of the keys."""

    def search(runs: list[int], lows: list[int], once: list[bool], texts: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in texts])
        # UTF-8 has no byte FF, so every byte can move up by one and leave 0 for the end.
        data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)
        ends = np.cumsum(sizes + 1) - 1
        owner = np.repeat(np.arange(len(texts)), sizes + 1)
        left = ends[owner] - np.arange(len(data))
        found = repeated(data, left, length)
        found = found[np.array(once)[owner[found]]]
        text, inner = owner[found], found - (ends - sizes)[owner[found]]
        head = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (inner[1:] != inner[:-1] + 1))) if len(found) else found
        count = np.diff(np.append(head, len(found)))
        low = inner[head] + np.array(lows, np.int64)[text[head]]
        numbers = np.array(runs, np.int64)[text[head]]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(low, pa.int64()), pa.array(low + count, pa.int64())],
                                          ["run", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        runs, lows, once, texts, size, last = [], [], [], [], 0, None
        for batch in batches:
            for key, number, low, times, text in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if key != last and size >= ARRAY:
                    yield search(runs, lows, once, texts)
                    runs, lows, once, texts, size = [], [], [], [], 0
                runs.append(number)
                lows.append(low)
                once.append(times == 1)
                texts.append(text)
                size += len(text)
                last = key
        if runs:
            yield search(runs, lows, once, texts)

    return run


def _cleaned(length: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for row in range(batch.num_rows):
                content, lows, highs = unpack(batch.column(1)[row].as_py()), [], []
                if batch.column(2)[row].is_valid:
                    ranges = batch.column(2).slice(row, 1).flatten()
                    low = ranges.field("low").to_numpy()
                    order = np.argsort(low, kind="stable")
                    # The last start of a range covers its own length; overlapping and touching ranges are one.
                    low, high = low[order], ranges.field("high").to_numpy()[order] + length - 1
                    reach = np.maximum.accumulate(high)
                    head = np.flatnonzero(np.append(True, low[1:] > reach[:-1]))
                    lows, highs = low[head].tolist(), reach[np.append(head[1:] - 1, len(low) - 1)].tolist()
                digest, at = hashlib.sha256(), 0
                for a, b in zip(lows, highs, strict=True):
                    digest.update(content[at:a])
                    at = b
                digest.update(content[at:])
                for column, value in zip(out, (len(content), sum(highs) - sum(lows), len(lows), digest.hexdigest(),
                                               [{"low": a, "high": b} for a, b in zip(lows, highs, strict=True)]), strict=True):
                    column.append(value)
            kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string()), pa.array(out[4], kind)], names)

    return run


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   large: int = LARGE) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    ``spans`` lists the removed byte ranges ``low`` (in) to ``high`` (out) of the text in UTF-8. A null text is
    empty. Rows that repeat id and text have the same spans, and each is a copy of the other. A null id is kept
    as null. An empty table gives an empty result; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*row_key(doc_id, text), F.col(text).alias("text"))
    counts = _runs(rows, length, gram, False).groupBy("anchor").agg(F.count(F.lit(1)).alias("times"))
    # Written out, so that both sides of the join pass an exchange and a hot anchor can be split.
    often = materialized(counts.where("times > 1").select("anchor"), "anchors")
    runs = _runs(rows, length, gram, True).join(often, "anchor", "left_semi")
    runs = materialized(runs, "runs")
    unique = runs.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("did", "tag", "start", "n", "at")).alias("place"))
    unique = materialized(unique.withColumn("run", F.monotonically_increasing_id()), "unique-runs")
    groups = unique.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"), F.min("times").alias("least"))
    groups = materialized(groups.where("different > 1 AND least = 1").select("anchor"), "anchor-groups")
    wanted = unique.join(groups, "anchor").select("anchor", "run", "times", "place.*")
    texts = materialized(_texts(packed(rows, "text", "frame"), wanted, length), "texts")
    found = _repeated_starts(texts, length, gram, large)
    single = unique.select("anchor", "digest", "run").join(found, "run").select("anchor", "digest", "low", "high")
    whole = unique.where("times > 1").select(
        "anchor", "digest", F.lit(0).cast("long").alias("low"), F.col("place.n").cast("long").alias("high"))
    ranges = runs.join(single.union(whole), ["anchor", "digest"]).select(
        "did", "tag", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
    # Rows that repeat id and text have one list: equal ranges are merged before the shuffle.
    lists = ranges.groupBy("did", "tag").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    keyed = packed(docs.select(F.col(doc_id).cast("long").alias("doc_id"), *row_key(doc_id, text), F.col(text).alias("text")), "text", "frame")
    joined = keyed.join(lists, ["did", "tag"], "left").select("doc_id", "frame", "ranges")
    return joined.mapInArrow(
        _cleaned(length),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<low: long, high: long>>")
