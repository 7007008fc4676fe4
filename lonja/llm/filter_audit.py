"""How filters interact: what each of them removes in every order of application.

Five filters judge a document; a mask keeps the ones it fails, one bit each. Four are read off the text, the
fifth fails a text that a smaller id has as well. Everything asked about orders depends on the counts of
documents by mask only, so the corpus is read once, and the 120 orders are computed from 32 counts per part.

Duplicates are found in radix tries:

1. Each input task inserts its texts into a trie, a bounded number of bytes at a time. A terminal holds the
   smallest id met, so all but one row of a local group of copies are decided at once and their texts go no further.
2. What is left is dealt by a prefix of the text, as long as it has to be: the bytes below each prefix of 8, 64,
   512, ... bytes are summed, and a text takes its shortest prefix below which at most a bounded number of bytes
   lies. Equal texts take equal prefixes. Range partitions of these prefixes stay even, however many texts share
   their beginning.
3. Each range task inserts whole texts, bucket after bucket, into a trie whose terminals hold the smallest id,
   and traverses it for the duplicate flags. A very frequent text is one terminal.
4. Masks are counted by partial aggregates, joined with the labels on the id.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.radix_trie import RadixTrie
from lonja.llm.rows import small_batches
from lonja.session import materialized

#: Bit k of a mask is set if a document fails the k-th of these filters.
FILTERS = "ABCDE"
DUPLICATE = 16
#: Texts inserted into one trie, in bytes; also the least weight of a prefix that is made longer.
BUCKET = 16 << 20
#: At most this many prefixes of one length are made longer (their weight rises with the input beyond 16 TiB).
HEAVY = 1 << 20
ROWS = "doc_id long, part string, mask int, n long"


def mask_of(text: bytes) -> int:
    """The filters A to D that a text fails.

    A: under 200 words; B: fewer than half of the words are distinct; C: more than 2 % of the characters are
    A to Z; D: it holds one of ``#$%&*|``. Words are runs without ASCII white space.
    """
    found = text.split()  # ASCII white space: space and 09 to 0D
    content = np.frombuffer(text, np.uint8)
    points = int(np.count_nonzero((content & 0xC0) != 0x80))
    capitals = int(np.count_nonzero((content >= 65) & (content <= 90)))
    return (
        (len(found) < 200)
        | (100 * len(set(found)) < 50 * len(found)) << 1
        | (100 * capitals > 2 * points) << 2
        | (re.search(rb"[#$%&*|]", text) is not None) << 3
    )


class _Least:
    """Smallest ids of texts, and the rows decided so far, counted by ``(doc_id, part, mask)``.

    A terminal's value: smallest id, mask of the text, counts by part of the rows with that id.
    """

    def __init__(self):
        self.trie, self.decided, self.size = RadixTrie(), Counter(), 0

    def add(self, text: bytes, doc_id: int | None, part: str, n: int, mask: int | None = None) -> None:
        node = self.trie.node(text)
        if node.value is None:
            node.value = [None, mask_of(text) if mask is None else mask, Counter()]
            self.size += len(text)
        value = node.value
        if doc_id is None:  # neither smaller nor larger than any other id
            self.decided[None, part, value[1]] += n
        elif value[0] is None or doc_id < value[0]:
            self._beaten(value)
            value[0], value[2] = doc_id, Counter({part: n})
        elif doc_id == value[0]:
            value[2][part] += n
        else:
            self.decided[doc_id, part, value[1] | DUPLICATE] += n

    def _beaten(self, value: list) -> None:
        for part, n in value[2].items():
            self.decided[value[0], part, value[1] | DUPLICATE] += n

    def finish(self) -> None:
        """Decide the rows with the smallest ids too."""
        for node in self.trie.terminals():
            for part, n in node.value[2].items():
                self.decided[node.value[0], part, node.value[1]] += n


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64())
    return [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)]


def _ladder(text: bytes, hashed) -> list[int]:
    """Hashes of the prefixes of 8, 64, 512, ... bytes, up to the whole text."""
    steps, size, turn = [], 8, 0
    while True:
        steps.append(hashed(text[:size], turn) - (1 << 63))
        if size >= len(text):
            return steps
        size, turn = 8 * size, turn + 1


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decided rows, and undecided ones with their text and its prefixes."""
    import xxhash

    names = ["doc_id", "part", "mask", "n", "text", "ladder"]

    def flushed(seen: _Least) -> Iterator[pa.RecordBatch]:
        open_rows, held = [], 0
        for text, value in ends(seen.trie):
            for part, n in value[2].items():
                open_rows.append(((value[0], part, value[1], n), text))
                held += len(text)
            if held >= 1 << 20:
                yield batch_of(open_rows)
                open_rows, held = [], 0
        open_rows += [((*key, n), None) for key, n in seen.decided.items()]
        yield batch_of(open_rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        texts = [text for _, text in rows]
        ladders = [None if text is None else _ladder(text, xxhash.xxh64_intdigest) for text in texts]
        return pa.RecordBatch.from_arrays(
            [*_columns([row for row, _ in rows]), pa.array(texts, pa.binary()), pa.array(ladders, pa.list_(pa.int64()))], names)

    def ends(trie: RadixTrie) -> Iterator[tuple[bytes, list]]:
        waiting = [(trie.root, b"")]
        while waiting:
            node, before = waiting.pop()
            text = before + node.label
            if node.value is not None:
                yield text, node.value
            waiting.extend((child, text) for child in node.children.values())

    seen = _Least()
    for batch in batches:
        for doc_id, part, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            seen.add(text, doc_id, part, 1)
            if seen.size >= BUCKET or len(seen.decided) >= 1 << 16:
                yield from flushed(seen)
                seen = _Least()
    yield from flushed(seen)


def _prefixed(heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = batch.column(5)
            flat, at = steps.flatten().to_numpy(), np.concatenate([[0], np.cumsum(steps.value_lengths().to_numpy())])
            where = np.searchsorted(heavy, flat)
            is_heavy = heavy[np.minimum(where, len(heavy) - 1)] == flat if len(heavy) else np.zeros(len(flat), bool)
            prefixes = []
            for row, text in enumerate(batch.column(4).to_pylist()):
                light = np.flatnonzero(~is_heavy[at[row] : at[row + 1]])
                turn = int(light[0]) if len(light) else int(at[row + 1] - at[row]) - 1
                prefixes.append(text[: 8 ** (turn + 1)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(prefixes, pa.binary())], ["doc_id", "part", "mask", "n", "text", "prefix"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flags of the texts of a range, which come bucket by bucket."""

    def flushed(seen: _Least) -> pa.RecordBatch:
        seen.finish()
        return pa.RecordBatch.from_arrays(_columns([(*key, n) for key, n in seen.decided.items()]), ["doc_id", "part", "mask", "n"])

    seen, last = _Least(), None
    for batch in batches:
        for doc_id, part, mask, n, text, prefix in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
            if prefix != last and seen.size >= BUCKET:
                yield flushed(seen)
                seen = _Least()
            last = prefix
            seen.add(text, doc_id, part, n, mask)
            if len(seen.decided) >= 1 << 16:  # a frequent text leaves many decided rows
                rows, seen.decided = seen.decided, Counter()
                yield pa.RecordBatch.from_arrays(_columns([(*key, n) for key, n in rows.items()]), ["doc_id", "part", "mask", "n"])
    yield flushed(seen)


def masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc_id, part, mask, n``: all rows counted by id, part and the set of filters they fail.

    A null text is empty, a null part the empty string. A null id is neither smaller nor larger than another:
    such a row is never a duplicate and makes none. Rows with equal id and text are not duplicates of each other.
    An empty table gives no rows; columns other than the three named are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    local = materialized(rows.mapInArrow(_local, f"{ROWS}, text binary, ladder array<long>"), "local-tries")
    undecided = local.where("text IS NOT NULL")
    size = F.octet_length("text").cast("long")
    total = undecided.agg(F.sum(size)).first()[0] or 0
    weights = undecided.select(F.explode("ladder").alias("step"), size.alias("bytes")).groupBy("step").agg(F.sum("bytes").alias("bytes"))
    # Each length has at most total / limit heavy prefixes, so at most HEAVY of them.
    heavy = weights.where(F.col("bytes") > max(BUCKET, total // HEAVY)).select("step").toArrow()["step"].to_numpy()
    dealt = undecided.mapInArrow(_prefixed(np.sort(heavy)), f"{ROWS}, text binary, prefix binary")
    dealt = dealt.repartitionByRange("prefix").sortWithinPartitions("prefix")
    found = dealt.mapInArrow(_merged, ROWS).union(local.where("text IS NULL").select("doc_id", "part", "mask", "n"))
    return found.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


def _orders() -> tuple[list[tuple[str, int]], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The 600 steps, and for each the masks that are kept, removed, redundant, failing it alone, and its shares."""
    steps, mask = [], np.arange(32)
    kept, removed, redundant, alone, share = (np.zeros((600, 32), np.int64) for _ in range(5))
    failing = np.array([int(m).bit_count() for m in mask])
    for order in itertools.permutations(range(5)):
        before = 0
        for step, one in enumerate(order):
            row, bit = len(steps), 1 << one
            steps.append(("".join(FILTERS[k] for k in order), step + 1))
            fails = (mask & bit) > 0
            removed[row] = fails & (mask & before == 0)
            redundant[row] = fails & (mask & before > 0)
            before |= bit
            kept[row] = mask & before == 0
            alone[row] = mask == bit
            # Of all orders, the filter comes first among the ones a mask fails in an equal share.
            share[row] = np.where(fails, 120 // np.maximum(failing, 1), 0)
    return steps, kept, removed, redundant, alone, share


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from ``part, mask, n, good, toxic``."""
    schema = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
              "good_lost long, toxic_lost long, shapley long")
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, kept, removed, redundant, alone, share = _orders()
        orders, numbers = pa.array([s[0] for s in steps]), pa.array([s[1] for s in steps], pa.int32())
        for batch in batches:
            for row in range(batch.num_rows):
                found = batch.column(1).slice(row, 1).flatten()
                n, good, toxic = (np.zeros(32, np.int64) for _ in range(3))
                place = found.field("mask").to_numpy()
                for target, name in ((n, "n"), (good, "good"), (toxic, "toxic")):
                    target[place] = found.field(name).to_numpy()
                values = (kept @ n, removed @ n, redundant @ n, alone @ n, removed @ good, removed @ toxic, share @ n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[row].as_py()] * len(steps), pa.string()), orders, numbers, *(pa.array(v) for v in values)], names)

    lists = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 a part
    return lists.mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
          label_id: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """One row per part, order and step: ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``, counts of documents within the part.

    An id with several label rows is good (toxic) if one of them says 1; null labels say nothing, and a null id
    has no label. Nulls, repeated rows and empty tables of documents: see ``masks``.
    """
    marked = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((F.col(good) == 1).cast("long")), F.lit(0)).alias("is_good"),
        F.coalesce(F.max((F.col(toxic) == 1).cast("long")), F.lit(0)).alias("is_toxic"))
    rows = masks(docs, doc_id, text, part).join(marked, "doc_id", "left")
    counts = rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))
    return interactions(counts)
