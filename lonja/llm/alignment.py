"""Alignment of the token sequences that two tokenizers give for the same bytes.

Byte offsets at which tokens of both sides end cut a text into groups. The cumulative ends of each side are the
keys of a dictionary from end to token index; the intersection of the two key sets, sorted, slices both id lists
into groups, and each slice is expanded into links, the pairs of tokens whose byte ranges overlap.

Both tokenizers part a text at every space between two visible characters, so a text is a sequence of units
(words, mostly), each with one space before it, and units can be aligned on their own. A task aligns every unit
once and keeps it. Its documents go out in blocks of bounded size: word by word the unit, unit by unit the
links, and the distinct id pairs of the block with their counts. Corpus-wide counts are an aggregate over the
pairs of all blocks; each block gets back the counts of its own pairs, so nothing is broadcast that grows with
the corpus.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.rows import small_batches
from lonja.llm.tokens import Encoder, default_vocabulary, gathered, ragged, uneven, worker_cache
from lonja.session import materialized

#: A worker process forgets its units when it holds this many, or this many bytes of them.
KEPT, KEPT_BYTES = 200_000, 48 << 20
#: Units aligned at once, and bytes of text of a block.
STEP, BLOCK_BYTES = 20_000, 4 << 20
_LOW = (1 << 32) - 1


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_groups(a_sizes: list[int], b_sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups ``a_low, a_high, b_low, b_high`` (token indices) between the ends that both sides share."""
    ends = []
    for sizes in (a_sizes, b_sizes):
        total, index = 0, {}
        for place, size in enumerate(sizes, 1):
            total += size
            index[total] = place
        ends.append(index)
    first, second = ends
    groups, a_low, b_low = [], 0, 0
    for end in sorted(first.keys() & second.keys()):
        groups.append((a_low, first[end], b_low, second[end]))
        a_low, b_low = first[end], second[end]
    return groups


def group_links(a_sizes: list[int], b_sizes: list[int], group: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Index pairs of the tokens of a group whose byte ranges overlap."""
    a, a_high, b, b_high = group
    links, a_end, b_end = [], a_sizes[a], b_sizes[b]
    while True:
        links.append((a, b))
        a_next, b_next = a_end <= b_end, b_end <= a_end
        a, b = a + a_next, b + b_next
        if a >= a_high or b >= b_high:
            return links
        if a_next:
            a_end += a_sizes[a]
        if b_next:
            b_end += b_sizes[b]


def byte_values() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: visible Latin-1 stands for itself, the rest follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Aligner:
    """Aligned units of one worker process: ids, sizes, groups and links of each, kept in flat arrays."""

    def __init__(self, vocabulary: str, pieces: str):
        from sentencepiece import SentencePieceProcessor

        self.first = Encoder(vocabulary)
        self.first.model.encode_special_tokens = True  # special tokens in a text are plain text
        self.second = SentencePieceProcessor(model_file=pieces)
        value = byte_values()
        words = self.first.model.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            # An added token holds characters of the text itself.
            self.a_bytes[i] = bytes(value[c] for c in word) if all(c in value for c in word) else word.encode()
        self.b_bytes = []
        for i in range(self.second.vocab_size()):
            piece = self.second.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 4), np.int64)  # tokens of both sides, groups, whether the bytes agree
        self.links, self.at, self.held = np.zeros(0, np.int64), np.zeros(1, np.int64), 0

    def encode(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The units in another order, and flat ids with n + 1 offsets of both sides, each unit with a space before it.

        A unit whose bytes a side does not give back has no ids.
        """
        plain, odd = [u for u in units if " " not in u], [u for u in units if " " in u]
        units = plain + odd
        found = [self.first.spaced(pa.array(plain, pa.string())), self.first.each([" " + u for u in odd])]
        a, a_counts = (np.concatenate(x) for x in zip(*found, strict=True))
        lists = self.second.encode(units, out_type=int, num_threads=1) if units else []
        b_counts = np.fromiter(map(len, lists), np.int64, len(lists))
        b = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(b_counts.sum()))
        a_at, b_at = (np.concatenate([[0], np.cumsum(x)]) for x in (a_counts, b_counts))
        content = [b" " + u.encode() for u in units]
        first, second = list(map(self.a_bytes.__getitem__, a.tolist())), list(map(self.b_bytes.__getitem__, b.tolist()))
        lengths = np.array([len(c) for c in content])
        whole = all((np.add.reduceat(sizes[ids], at[:-1]) == lengths).all() for sizes, ids, at in (
            (self.a_sizes, a, a_at), (self.b_sizes, b, b_at))) if units and min(a_counts.min(), b_counts.min()) else False
        if not whole or not b"".join(first) == b"".join(content) == b"".join(second):
            same = np.array([
                b"".join(first[a_at[i] : a_at[i + 1]]) == c == b"".join(second[b_at[i] : b_at[i + 1]]) for i, c in enumerate(content)
            ], bool)
            a, b = a[np.repeat(same, a_counts)], b[np.repeat(same, b_counts)]
            a_at, b_at = (np.concatenate([[0], np.cumsum(np.where(same, x, 0))]) for x in (a_counts, b_counts))
        return units, a, a_at, b, b_at

    def learn(self, units: list[str]) -> None:
        """Align new units: ids of both sides, groups, links.

        Every unit ends where tokens of both sides end, so units laid one after the other are aligned as one text.
        """
        units, a, a_at, b, b_at = self.encode(units)
        a_sizes, b_sizes = self.a_sizes[a].tolist(), self.b_sizes[b].tolist()
        groups = np.array(token_groups(a_sizes, b_sizes), np.int64).reshape(-1, 4)
        a_low, a_high, b_low, b_high = groups.T
        group_at = np.searchsorted(a_low, a_at)
        a_many, b_many = a_high - a_low, b_high - b_low
        # With one token on a side, all tokens of the other overlap it.
        simple = (a_many == 1) | (b_many == 1)
        hard = {g: group_links(a_sizes, b_sizes, tuple(groups[g].tolist())) for g in np.flatnonzero(~simple).tolist()}
        counts = a_many * b_many
        counts[list(hard)] = [len(x) for x in hard.values()]
        first = np.cumsum(counts) - counts
        inner = np.arange(int(counts.sum())) - np.repeat(first, counts)
        x = np.repeat(a_low, counts) + np.where(np.repeat(a_many > 1, counts), inner, 0)
        y = np.repeat(b_low, counts) + np.where(np.repeat(b_many > 1, counts), inner, 0)
        for g, links in hard.items():
            x[first[g] : first[g] + counts[g]], y[first[g] : first[g] + counts[g]] = zip(*links, strict=True)
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        shown = [
            a_text[g] + "|" + b_text[i] if h - g == 1 and j - i == 1 else ",".join(a_text[g:h]) + "|" + ",".join(b_text[i:j])
            for g, h, i, j in groups.tolist()
        ]
        texts = [";".join(shown[g:h]) for g, h in zip(group_at[:-1].tolist(), group_at[1:].tolist(), strict=True)]
        before = len(self.groups)
        self.index.update(zip(units, range(before, before + len(units)), strict=True))
        self.groups += texts
        numbers = np.stack([np.diff(a_at), np.diff(b_at), np.diff(group_at), np.diff(a_at) > 0], axis=1)
        self.numbers = np.concatenate([self.numbers, numbers])
        self.links = np.concatenate([self.links, a[x].astype(np.int64) << 32 | b[y].astype(np.int64)])
        link_at = np.concatenate([[0], np.cumsum(counts)])[group_at]
        self.at = np.concatenate([self.at, self.at[-1] + link_at[1:]])
        self.held += sum(map(len, units)) + sum(map(len, texts)) + 8 * int(counts.sum())

    def places(self, units: list[str]) -> np.ndarray:
        """Numbers of the (distinct) units in this object's arrays."""
        if len(self.groups) > KEPT or self.held > KEPT_BYTES:
            self.forget()
        new = [u for u in units if u and u not in self.index]
        for at in range(0, len(new), STEP):
            self.learn(new[at : at + STEP])
        return np.fromiter((self.index.get(u, -1) for u in units), np.int64, len(units))


def shared_aligner(vocabulary: str, pieces: str) -> Aligner:
    cache = worker_cache()
    if ("aligner", vocabulary, pieces) not in cache:
        cache["aligner", vocabulary, pieces] = Aligner(vocabulary, pieces)
    return cache["aligner", vocabulary, pieces]


def units_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Order of the texts, their n + 1 offsets in the words, the unit of each word, and the distinct units.

    A text is cut at every space between two characters that are not white space.
    """
    odd = uneven(texts)
    order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
    lists = [pc.split_pattern(texts.filter(pa.array(~odd)), " ")]
    cut = re.compile(r"(?<=\S) (?=\S)").split
    lists.append(pa.array([cut(t) for t in texts.filter(pa.array(odd)).to_pylist()], pa.list_(pa.string())))
    whole = pa.concat_arrays([x.cast(pa.list_(pa.string())) for x in lists])
    coded = whole.flatten().dictionary_encode()
    at = np.concatenate([[0], np.cumsum(whole.value_lengths().to_numpy())])
    return order, at, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


_BLOCK = ("doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
          "word_at binary, words binary, unit_sizes binary, unit_pairs binary, pair array<long>, times array<long>")
_REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _blocks(vocabulary: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        aligner = shared_aligner(vocabulary, pieces)
        for batch in gathered(batches, 1, BLOCK_BYTES):
            order, at, words, units = units_of(batch.column(1).fill_null(""))
            place = aligner.places(units)
            # Number -1 (an empty text) is the last row of the tables: no tokens.
            numbers = np.concatenate([aligner.numbers, np.zeros((1, 4), np.int64)])[place][words]
            sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(numbers, axis=0)])
            sums = sums[at[1:]] - sums[at[:-1]]
            sizes = np.diff(at)
            good = sums[:, 3] == sizes
            sums[~good] = 0
            kept = words[np.repeat(good, sizes)]
            shown = [aligner.groups[p] if p >= 0 else "" for p in place.tolist()]
            marks = [
                hashlib.sha256(";".join([shown[w] for w in words[a:b].tolist()]).encode()).hexdigest() if fine else ""
                for a, b, fine in zip(at[:-1].tolist(), at[1:].tolist(), good.tolist(), strict=True)
            ]
            # An empty text is one empty unit, whose bytes never agree.
            starts, lengths = np.append(aligner.at[:-1], 0)[place], np.append(np.diff(aligner.at), 0)[place]
            pair, inverse = np.unique(ragged(aligner.links, starts, lengths), return_inverse=True)
            often = np.bincount(kept, minlength=len(units))
            times = np.bincount(inverse, weights=np.repeat(often, lengths), minlength=len(pair)).astype(np.int64)
            word_at = np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))]).astype("<i8")

            def one(values, kind=pa.int64()) -> pa.Array:
                return pa.array([values], pa.list_(kind))

            def packed(values: np.ndarray, kind: str = "<i4") -> pa.Array:
                return pa.array([squeeze(values.astype(kind).tobytes())], pa.binary())

            yield pa.RecordBatch.from_arrays([
                one(batch.column(0).take(pa.array(order)).to_pylist()), *(one(sums[:, c]) for c in range(3)), one(marks, pa.string()),
                packed(word_at, "<i8"), packed(kept), packed(lengths), packed(inverse), one(pair), one(times),
            ], _names(_BLOCK))

    return run


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the links of each document, from the corpus-wide counts of the block's pairs."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row in range(batch.num_rows):
            lists = [batch.column(c).slice(row, 1).flatten() for c in range(5)]
            word_at, words, sizes, inverse = (
                np.frombuffer(unpack(batch.column(c)[row].as_py()), kind).astype(np.int64)
                for c, kind in ((5, "<i8"), (6, "<i4"), (7, "<i4"), (8, "<i4")))
            found = batch.column(9).slice(row, 1).flatten()
            values = np.zeros((len(found), 2), np.int64)
            place = found.field("place").to_numpy(zero_copy_only=False)
            values[place, 0] = found.field("best").to_numpy(zero_copy_only=False)
            values[place, 1] = found.field("count").to_numpy(zero_copy_only=False)

            def summed(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
                total = np.concatenate([np.zeros((1, rows.shape[1]), np.int64), np.cumsum(rows, axis=0)])
                return total[at[1:]] - total[at[:-1]]

            links = np.concatenate([np.ones((len(inverse), 1), np.int64), values[inverse]], axis=1)
            per_unit = summed(links, np.concatenate([[0], np.cumsum(sizes)]))
            per_doc = summed(per_unit[words], word_at)
            yield pa.RecordBatch.from_arrays(
                [*lists[:4], *(pa.array(per_doc[:, c]) for c in range(3)), lists[4]], _names(_REPORT))


def _pairs(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.posexplode(F.arrays_zip("pair", "times")).alias("place", "entry")).select(
        "block", "place", "entry.pair", "entry.times")


def _aligned_blocks(docs: DataFrame, doc_id: str, text: str, vocabulary: str | None, pieces: str | None) -> DataFrame:
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = rows.mapInArrow(_blocks(vocabulary or default_vocabulary(), pieces or default_pieces()), _BLOCK)
    return materialized(blocks.withColumn("block", F.monotonically_increasing_id()), "aligned")


def _counts(blocks: DataFrame) -> DataFrame:
    return _pairs(blocks).groupBy("pair").agg(F.sum("times").alias("count")).where("count > 0").withColumn(
        "b_id", F.col("pair").bitwiseAND(F.lit(_LOW)))


def pair_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                pieces: str | None = None) -> DataFrame:
    """``a_id, b_id, count``: how many links of the corpus hold each pair of ids. Cases as in ``link_report``."""
    counts = _counts(_aligned_blocks(docs, doc_id, text, vocabulary, pieces))
    return counts.select(F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("b_id").cast("int").alias("b_id"), "count")


def link_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                pieces: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A null or empty text, or one whose bytes one of the tokenizers does not give back, has no tokens: zeros, and
    an empty string for the hash. Special tokens inside a text are plain text. A null id is kept as null; rows
    that repeat are each counted and reported. An empty table gives an empty result; other columns are not read.
    """
    blocks = _aligned_blocks(docs, doc_id, text, vocabulary, pieces)
    counts = _counts(blocks)
    # One row per id of the second vocabulary at most.
    best = counts.groupBy("b_id").agg(F.max("count").alias("most"))
    counts = counts.join(F.broadcast(best), "b_id").select(
        "pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    # A pair occurs once in a block, so a block's list is bounded by its text.
    answers = _pairs(blocks).join(counts, "pair", "left").groupBy("block").agg(F.collect_list(F.struct(
        "place", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("best", F.lit(0)).alias("best"))).alias("answers"))
    none = F.array().cast("array<struct<place:int,count:bigint,best:bigint>>")
    joined = blocks.drop("pair", "times").join(answers, "block", "left").withColumn("answers", F.coalesce("answers", none))
    return joined.select(*_names(_BLOCK)[:-2], "answers").mapInArrow(_finished, _REPORT)


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
            pieces: str | None = None) -> DataFrame:
    """``doc_id, groups``: the id lists ``a, b`` of each group in text order. Cases as in ``link_report`` (no groups)."""
    small_batches(docs.sparkSession)
    names, kind = ["doc_id", "groups"], pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
    vocabulary, pieces = vocabulary or default_vocabulary(), pieces or default_pieces()

    def ids(side: str) -> list[int]:
        return [int(x) for x in side.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared_aligner(vocabulary, pieces)
        for batch in gathered(batches, 1, BLOCK_BYTES):
            order, at, words, units = units_of(batch.column(1).fill_null(""))
            place = aligner.places(units)
            # None where the bytes do not agree: such a text has no groups.
            shown = [aligner.groups[p] if p >= 0 and aligner.numbers[p, 3] else None for p in place.tolist()]
            cut = [None if s is None else [dict(zip("ab", map(ids, g.split("|")), strict=True)) for g in s.split(";")] for s in shown]
            for row, number in enumerate(order.tolist()):
                mine = words[at[row] : at[row + 1]].tolist()
                groups = [] if any(shown[w] is None for w in mine) else [g for w in mine for g in cut[w]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(number, 1), pa.array([groups], kind)], names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")
