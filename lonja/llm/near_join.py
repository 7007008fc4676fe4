"""Join of near-duplicate documents: Jaccard similarity of word n-gram sets by MinHash banding.

1. Each text gives ``bands`` band hashes of ``rows`` MinHash values each; both numbers follow from the
   threshold and the wanted recall. Texts with the same words are one class from here on.
2. Classes meet on equal band hashes. In each bucket every member is paired with one leader (the smallest
   class number), so a bucket of n classes gives n - 1 pairs, and each pair is verified on the full n-gram sets.
   Before that, pairs go whose set sizes rule the similarity out, or whose sketches (one bit of each of 256
   MinHash values) differ in more bits than six standard deviations above those of a pair at the threshold.
3. Buckets whose members all ended in one verified component are settled. In the others, members of
   different components are compared as well: by pairs in a small bucket, block by block in a larger one, of
   which only a spanning forest of links comes out. No bucket is too large for that; the largest are compared
   last, if the links from the others have not settled them.
4. Within a component every pair of classes is compared exactly, block by block, to count links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.components import components
from lonja.llm.rows import byte_column, packed, row_key, rows_by_bytes, small_batches
from lonja.llm.words import Hasher, lowered, shingles, stream, unique_in_rows
from lonja.session import materialized

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.99999
MOST_HASHES = 304
SKETCH = 256
#: Classes of different components are paired in buckets up to FEW and compared in blocks in larger ones. Buckets
#: above SPLIT come last, as the links found in the others may have settled them.
FEW = 12
SPLIT = 8192
#: Classes in one block of an exact comparison.
BLOCK = 512
#: Bytes of plain text that are hashed at once; hashing takes some fifty times as much memory.
SLICE = 256 << 10


def banding(threshold: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """Bands and rows with the wanted recall at the threshold, and as many rows as the hash budget allows."""
    best = (1, 1)
    for rows in range(1, most_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))))
        if bands * rows > most_hashes:
            break
        best = (bands, rows)
    return best


def sketch_distance(threshold: float) -> int:
    """Most differing bits that a pair at the threshold shows, with six standard deviations to spare."""
    differ = (1 - threshold) / 2
    return math.ceil(SKETCH * differ + 6 * math.sqrt(SKETCH * differ * (1 - differ)))


def _signatures(docs: DataFrame, doc_id: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, did, tag, cls, grams, bands, sketch``: class digest, number of distinct n-grams and hashes of each text."""
    # The bands may need fewer hashes than the sketch, which takes each hash once.
    hashed = max(bands * rows, SKETCH)
    multiply = (stream(2, hashed) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    add = (stream(3, hashed) >> np.uint64(32)).astype(np.uint32)
    fold = stream(4, rows)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("did", pa.int64()), ("tag", pa.int32()), ("cls", pa.binary()), ("grams", pa.int64()),
        ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        np.seterr(over="ignore")
        hasher = Hasher()
        for batch in batches:
            _, places = byte_column(batch.column(3))
            for start, stop in rows_by_bytes(batch, np.diff(places), SLICE):
                part = batch.slice(start, stop - start)
                data, at = byte_column(lowered(part.column(3)))
                hashes, word_at = hasher.words(data, at)
                # The sizes of the sets: repeats of an n-gram do not count.
                grams, _, gram_at = unique_in_rows(*shingles(hashes, word_at, words))
                digests = [
                    xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(word_at[:-1], word_at[1:], strict=True)
                ]
                counts = np.diff(gram_at)
                full = np.flatnonzero(counts)
                keys = np.zeros((len(counts), bands), np.uint64)
                bits = np.zeros((len(counts), SKETCH // 64), np.int64)
                if len(full):
                    short = (grams >> np.uint64(32)).astype(np.uint32)
                    heads = gram_at[:-1][full]
                    least = np.empty((hashed, len(full)), np.uint32)
                    for i in range(hashed):
                        np.minimum.reduceat(short * multiply[i] + add[i], heads, out=least[i])
                    pick = least[:SKETCH].T * np.uint32(0x9E3779B1) >> np.uint32(31)
                    bits[full] = np.ascontiguousarray(np.packbits(pick.astype(np.uint8), axis=1)).view(np.int64)
                    for band in range(bands):
                        key = np.full(len(full), np.uint64(band + 1) * np.uint64(0x9E3779B97F4A7C15))
                        for row in range(rows):
                            key = (key ^ least[band * rows + row]) * fold[row] | np.uint64(0)
                            key ^= key >> np.uint64(29)
                        keys[full, band] = key
                sizes = np.where(counts > 0, bands, 0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(keys[full].reshape(-1).view(np.int64))
                )
                sketches = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(counts) + 1) * (SKETCH // 64), pa.int32()), pa.array(bits.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(digests, pa.binary()),
                     pa.array(counts, pa.int64()), lists, sketches], schema=schema,
                )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *row_key(doc_id, text), F.col(text).alias("text"))
    return narrow.mapInArrow(
        run, "doc_id long, did long, tag int, cls binary, grams long, bands array<long>, sketch array<long>")


def _similarities(pairs: DataFrame, words: int, least: float) -> DataFrame:
    """Of ``a, b, frame_a, frame_b`` the pairs with at least that Jaccard similarity: ``a, b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        np.seterr(over="ignore")
        open_frame, size, hasher = zstandard.ZstdDecompressor().decompress, zstandard.frame_content_size, Hasher()
        for batch in batches:
            sizes = np.array([size(x) + size(y) for x, y in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)] or [0])
            for start, stop in rows_by_bytes(batch, sizes, SLICE):
                part = batch.slice(start, stop - start)
                texts = [open_frame(x).decode() for c in (2, 3) for x in part.column(c).to_pylist()]
                data, at = byte_column(lowered(pa.array(texts, pa.string())))
                grams, gram_at = shingles(*hasher.words(data, at), words)
                values, owner, ends = unique_in_rows(grams, gram_at)
                n, counts = part.num_rows, np.diff(ends)
                pair = owner % n
                order = np.lexsort((values, pair))
                values, pair = values[order], pair[order]
                shared = (values[1:] == values[:-1]) & (pair[1:] == pair[:-1])
                common = np.bincount(pair[1:][shared], minlength=n)
                union = counts[:n] + counts[n:] - common
                keep = pa.array((union > 0) & (common >= least * union - 1e-9))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], ["a", "b"])

    return pairs.select("a", "b", "frame_a", "frame_b").mapInArrow(run, "a long, b long")


def _compared(words: int, least: float):
    """For two blocks of rows with a ``frame`` (or one block with itself): which pairs have the similarity."""
    import zstandard

    np.seterr(over="ignore")
    open_frame, size, hasher = zstandard.ZstdDecompressor().decompress, zstandard.frame_content_size, Hasher()

    def sets(block):
        frames = pa.RecordBatch.from_arrays([pa.array([row["frame"] for row in block], pa.binary())], ["frame"])
        found = []
        for start, stop in rows_by_bytes(frames, np.array([size(row["frame"]) for row in block]), SLICE):
            texts = [open_frame(row["frame"]).decode() for row in block[start:stop]]
            data, at = byte_column(lowered(pa.array(texts, pa.string())))
            values, owner, ends = unique_in_rows(*shingles(*hasher.words(data, at), words))
            found.append((values, owner + start, np.diff(ends)))
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    def columns(values, owner, both):
        """Rows and columns of the n-grams that are in ``both``, by column."""
        place = np.searchsorted(both, values)
        keep = both[np.minimum(place, len(both) - 1)] == values
        place, owner = place[keep], owner[keep]
        order = np.argsort(place, kind="stable")
        return owner[order], place[order]

    def compare(left, right):
        va, oa, na = sets(left)
        vb, ob, nb = (va, oa, na) if right is None else sets(right)
        common = np.zeros((len(na), len(nb)), np.float32)
        # Only n-grams of two texts count; their columns are taken in slices to bound the matrices.
        if right is None:
            seen, times = np.unique(va, return_counts=True)
            both = seen[times > 1]
        else:
            both = np.intersect1d(va, vb)
        if len(both):
            (row_a, at_a), (row_b, at_b) = columns(va, oa, both), columns(vb, ob, both)
            for at in range(0, len(both), 4096):
                width = min(4096, len(both) - at)
                sa, sb = (slice(*np.searchsorted(x, (at, at + width))) for x in (at_a, at_b))
                ma, mb = np.zeros((len(na), width), np.float32), np.zeros((len(nb), width), np.float32)
                ma[row_a[sa], at_a[sa] - at] = 1
                mb[row_b[sb], at_b[sb] - at] = 1
                common += ma @ mb.T
        linked = common >= least * (na[:, None] + nb[None, :] - common) - 1e-6
        if right is None:
            np.fill_diagonal(linked, False)
        return linked

    return compare


def _block_links(words: int, least: float):
    """Documents linked to each class between two blocks of classes, or inside one: ``node, links``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = _compared(words, least)
        for batch in batches:
            for one, two in zip(batch.column(0), batch.column(1), strict=True):
                left, right = one.as_py(), two.as_py()
                linked = compare(left, right).astype(np.int64)
                for matrix, mine, others in ((linked, left, right), (linked.T, right, left)):
                    if mine is not None:
                        sizes = np.array([row["size"] for row in (others or mine)], np.int64)
                        ids = pa.array([row["node"] for row in mine], pa.int64())
                        yield pa.RecordBatch.from_arrays([ids, pa.array(matrix @ sizes)], ["node", "links"])

    return run


def _block_edges(words: int, least: float):
    """Links between components, seen in two blocks of classes or inside one: a spanning forest ``a, b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = _compared(words, least)
        for batch in batches:
            for one, two in zip(batch.column(0), batch.column(1), strict=True):
                left, right = one.as_py(), two.as_py()
                linked = compare(left, right)
                parent: dict[int, int] = {}

                def top(x):
                    while parent.setdefault(x, x) != x:
                        parent[x] = x = parent[parent[x]]
                    return x

                edges: list[tuple[int, int]] = []
                other = right or left
                for i, j in zip(*np.nonzero(linked), strict=True):
                    a, b = top(left[i]["component"]), top(other[j]["component"])
                    if a != b:
                        parent[a] = b
                        edges.append((left[i]["node"], other[j]["node"]))
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _block_pairs(blocks: DataFrame, group: str) -> DataFrame:
    """``items, more``: each block of a group with itself (``more`` null) and with each later one."""
    blocks = materialized(blocks, "blocks")
    other = blocks.select(group, F.col("block").alias("other"), F.col("items").alias("more"))
    inside = blocks.select("items", F.lit(None).cast(blocks.schema["items"].dataType).alias("more"))
    return inside.union(blocks.join(other, group).where("block < other").select("items", "more"))


class NearJoin:
    """The steps of the join over one document table; see the module's text."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                 threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = MOST_HASHES):
        small_batches(docs.sparkSession)
        self.words, self.threshold = words, threshold
        self.bands, self.rows = banding(threshold, recall, most_hashes)
        self.rows_of = docs.select(*row_key(doc_id, text), F.col(text).alias("text"))
        self.members = materialized(_signatures(docs, doc_id, text, words, self.bands, self.rows), "signatures")
        self.classes = self._classes()
        self.buckets = self._buckets()

    def _classes(self) -> DataFrame:
        """``node, cls, size, best, bands, grams, sketch``: one row per distinct sequence of words."""
        full = self.members.where("grams > 0")
        rank = F.struct(F.col("doc_id").isNull(), "doc_id", "did", "tag")
        groups = full.groupBy("cls").agg(F.count(F.lit(1)).alias("size"), F.min(rank).alias("best"), F.first("bands").alias("bands"),
            F.first("grams").alias("grams"), F.first("sketch").alias("sketch"))
        return materialized(groups.withColumn("node", F.monotonically_increasing_id()), "classes")

    def _buckets(self) -> DataFrame:
        """``key, node`` of the band buckets with two or more classes, and each bucket's ``leader``."""
        keys = self.classes.select("node", F.explode("bands").alias("key"))
        leaders = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1")
        # Written out, so that both sides of the join pass an exchange and a hot bucket can be split.
        leaders = materialized(leaders, "leaders")
        return materialized(keys.join(leaders, "key").select("key", "node", "leader", "n"), "buckets")

    def _frames(self) -> DataFrame:
        """``node, frame``: compressed texts of the classes that share a bucket."""
        used = self.buckets.select("node").distinct()
        wanted = self.classes.join(used, "node").select("node", "best.did", "best.tag")
        texts = packed(self.rows_of, "text", "frame")
        return materialized(texts.join(wanted, ["did", "tag"]).dropDuplicates(["node"]).select("node", "frame"), "frames")

    def _outline(self, node: str) -> DataFrame:
        """Size and sketch of each class under names that end in the name of the node."""
        bits = [F.col("sketch")[i].alias(f"s{i}_{node}") for i in range(SKETCH // 64)]
        return self.classes.select(F.col("node").alias(node), F.col("grams").alias(f"grams_{node}"), *bits)

    def _possible(self):
        """Whether sizes and sketches of ``a`` and ``b`` allow the similarity."""
        differ = sum((F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b"))) for i in range(1, SKETCH // 64)),
                     F.bit_count(F.col("s0_a").bitwiseXOR(F.col("s0_b"))))
        least, most = F.least("grams_a", "grams_b"), F.greatest("grams_a", "grams_b")
        return (least >= F.lit(self.threshold - 1e-9) * most) & (differ <= sketch_distance(self.threshold))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(self._outline("a"), "a").join(self._outline("b"), "b").where(self._possible()).select("a", "b")
        with_a = pairs.join(self.frames.select(F.col("node").alias("a"), F.col("frame").alias("frame_a")), "a")
        with_b = with_a.join(self.frames.select(F.col("node").alias("b"), F.col("frame").alias("frame_b")), "b")
        return materialized(_similarities(with_b, self.words, self.threshold), "verified")

    def components(self) -> DataFrame:
        """``node, component`` of the classes that are linked to another class."""
        self.frames = self._frames()
        stars = self.buckets.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        edges = self._verified(stars)
        labels = components(edges)
        # The one pair of a bucket of two was a star pair.
        for sizes in (F.col("n").between(3, SPLIT), F.col("n") > F.greatest(F.lit(SPLIT), F.lit(2))):
            rows = self.buckets.where(sizes).select("key", "node")
            if rows.isEmpty():
                continue
            more = materialized(self._open_links(rows, labels), "open-links")
            if not more.isEmpty():
                edges = edges.union(more)
                labels = components(edges)
        return labels

    def _open_links(self, rows: DataFrame, labels: DataFrame) -> DataFrame:
        """Links between classes of different components in one bucket of ``key, node``, as many as connect the components."""
        own = F.coalesce("component", "node").alias("component")
        rows = rows.join(labels, "node", "left").select("key", "node", own)
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
        counts = materialized(counts.where("x <> y").select("key", "n"), "open-buckets")
        rows = materialized(rows.join(counts, "key"), "open")
        few = rows.where(F.col("n") <= FEW)
        a = few.select("key", F.col("node").alias("a"), F.col("component").alias("ca"))
        b = few.select("key", F.col("node").alias("b"), F.col("component").alias("cb"))
        pairs = a.join(b, "key").where("a < b AND ca <> cb").select("a", "b").distinct()
        many = rows.where(F.col("n") > FEW)
        blocks = many.join(self.frames, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / F.lit(BLOCK))))
        blocks = blocks.groupBy("key", "block").agg(F.collect_list(F.struct("node", "component", "frame")).alias("items"))
        found = _block_pairs(blocks, "key").mapInArrow(_block_edges(self.words, self.threshold), "a long, b long")
        return found.union(self._verified(pairs)).distinct()

    def links(self, labels: DataFrame) -> DataFrame:
        """``node, links``: documents linked to each class, other classes only."""
        sizes = materialized(labels.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks")), "sizes")
        rows = labels.join(sizes, "component").join(self.frames, "node").join(self.classes.select("node", "size"), "node")
        rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        blocks = rows.groupBy("component", "block").agg(F.collect_list(F.struct("node", "size", "frame")).alias("items"))
        counts = _block_pairs(blocks, "component").mapInArrow(_block_links(self.words, self.threshold), "node long, links long")
        return counts.groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, class_size``.

    ``class_id`` is the smallest id among the documents connected by links, ``n_links`` the number of other
    documents whose n-gram set has the wanted similarity (documents with the same words included, repeated rows
    too). A text with fewer than ``words`` words has one n-gram, of all its words. A text without words, or
    null, is linked to nothing and its class is itself. Null ids come last among ids. An empty table gives an
    empty result; other columns are not read.
    """
    join = NearJoin(docs, doc_id, text, words, threshold)
    labels = join.components()
    links = join.links(labels)
    nodes = join.classes.join(labels, "node", "left").join(links, "node", "left").select(
        "node", "cls", "size", "best", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links")
    )
    nodes = materialized(nodes, "nodes")
    tops = nodes.groupBy("component").agg(F.min("best").alias("top"), F.sum("size").alias("class_size"))
    by_class = nodes.join(tops, "component").select(
        "cls", F.col("top.doc_id").alias("class_id"), (F.col("links") + F.col("size") - 1).alias("n_links"), "class_size"
    )
    full = join.members.where("grams > 0").select("doc_id", "cls").join(by_class, "cls").select(
        "doc_id", "class_id", "n_links", "class_size")
    bare = join.members.where("grams = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size"))
    return full.union(bare)


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                         threshold: float = THRESHOLD) -> DataFrame:
    """The document with the smallest id of each class, and every document without words, with all columns.

    Null and empty texts have no words and all stay. A row without an id counts with a hash of its text as id. Of
    rows that repeat id and text one stays, the one with the smallest hash over all columns; so with ties. An empty
    table stays empty.
    """
    join = NearJoin(docs, doc_id, text, words, threshold)
    labels = join.components()
    nodes = join.classes.join(labels, "node", "left").select(F.coalesce("component", "node").alias("component"), "best")
    tops = nodes.groupBy("component").agg(F.min("best").alias("top")).select("top.did", "top.tag", F.lit(True).alias("once"))
    bare = join.members.where("grams = 0").select("did", "tag", F.lit(False).alias("once")).distinct()
    keep = tops.union(bare)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(doc_id, text))
    # Only repeated rows meet in one window group.
    turn = F.row_number().over(Window.partitionBy("did", "tag").orderBy(F.xxhash64("row")))
    return rows.join(keep, ["did", "tag"]).withColumn("turn", turn).where("turn = 1 OR NOT once").select("row.*")
