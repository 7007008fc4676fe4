"""Removal of benchmark passages from training text, with DataFrame functions only.

A window is ``length`` consecutive words of a benchmark item; an item of fewer words is one window of all its
words. The distinct windows are a hash set that every task gets (``broadcast``): its size is counted first, and
a larger set is dealt into slices of at most ``SLICE_BYTES``, each with a scan of its own, so the broadcast never
grows with the benchmark.

Documents are cut into chunks of words that overlap by ``length - 1``. All windows of a chunk leave one generator
as rows of neighbouring words, so the scan needs no shuffle, and the memory of a task depends on one chunk beside
the text itself. A window is looked up by its hash and verified on its words. Only hits are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.session import materialized

LENGTH = 10
CHUNK = 512
#: Bytes of window texts broadcast at once.
SLICE_BYTES = 48 << 20
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything but ASCII letters, digits and characters beyond ASCII.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case; a null text has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _CAPITALS, _SMALL), _BETWEEN), "")


def _key(doc_id: str, text: str) -> list[Column]:
    """Equal for two rows only if id and text are equal; such rows have equal results and may share a key."""
    content = F.coalesce(F.col(text), F.lit(""))
    return [F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(content)).alias("did"),
            F.xxhash64(content, F.length(content)).alias("tag")]


def _starts(frame: DataFrame, keep: list[str], text: str, length: int) -> DataFrame:
    """``keep`` with ``at`` and the words ``w0 ...`` from each word of the text on (null beyond its end)."""

    def cut(every: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(every) - 1), F.lit(CHUNK))
        return F.transform(firsts, lambda first: F.struct(
            first.alias("first"), F.slice(every, first + 1, CHUNK + length - 1).alias("part")))

    # The array of one element names the words once, so that they are not computed again for every chunk.
    chunks = frame.select(*keep, F.explode(F.flatten(F.transform(F.array(words(F.col(text))), cut))).alias("chunk"))
    chunks = chunks.select(*keep, "chunk.first", "chunk.part")
    neighbours = F.arrays_zip(*[F.slice("part", F.lit(k + 1), F.lit(CHUNK)).alias(f"w{k}") for k in range(length)])
    rows = chunks.select(*keep, "first", F.posexplode(neighbours).alias("inner", "window"))
    return rows.select(*keep, (F.col("first") + F.col("inner")).alias("at"), "window.*")


def _joined(size: int) -> Column:
    return F.concat_ws(" ", *[F.col(f"w{k}") for k in range(size)])


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``item, size, gram``: the distinct windows of each item.

    Items are told apart by their id as text (a null id is the empty name); rows with the same id are one item.
    An item without words has no window.
    """
    named = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    rows = _starts(named.withColumn("n", F.size(words(F.col("text")))), ["item", "n"], "text", length)
    full = rows.where(f"n >= {length} AND w{length - 1} IS NOT NULL").select("item", F.lit(length).alias("size"), _joined(length).alias("gram"))
    short = rows.where(f"n < {length} AND at = 0").select("item", F.col("n").alias("size"), _joined(length).alias("gram"))
    return full.unionByName(short).distinct()


def _hits(docs: DataFrame, text: str, windows: DataFrame, length: int) -> DataFrame:
    """``did, tag, at, size, window`` for every place in the documents where a window occurs."""
    totals = windows.groupBy("size").agg(F.sum(F.octet_length("gram") + 24).alias("bytes")).collect()  # length rows at most
    sizes = sorted(row["size"] for row in totals)
    slices = max(1, -(-sum(row["bytes"] for row in totals) // SLICE_BYTES))
    rows = _starts(docs, ["did", "tag"], text, length)
    grams = F.array(*[
        F.struct(F.lit(size).alias("size"), F.when(F.col(f"w{size - 1}").isNotNull(), _joined(size)).alias("gram"))
        for size in sizes or [length]
    ])
    rows = rows.select("did", "tag", "at", F.inline(grams)).where("gram IS NOT NULL").withColumn("hash", F.xxhash64("gram"))
    found = None
    for part in range(slices):
        some = windows.where(F.pmod(F.col("window"), F.lit(slices)) == part)
        some = some.select("window", F.col("gram").alias("known"), F.xxhash64("gram").alias("known_hash"))
        hits = rows.join(F.broadcast(some), (F.col("hash") == F.col("known_hash")) & (F.col("gram") == F.col("known")))
        hits = hits.select("did", "tag", "at", "size", "window")
        found = hits if found is None else found.unionByName(hits)
    return found


def _runs(hits: Column) -> Column:
    """Maximal runs ``low`` (in) to ``high`` (out) of hit words; touching runs are one."""
    empty = F.array().cast("array<struct<low:int,high:int>>")

    def add(runs: Column, hit: Column) -> Column:
        last = F.element_at(runs, -1)
        merged = F.concat(
            F.slice(runs, 1, F.size(runs) - 1),
            F.array(F.struct(last["low"].alias("low"), F.greatest(last["high"], hit["high"]).alias("high"))))
        apart = (F.size(runs) == 0) | (F.get(runs, F.size(runs) - 1)["high"] < hit["low"])
        return F.when(apart, F.concat(runs, F.array(hit))).otherwise(merged)

    return F.aggregate(hits, empty, add)


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items, runs``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` the sorted names of the items that
    such a window belongs to, ``runs`` the hit word ranges (from 0). Null and empty texts have no words; a null
    id is kept as null. Rows that repeat are each reported. Without documents the result is empty, without a
    benchmark nothing is hit. Columns other than the named ones are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), *_key(doc_id, text), F.col(text).alias("text"))
    report = _report(rows, benchmark, item_id, item_text, length)
    counted = rows.select("doc_id", "did", "tag", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return counted.join(report, ["did", "tag"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
        F.coalesce("runs", F.array().cast("array<struct<low:int,high:int>>")).alias("runs"))


def _report(rows: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, length: int) -> DataFrame:
    """``did, tag, n_hit, items, runs`` of the documents with hits; written out, since two joins read it."""
    pairs = materialized(benchmark_windows(benchmark, item_id, item_text, length), "benchmark-windows")
    windows = pairs.groupBy("size", "gram").agg(F.count(F.lit(1)).alias("items"))
    windows = materialized(windows.withColumn("window", F.monotonically_increasing_id()), "windows")
    names = pairs.join(windows.select("size", "gram", "window"), ["size", "gram"]).select("window", "item")
    # A hit twice in the list (rows that repeat id and text) is one: sets are merged before the shuffle.
    hits = _hits(rows, "text", windows, length).groupBy("did", "tag").agg(
        F.collect_set(F.struct(F.col("at").alias("low"), (F.col("at") + F.col("size")).alias("high"))).alias("hits"),
        F.collect_set("window").alias("windows"))
    hits = materialized(hits.select("did", "tag", _runs(F.array_sort("hits")).alias("runs"), "windows"), "hits")
    items = hits.select("did", "tag", F.explode("windows").alias("window")).join(names, "window")
    items = items.groupBy("did", "tag").agg(F.array_sort(F.collect_set("item")).alias("items"))
    n_hit = F.aggregate("runs", F.lit(0), lambda total, run: total + run["high"] - run["low"])
    return hits.select("did", "tag", n_hit.alias("n_hit"), "runs").join(items, ["did", "tag"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", length: int = LENGTH,
                  documents: bool = False) -> DataFrame:
    """The documents, with all their columns, without what the benchmark contains.

    ``documents`` drops each document with a hit. Otherwise the text loses every run of hit words, with what
    stands between them; the characters before and after the run stay. Null, empty and repeated rows and empty
    tables are treated as in ``contamination``; a null text stays null.
    """
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    rows = rows.select("row", "text", *_key("_id", "text"))
    report = _report(rows.select("did", "tag", "text"), benchmark, item_id, item_text, length).select("did", "tag", "runs")
    if documents:
        return rows.join(report, ["did", "tag"], "left_anti").select("row.*")
    inside = F.array_remove(F.split("text", _BETWEEN), "")
    around = F.split("text", _WORD)  # one more than words: what stands before, between and after them

    def kept(pair: Column) -> Column:
        # Each word goes with what stands before it, unless it continues a run.
        def hit(place: Column, late: int) -> Column:
            return F.exists("runs", lambda run: (place >= run["low"] + late) & (place < run["high"]))

        parts = F.transform(F.sequence(F.lit(0), F.size(pair["words"]) - 1), lambda place: F.concat(
            F.when(hit(place, 1), F.lit("")).otherwise(F.get(pair["around"], place)),
            F.when(hit(place, 0), F.lit("")).otherwise(F.get(pair["words"], place))))
        return F.concat(F.array_join(parts, ""), F.element_at(pair["around"], -1))

    pair = F.array(F.struct(inside.alias("words"), around.alias("around")))
    cleaned = F.when(F.col("runs").isNotNull(), F.get(F.transform(pair, kept), F.lit(0))).otherwise(F.col("text"))
    joined = rows.join(report, ["did", "tag"], "left").withColumn("cleaned", cleaned)
    return joined.select(*[
        F.col("cleaned").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns
    ])
