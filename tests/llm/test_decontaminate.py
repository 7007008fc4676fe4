"""Benchmark windows in documents against a plain scan, and the awkward cases."""

import re

import numpy as np
import pytest

from lonja.llm import decontaminate
from lonja.llm.decontaminate import benchmark_windows, contamination
from lonja.llm.queries import op13_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, length=10):
    grams = {}
    for item, text in items:
        found = split(text)
        for at in range(max(1, len(found) - length + 1)) if found else ():
            grams.setdefault(tuple(found[at : at + length]), set()).add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    for doc, text in docs:
        found, hit, names = split(text), set(), set()
        for size in sizes:
            for at in range(len(found) - size + 1):
                gram = tuple(found[at : at + size])
                if gram in grams:
                    hit.update(range(at, at + size))
                    names |= grams[gram]
        yield doc, len(found), len(hit), sorted(names)


@pytest.mark.parametrize("bound", [48 << 20, 400])
def test_against_scan(spark, monkeypatch, bound):
    """Random texts over few words, chunk edges, short items, one window in many items, and several slices."""
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", bound)
    monkeypatch.setattr(decontaminate, "CHUNK", 7)
    rng = np.random.default_rng(2)

    def text(n):
        return "".join(w + s for w, s in zip(rng.choice(["A", "b", "é", "Ñ2", "c"], n), rng.choice([" ", ", ", "\n"], n), strict=True))

    docs = [(i, text(int(n))) for i, n in enumerate(rng.integers(0, 60, 40))]
    items = [(i, text(int(n))) for i, n in enumerate(rng.integers(0, 14, 25))] + [(99, docs[3][1]), (98, docs[3][1]), (97, "b")]
    found = contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), length=4)
    rows = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect())
    assert rows == sorted(plain(docs, items, 4)) and any(r[2] for r in rows)


def test_awkward(spark, awkward, table):
    near = awkward.first().text
    items = spark.createDataFrame(
        [(1, near[:300].upper(), "x"), (None, "ein KURZER text", "x"), (2, None, "x"), (3, "...", "x"), (1, "x", "x")],
        "item_id long, text string, size string")
    source = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    rows = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in contamination(awkward, items).collect()]
    order = lambda row: (row[0] is None, row[0] or 0, row[1])
    expected = plain(source, [(r.item_id, r.text) for r in items.collect()])
    assert sorted(rows, key=order) == sorted(expected, key=order)
    for docs, bench in ((awkward, items.limit(0)), (table([]), items), (table([]), items.limit(0))):
        assert [r.n_hit for r in contamination(docs, bench).collect()] == [0] * docs.count()
    cleaned = decontaminate.decontaminate(awkward, items)
    assert cleaned.columns == awkward.columns and cleaned.count() == len(source)
    assert {r.text for r in cleaned.where("doc_id = 8 OR doc_id = 7").collect()} == {""}
    assert sorted(r[0] or -1 for r in decontaminate.decontaminate(awkward, items, documents=True).select("doc_id").collect()) == [
        -1, 4, 5, 6, 9, 10, 10, 11]


def test_spans_are_cut(spark):
    passage = " ".join(f"q{i}" for i in range(12))
    docs = [(1, f"Before, ({passage}); after!"), (2, passage.upper()), (3, f"é {passage} mid {passage}.\n"), (4, "q1 q2 q3"), (5, None)]
    cleaned = decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, passage)], "item_id long, text string"))
    assert dict(cleaned.collect()) == {1: "Before, (); after!", 2: "", 3: "é  mid .\n", 4: "q1 q2 q3", 5: None}


def test_windows(spark):
    rows = benchmark_windows(spark.createDataFrame([(1, "A b C"), (2, "a b"), (2, "a b"), (3, "")], "item_id long, text string"), length=2)
    assert sorted(tuple(r) for r in rows.collect()) == [("1", 2, "a b"), ("1", 2, "b c"), ("2", 2, "a b")]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in op13_decontaminate(spark, folder).collect())
    assert rows == sorted((d, n, h, len(i), h > 0) for d, n, h, i in plain(docs, items)) and any(r[4] for r in rows)
