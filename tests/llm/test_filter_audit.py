"""Filter interactions against a plain replay of all orders, tries against dictionaries, and the awkward cases."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from lonja.llm import filter_audit
from lonja.llm.filter_audit import audit, masks
from lonja.llm.queries import op12_filter_audit
from lonja.llm.radix_trie import RadixTrie

NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)), max_size=40))
def test_trie(strings):
    trie, counts = RadixTrie(), Counter(strings)
    for text in strings:
        node = trie.node(text)
        node.value = (node.value or 0) + 1
    assert sorted(node.value for node in trie.terminals()) == sorted(counts.values())
    assert all(trie.node(text).value == n for text, n in counts.items())


def plain(docs, labels):
    """``docs``: (doc_id, text, source); every order applied to every document."""
    least, rows = {}, {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and least[text] < doc_id}
        mine = [x for x in labels if x[0] == doc_id and doc_id is not None]
        good, toxic = any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)
        rows.setdefault(source or "", []).append((fails, good, toxic))
    for part, mine in rows.items():
        removed, out = Counter(), []
        for order in itertools.permutations("ABCDE"):
            for step, one in enumerate(order):
                c = Counter()
                for fails, good, toxic in mine:
                    before = any(fails[x] for x in order[:step])
                    c["kept"] += not before and not fails[one]
                    c["removed"] += fails[one] and not before
                    c["redundant"] += fails[one] and before
                    c["unique_fails"] += fails[one] and sum(fails.values()) == 1
                    c["good_lost"] += fails[one] and not before and good
                    c["toxic_lost"] += fails[one] and not before and toxic
                removed[one] += c["removed"]
                out.append((part, "".join(order), step + 1, one, c))
        for part, order, step, one, c in out:
            yield (part, order, step, *(c[n] for n in NAMES[:-1]), removed[one])


def rows_of(frame):
    return sorted((r.part, r.filter_order, r.step, *(r[n] for n in NAMES)) for r in frame.collect())


def test_awkward(spark, awkward, table):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (2, 0, 1), (9, 1, None), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    docs = [tuple(r) for r in awkward.select("doc_id", "text", "source").collect()]
    rows = rows_of(audit(awkward, labels))
    assert rows == sorted(plain(docs, [tuple(r) for r in labels.collect()])) and len(rows) == 600 * 4
    assert audit(table([]), labels).count() == 0 and masks(table([]), "doc_id").count() == 0
    assert sum(r[8] for r in rows_of(audit(awkward, labels.limit(0)))) == 0


@pytest.mark.parametrize("bucket", [1, 60, 100_000])
def test_buckets(spark, monkeypatch, bucket):
    """Long common beginnings, one text in a third of the rows, ids in any order, tries flushed at any size."""
    monkeypatch.setattr(filter_audit, "BUCKET", bucket)
    rng = np.random.default_rng(1)
    heads = ["", "x" * 7, "x" * 8, "x" * 9, "y" * 600, "y" * 600 + "z"]
    texts = [heads[i] + "ab"[j] * k for i, j, k in zip(rng.integers(0, 6, 300), rng.integers(0, 2, 300), rng.integers(0, 4, 300), strict=True)]
    texts += ["hot " * 30] * 150
    ids = rng.permutation(len(texts)) - 100
    docs = [(int(i), t, s) for i, t, s in zip(ids, texts, rng.choice(["p", "q"], len(texts)), strict=True)]
    least = {}
    for i, t, _ in docs:
        least[t] = min(i, least.get(t, i))
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    found = {r.doc_id: (r.mask & 16 > 0, r.n) for r in masks(frame).collect()}
    assert found == {i: (least[t] < i, 1) for i, t, _ in docs}


def test_rows_that_repeat(spark):
    docs = [(5, "same", "p")] * 30 + [(5, "same", "q"), (6, "same", "p"), (None, "same", "p"), (None, "same", None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = sorted(((r.doc_id or 0, r.part, r.mask & 16, r.n) for r in masks(frame).collect()))
    assert rows == [(0, "", 0, 1), (0, "p", 0, 1), (5, "p", 0, 30), (5, "q", 0, 1), (6, "p", 16, 1)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert rows_of(op12_filter_audit(spark, folder)) == sorted(plain(docs, labels))
