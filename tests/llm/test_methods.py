"""The parts of the operators against plain computations."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lonja.llm import exact_dedup, near_join
from lonja.llm.curriculum import SCHEDULES, _inverse
from lonja.llm.packing import Limits, best_fit
from lonja.llm.queries import op8_mix_sources
from lonja.llm.repeats import repeated_spans
from lonja.llm.suffix_array import repeated, suffix_array
from lonja.llm.token_files import decode_ranks, encode_ranks
from lonja.llm.tokens import Encoder, default_vocabulary
from lonja.llm.topk import Search, build
from lonja.llm.words import Hasher, shingles


def joined(strings):
    text = np.array([c for s in strings for c in (*s, 0)], np.uint8)
    left = np.array([n for s in strings for n in range(len(s), -1, -1)])
    return text, left


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=40), min_size=1, max_size=6), st.sampled_from([2, 8, 11]))
def test_suffix_array(strings, length):
    text, left = joined(strings)
    order = suffix_array(text, left)
    assert sorted(order.tolist()) == list(range(len(text)))
    suffixes = [text[i : i + left[i]].tolist() for i in order]
    assert suffixes == sorted(suffixes)
    places = {}
    for i in range(len(text)):
        if left[i] >= length:
            places.setdefault(bytes(text[i : i + length]), []).append(i)
    assert repeated(text, left, length).tolist() == sorted(i for same in places.values() if len(same) > 1 for i in same)


@pytest.mark.parametrize("large", [0, 2048])
def test_repeated_spans(spark, large):
    rng = np.random.default_rng(5)
    passages = ["".join(rng.choice(list("abcdé "), 60)) for _ in range(4)]
    texts = ["".join(rng.choice(passages + ["x" * 90, "yz" * 30, "".join(rng.choice(list("abc"), 30))], 8)) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    length, gram = 40, 16
    seen = {}
    for i, text in enumerate(texts):
        data = text.encode()
        for at in range(len(data) - length + 1):
            seen.setdefault(data[at : at + length], []).append((i, at))
    covered = [set() for _ in texts]
    for places in seen.values():
        for i, at in places if len(places) > 1 else ():
            covered[i].update(range(at, at + length))
    for row in repeated_spans(docs, length=length, gram=gram, large=large).collect():
        assert {b for low, high in row.spans for b in range(low, high)} == covered[row.doc_id]


def test_repeated_spans_of_many_near_copies(spark):
    """More different runs of an anchor than are sorted together, and rows that repeat id and text."""
    rng = np.random.default_rng(6)
    page = "".join(rng.choice(list("abcdefgh "), 260))
    texts = []
    for i in range(5000):
        spot = int(rng.integers(0, 256))
        texts.append(f"{page[:spot]}{i:04d}{page[spot + 4:]}")
    docs = list(enumerate(texts)) + [(9000, page)] * 500
    seen = {}
    for i, (_, text) in enumerate(docs):
        for at in range(len(text) - 199):
            seen.setdefault(text[at : at + 200], []).append((i, at))
    covered = [set() for _ in docs]
    for places in seen.values():
        for i, at in places if len(places) > 1 else ():
            covered[i].update(range(at, at + 200))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    rows = repeated_spans(frame, large=100).select("doc_id", "n_removed").collect()
    expected = {doc_id: len(covered[i]) for i, (doc_id, _) in enumerate(docs)}
    assert len(rows) == 5500 and all(r.n_removed == expected[r.doc_id] for r in rows) and len(set(expected.values())) > 5


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_code(values):
    ranks = np.array(values, np.int64)
    control, data = encode_ranks(ranks)
    assert decode_ranks(control, data, len(ranks)).tolist() == values and len(control) == -(-len(values) // 4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab1'.,!?é　 \n\t   ")), max_size=25), max_size=5))
def test_pieces_equal_plain_encoding(encoder, texts):
    ids, at = encoder.encode(pa.array(texts, pa.string()))
    plain = [encoder.model.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == plain


def test_added_token_in_texts(encoder):
    """A literal added token has its one id, as with the tokenizer as it is given."""
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a b<|endoftext|>c d <|endoftext|>", "<|endoftext", "no such token"]
    fresh = Tokenizer.from_file(default_vocabulary())
    ids, at = encoder.encode(pa.array(texts, pa.string()))
    plain = [fresh.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == plain
    assert [list(x).count(50256) for x in plain] == [1, 1, 2, 0, 0]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_vocabulary())


@pytest.mark.parametrize("limits", [Limits(), Limits(documents=3), Limits(attention=2048 * 300), Limits(rule="dot", documents=4)])
def test_best_fit(limits):
    lengths = np.random.default_rng(3).integers(1, 1500, 400)
    bins, offsets = best_fit(lengths, limits)
    for one in np.unique(bins):
        mine = lengths[bins == one]
        order = np.argsort(offsets[bins == one])
        assert (np.cumsum(mine[order]) - mine[order] == offsets[bins == one][order]).all()
        alone = len(mine) == 1
        assert mine.sum() <= limits.tokens and len(mine) <= limits.documents
        assert alone or (mine**2).sum() <= limits.attention
    if limits == Limits():
        assert len(np.unique(bins)) <= 1.02 * lengths.sum() / 2048 + 1


def test_cover_tree():
    rng = np.random.default_rng(4)
    points = np.floor(256 * np.concatenate([rng.normal(size=(1500, 8)) + 3 * rng.normal(size=8) for _ in range(3)]))
    ids = rng.permutation(len(points))
    tree = build(ids, ids, points)
    for low, high, centre, radius in zip(tree.low, tree.high, tree.centre, tree.radius, strict=True):
        assert (np.sqrt(((tree.points[low:high] - tree.points[centre]) ** 2).sum(axis=1)) <= radius + 1e-9).all()
    asks = np.arange(0, len(points), 37)
    search = Search(build(ids[asks], ids[asks], points[asks]), 4)
    for at in range(0, len(points), 1000):
        search.add(build(ids[at : at + 1000], ids[at : at + 1000], points[at : at + 1000]))
    scores = points[asks] @ points.T
    for row, ask in enumerate(asks):
        best = sorted((-scores[row, i], ids[i]) for i in range(len(points)) if i != ask)[:4]
        mine = int(np.flatnonzero(search.queries.ids == ids[ask])[0])
        assert [(-s, i) for s, i in zip(search.score[mine], search.id[mine], strict=True)] == best


def test_schedules_invert(spark):
    frame = spark.range(101).select((F.col("id") / 100).alias("part"))
    for knots in SCHEDULES:
        times = [r[0] for r in frame.select(_inverse(F.col("part"), knots)).collect()]
        assert times == sorted(times) and abs(times[-1] - 1) < 1e-9 and times[0] == 0
        grid = np.linspace(0, 1, 200_001)
        rate = np.interp(grid, *zip(*knots, strict=True))
        done = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)])
        assert np.allclose(np.interp(times, grid, done / done[-1]), np.arange(101) / 100, atol=1e-5)


def test_banding():
    bands, rows = near_join.banding(0.8, 0.999, 304)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 304


@pytest.mark.parametrize("few,split", [(1, 3), (1, 100), (100, 100)])
def test_near_join_in_large_buckets(spark, monkeypatch, few, split):
    """Buckets that must be split, blocks of two classes, and chains whose ends are not similar."""
    monkeypatch.setattr(near_join, "FEW", few)
    monkeypatch.setattr(near_join, "SPLIT", split)
    monkeypatch.setattr(near_join, "BLOCK", 2)
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(300)]
    base = list(rng.choice(words, 100))
    texts = [" ".join(base)]
    for step in range(1, 9):  # each differs a little from the one before it
        base = base.copy()
        base[step * 10] = f"new{step}"
        texts.append(" ".join(base))
    texts += [" ".join(rng.choice(words, 80)) for _ in range(10)] + [texts[0], texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hasher, sets = Hasher(), []
    with np.errstate(over="ignore"):
        for text in texts:
            data = np.frombuffer(text.encode(), np.uint8)
            sets.append(set(shingles(*hasher.words(data, np.array([0, len(data)])), 5)[0].tolist()))
    linked = [[a != b and len(x & y) >= 0.8 * len(x | y) for b, y in enumerate(sets)] for a, x in enumerate(sets)]
    names = list(range(len(texts)))
    for _ in names:
        names = [min([names[a], *(names[b] for b in range(len(texts)) if linked[a][b])]) for a in range(len(texts))]
    rows = near_join.near_duplicates(docs).orderBy("doc_id").collect()
    assert [(r.class_id, r.n_links) for r in rows] == [(names[a], sum(linked[a])) for a in range(len(texts))]


def test_recall():
    """A pair at the threshold is missed with a probability of 0.00001 at most."""
    bands, rows = near_join.banding(near_join.THRESHOLD, near_join.RECALL, near_join.MOST_HASHES)
    assert (1 - near_join.THRESHOLD**rows) ** bands <= 1.0000001e-5


def test_near_join_of_repeated_passages(spark):
    """Similarity is that of sets: a text and its doubling, and a page with one line repeated many times."""
    passage = " ".join(f"w{i}" for i in range(200))
    page = " ".join(f"p{i}" for i in range(300))
    docs = [(1, passage), (2, f"{passage} {passage}"), (3, page), (4, page + " a line found on every page" * 100)]
    rows = near_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.class_id, r.n_links) for r in rows] == [(1, 1), (1, 1), (3, 1), (3, 1)]


@pytest.mark.parametrize("few,split", [(1, 3), (100, 3), (1, 8192)])
def test_near_join_in_one_bucket_only(spark, monkeypatch, few, split):
    """Pairs that share a single band are compared in its bucket, however large that is."""
    monkeypatch.setattr(near_join, "FEW", few)
    monkeypatch.setattr(near_join, "SPLIT", split)
    texts = [" ".join(f"t{pair}w{i}" for i in range(100 + more)) for pair in range(5) for more in (0, 1)]
    join = near_join.NearJoin(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    join.classes = join.classes.withColumn("bands", F.array(F.lit(1).cast("long")))
    join.buckets = join._buckets()
    assert sorted(r["count"] for r in join.components().groupBy("component").count().collect()) == [2] * 5


def test_mix_query_has_positions(spark):
    """Every copy that is used has the position at which its source's integrated schedule reaches its middle."""
    folder = "/root/testdata/sf0.001"
    sources = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source").collect())
    rows = [Row(**{**r.asDict(), "positions": [float(p) for p in r.positions.split(",") if p]}) for r in op8_mix_sources(spark, folder).collect()]
    names = sorted(set(sources.values()), key=lambda x: (x is None, x))
    grid = np.linspace(0, 1, 200_001)
    for place, name in enumerate(names):
        rate = np.interp(grid, *zip(*SCHEDULES[place % 3], strict=True))
        done = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)])
        mine = [r for r in rows if sources[r.doc_id] == name]
        before = 0
        for r in sorted(mine, key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest()):
            demand = min(int(r.target + 0.5), 3 * r.source_size)
            starts = [before + epoch * r.source_size for epoch in range(3)]
            middles = [s + min(demand - s, r.size) / 2 for s in starts if r.size and s < demand]
            assert np.allclose(r.positions, np.interp(np.array(middles) / max(1, demand), done / done[-1], grid), atol=1e-5)
            before += r.size
    firsts = [r.positions[0] for r in rows if r.positions]
    assert firsts == sorted(firsts) and all(not r.positions for r in rows[len(firsts):])
    assert max(len(r.positions) for r in rows) > 1


def test_runs_are_merged_not_sorted(monkeypatch):
    """Every level gets sorted runs and only merges them; digests that begin alike and equal digests that differ otherwise."""
    rng = np.random.default_rng(9)
    firsts = rng.integers(0, 40, 2000)
    rows = [(int(i) if i % 5 else None, bytes([int(f)]) * 8 + bytes([int(g)]) * 24, int(h), 0)
            for i, f, g, h in zip(rng.permutation(2000), firsts, rng.integers(0, 3, 2000), rng.integers(0, 2, 2000), strict=True)]
    expected = {}
    for doc_id, digest, length, _ in rows:
        n, least = expected.get((digest, length), (0, None))
        expected[digest, length] = n + 1, doc_id if least is None else least if doc_id is None else min(least, doc_id)
    columns = list(zip(*rows, strict=True))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), *(pa.array(c, pa.int64()) for c in columns[2:])],
        ["doc_id", "digest", "length", "second"])
    runs = [exact_dedup.sorted_run(batch.slice(at, 130)) for at in range(0, 2000, 130)]
    monkeypatch.setattr(np, "argsort", None)
    assert all((run["d0"][1:] >= run["d0"][:-1]).all() for run in runs)
    merged = exact_dedup.merge_many(runs)
    found = {}
    for e in merged:
        digest = b"".join(int(e[f]).to_bytes(8, "big") for f in ("d0", "d1", "d2", "d3"))
        found[digest, int(e["length"])] = int(e["size"]), None if e["none"] else int(e["least"])
    assert found == expected and len(merged) == len(found)


def test_tree_of_many_places(spark):
    """More places than one round joins; every text once, with its count and smallest id."""
    docs = spark.range(5000).select("id", F.concat(F.lit("text "), F.col("id") % 700).alias("text")).repartition(13)
    marks = exact_dedup.digests(docs, "id")
    rows = exact_dedup.merge_runs(marks, rows_per_place=100).collect()
    sizes = {i: len(range(i, 5000, 700)) for i in range(700)}
    assert sorted((r.least, r.size) for r in rows) == sorted(sizes.items())
