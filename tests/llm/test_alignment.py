"""Token alignment of whole texts by both libraries, without units, blocks or caches."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lonja.llm import alignment
from lonja.llm.alignment import Aligner, aligned, byte_values, default_pieces, group_links, link_report, pair_counts, token_groups, units_of
from lonja.llm.queries import op11_token_alignment
from lonja.llm.tokens import default_vocabulary

NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Both tokenizers on whole texts; all pairs of tokens are tried for overlaps."""

    def __init__(self):
        self.first = Tokenizer.from_file(default_vocabulary())
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=default_pieces())
        self.value = byte_values()

    def tokens(self, text):
        a = self.first.encode(" " + text, add_special_tokens=False).ids
        b = self.second.encode(text)
        a_bytes = [bytes(self.value[c] for c in self.first.id_to_token(i)) for i in a]
        b_bytes = []
        for i in b:
            piece = self.second.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return [], [], [], []
        return a, b, [len(x) for x in a_bytes], [len(x) for x in b_bytes]

    def document(self, text):
        a, b, a_sizes, b_sizes = self.tokens(text or "")
        a_ends, b_ends = [sum(a_sizes[: i + 1]) for i in range(len(a))], [sum(b_sizes[: i + 1]) for i in range(len(b))]
        groups, links, x, y = [], [], 0, 0
        for end in [e for e in a_ends if e in set(b_ends)]:
            u, v = a_ends.index(end) + 1, b_ends.index(end) + 1
            groups.append((a[x:u], b[y:v]))
            links += [(a[i], b[j]) for i in range(x, u) for j in range(y, v)
                      if a_ends[i] - a_sizes[i] < b_ends[j] and b_ends[j] - b_sizes[j] < a_ends[i]]
            x, y = u, v
        return a, b, groups, links

    def report(self, docs):
        found = [(doc_id, *self.document(text)) for doc_id, text in docs]
        counts = Counter(pair for row in found for pair in row[4])
        most = {}
        for (_, b), n in counts.items():
            most[b] = max(n, most.get(b, 0))
        rows = []
        for doc_id, a, b, groups, links in found:
            shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            rows.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
                         sum(counts[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if a else ""))
        return rows, counts, found


def rows_of(frame):
    return sorted(((r.doc_id, *(r[n] for n in NAMES)) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def aligner():
    return Aligner(default_vocabulary(), default_pieces())


TEXT = st.text(st.sampled_from(list("abTe1'.,é　 ▁ \n\t́中\x00\x1c  ")), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_units(plain, aligner, texts):
    """Unit by unit, a text has the tokens and groups that it has as a whole."""
    order, at, words, units = units_of(pa.array(texts, pa.string()))
    place = aligner.places(units)
    for row, number in enumerate(order.tolist()):
        mine = [place[w] for w in words[at[row] : at[row + 1]]]
        good = all(p >= 0 and aligner.numbers[p, 3] for p in mine)
        a, b, groups, links = plain.document(texts[number])
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert (";".join(aligner.groups[p] for p in mine) if good else "") == shown
        assert good == bool(a)
        if good:
            mine_links = [(int(x) >> 32, int(x) & (2**32 - 1)) for p in mine for x in aligner.links[aligner.at[p] : aligner.at[p + 1]]]
            assert mine_links == links


@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.lists(st.integers(1, 4), min_size=1, max_size=12))
def test_links(a, b):
    total = max(sum(a), sum(b))
    a, b = [x for x in [*a, total - sum(a)] if x], [x for x in [*b, total - sum(b)] if x]
    found = [link for group in token_groups(a, b) for link in group_links(a, b, group)]
    spans = [[(sum(s[:i]), sum(s[: i + 1])) for i in range(len(s))] for s in (a, b)]
    assert found == [(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]


@pytest.mark.parametrize("kept", [2, 300_000])
def test_awkward(spark, awkward, table, plain, monkeypatch, kept):
    monkeypatch.setattr(alignment, "KEPT", kept)
    odd = spark.createDataFrame(
        [(20, "a <|endoftext|> b <s> </s> <unk>", "x"), (21, "with ▁ inside", "x"), (22, "  two  spaces ", "x"), (23, " ", "x"),
         (24, "line\nbreak\n", "x"), (None, "é 中文 \U0001f600", "x"), (25, "<0x41> \x00", "x")], "doc_id long, text string, words string")
    docs = awkward.select("doc_id", "text").where("doc_id <> 9 OR doc_id IS NULL").unionByName(odd.drop("words"))
    source = [tuple(r) for r in docs.collect()]
    rows, counts, found = plain.report(source)
    assert rows_of(link_report(docs.repartition(3))) == sorted(rows, key=str)
    assert {(r.a_id, r.b_id): r["count"] for r in pair_counts(docs).collect()} == counts
    groups = sorted(((r.doc_id, [(list(g.a), list(g.b)) for g in r.groups]) for r in aligned(docs).collect()), key=str)
    assert groups == sorted(((row[0], row[3]) for row in found), key=str)
    for empty in (table([]), odd.limit(0)):
        assert link_report(empty).count() == 0 and pair_counts(empty).count() == 0 and aligned(empty).count() == 0
    zeros = link_report(spark.createDataFrame([(1, None), (2, ""), (None, "▁")], "doc_id long, text string"))
    assert {tuple(r)[1:] for r in zeros.collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_query(spark, plain):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = rows_of(op11_token_alignment(spark, folder))
    a_sizes = {}
    counts, rows = Counter(), {}
    for doc_id, text in docs:  # the two-pointer walk of the library on whole texts: all pairs would take too long here
        a, b, x, y = plain.tokens(text or "")
        groups = token_groups(x, y)
        links = [(a[i], b[j]) for g in groups for i, j in group_links(x, y, g)]
        counts.update(links)
        shown = ";".join(",".join(map(str, a[g[0]:g[1]])) + "|" + ",".join(map(str, b[g[2]:g[3]])) for g in groups)
        rows[doc_id] = (len(a), len(b), len(groups), links, hashlib.sha256(shown.encode()).hexdigest() if a else "")
    for (_, b), n in counts.items():
        a_sizes[b] = max(n, a_sizes.get(b, 0))
    expected = [(d, r[0], r[1], r[2], len(r[3]), sum(counts[p] == a_sizes[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), r[4])
                for d, r in rows.items()]
    assert found == sorted(expected, key=str)
