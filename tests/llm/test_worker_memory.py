"""How much text a Python worker treats at once, and what it keeps from batch to batch."""

import numpy as np
import pyarrow as pa
import pytest

from lonja.llm import packing, quality, tokens

ODD = [" ".join(f"odd{i}  {k}" for k in range(300)) for i in range(400)] + ["", " ", "x " * 200_000]
EVEN = [" ".join(f"w{i}q{k}" for k in range(200)) for i in range(400)]


@pytest.fixture
def encoded(monkeypatch):
    """Bytes of text that each call of the tokenizer gets."""
    sizes, each = [], tokens.Encoder.each

    def recorded(self, texts):
        sizes.append(sum(len(text.encode()) for text in texts))
        return each(self, texts)

    monkeypatch.setattr(tokens.Encoder, "each", recorded)
    return sizes


def test_tokenizer_gets_some_text_at_once(encoded):
    texts = [text for pair in zip(ODD, EVEN) for text in pair] + ODD[len(EVEN):]
    encoder = tokens.Encoder(tokens.default_vocabulary())
    ids, at = encoder.encode(pa.array(texts))
    assert max(encoded) <= max(256 << 10, max(map(len, texts)))
    plain = [x.ids for x in encoder.model.encode_batch_fast(texts, add_special_tokens=False)]
    assert at.tolist() == np.cumsum([0, *map(len, plain)]).tolist() and ids.tolist() == sum(plain, [])


def test_distinct_pieces_are_encoded_in_portions(encoded):
    encoder = tokens.Encoder(tokens.default_vocabulary())
    encoder.spaced(pa.array([f"piece{i}" for i in range(60_000)]))
    assert sum(encoded) >= 600_000 and max(encoded) <= 256 << 10


class Docs:
    columns, schema = ["text"], []

    class sparkSession:
        class conf:
            set = staticmethod(lambda *_: None)

        class sparkContext:
            @staticmethod
            def broadcast(value):
                return type("Shared", (), {"value": value})

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


def test_packing_encodes_little_and_keeps_repeated_pieces(spark, monkeypatch):
    tokens.worker_cache().clear()
    sizes, encode = [], tokens.Encoder.encode

    def recorded(self, texts):
        sizes.append(texts.nbytes)
        return encode(self, texts)

    monkeypatch.setattr(tokens.Encoder, "encode", recorded)
    text = " ".join(["first", *(f"once{i}" for i in range(3000)), *(f"twice{i % 1500}" for i in range(3000))])
    batch = pa.RecordBatch.from_arrays([pa.array(range(65)), pa.array([text] + ["y" * 50_000] * 64)], ["doc_id", "text"])
    run = packing.pieces(Docs(), "doc_id", "text", 2048, tokens.default_vocabulary())
    found = pa.Table.from_batches(run(iter([batch, batch])))
    assert max(sizes) <= 2 << 20 and sum(sizes) >= 6_400_000
    encoder, = (x for x in tokens.worker_cache().values() if isinstance(x, tokens.Encoder))
    assert sorted(encoder.known.to_pylist()) == sorted(f"twice{i}" for i in range(1500)) and encoder.kept <= 100_000
    plain = encoder.model.encode(text, add_special_tokens=False).ids
    lengths = [row["length"] for row in found.to_pylist() if row["doc_id"] == 0]
    assert sum(lengths) == 2 * (len(plain) + 1)
    tokens.worker_cache().clear()


def test_quality_takes_features_in_slices(monkeypatch):
    sizes, features = [], quality.features

    def recorded(column, hasher, bits):
        sizes.append(sum(len(text.as_py()) for text in column))
        return features(column, hasher, bits)

    weights = np.random.default_rng(1).normal(size=1 << 18)
    model = quality.Fitted(weights, weights[::-1].copy(), 0.1, 1.0, 0.0, 18)
    column = pa.array(EVEN * 3 + [None])
    monkeypatch.setattr(quality, "features", recorded)
    found = next(quality.score(Docs(), model)(iter([pa.RecordBatch.from_arrays([column], ["text"])])))
    assert len(sizes) > 1 and max(sizes) <= (256 << 10) + max(map(len, EVEN))
    whole = model.scores(column.fill_null(""), quality.Hasher())
    assert found.column(1).to_numpy().tolist() == whole.tolist()
